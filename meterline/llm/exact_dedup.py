"""Exact deduplication with a heavy-hitter split.

Texts are equal when they are identical without their white space. Only digests move; the text
itself never does, but for the one join that filters the documents in ``drop_copies``.

1. One pass makes the digest of every row and stores it.
2. Misra-Gries summaries, one per task, are added up per digest. A digest of at least
   ``2 * rows / (counters + 1)`` rows always comes out, and at most ``counters + 1`` do.
3. The winners of those digests are verified: counted and chosen exactly, over all rows.
   There are at most ``counters + 1`` of them, so they are broadcast and their copies are settled
   (or removed) on the map side.
4. All other digests go through an ordinary aggregation and an ordinary join.

Defined cases. Null text counts as empty, and empty texts are copies of one another. Ties go to the
smallest doc_id, a null doc_id comes last; rows that repeat a doc_id with the same text are settled by their
place in the input, so that just one row of a group stays. Other columns, whatever they are called, are not
looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import BLANK, FILE, POS, ROW, named, passes_columns, stored, whole_text, with_row_key, without_rows

COUNTERS = 1023

DIGEST = "__digest"
BEST = "__best"
SIZE = "__group_size"


def _digest():
    return F.unhex(F.sha2(F.regexp_replace(whole_text(), BLANK + "+", ""), 256))


def digests(keyed: DataFrame) -> DataFrame:
    """Row key, doc_id, digest of the text without white space, and length of the text in code points."""
    return stored(
        keyed.select(
            *ROW,
            F.col("doc_id").cast("bigint").alias("doc_id"),
            _digest().alias(DIGEST),
            F.char_length(whole_text()).cast("bigint").alias("n_chars"),
        ),
        "digests",
    )


def misra_gries(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """The Misra-Gries summary of one task: at most ``counters`` digests with lower bounds of their counts."""
    held: dict[bytes, int] = {}
    for batch in batches:
        for pair in pc.value_counts(batch.column(0)):
            value = pair["values"].as_py()
            held[value] = held.get(value, 0) + pair["counts"].as_py()
        if len(held) > counters:
            cut = sorted(held.values(), reverse=True)[counters]
            held = {k: v - cut for k, v in held.items() if v > cut}
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=[DIGEST, "n"]
        )


def _order():
    """The row that stays has the smallest of these."""
    return F.struct(
        (-F.col("n_chars")).alias("shortness"),
        F.col("doc_id").isNull().alias("unnamed"),
        F.col("doc_id"),
        F.col(FILE),
        F.col(POS),
    )


def _winners(rows: DataFrame) -> DataFrame:
    return rows.groupBy(DIGEST).agg(F.min(_order()).alias(BEST), F.count(F.lit(1)).alias(SIZE))


def heavy_winners(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Winner and group size of every frequent digest, counted exactly: at most ``counters + 1`` rows."""
    total = rows.count()
    found = (
        rows.select(DIGEST)
        .mapInArrow(lambda batches: misra_gries(batches, counters), f"{DIGEST} binary, n bigint")
        .groupBy(DIGEST)
        .agg(F.sum("n").alias("n"))
        .where((F.col("n") * (counters + 1) >= F.lit(total)) & (F.col("n") > 1))
        .select(DIGEST)
    )
    candidates = stored(found, "candidates")
    return stored(_winners(rows.join(F.broadcast(candidates), DIGEST, "left_semi")), "winners")


def copy_classes(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """Every row of ``digests`` with ``BEST`` and ``SIZE`` of its group."""
    frequent = rows.join(F.broadcast(heavy), DIGEST)
    rest = rows.join(F.broadcast(heavy.select(DIGEST)), DIGEST, "left_anti")
    return frequent.unionByName(rest.join(_winners(rest), DIGEST))


def _stays():
    return (F.col(f"{BEST}.{FILE}") == F.col(FILE)) & (F.col(f"{BEST}.{POS}") == F.col(POS))


def exact_dedup(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = digests(with_row_key(docs))
    return copy_classes(rows, heavy_winners(rows, counters)).select(
        "doc_id",
        F.col(f"{BEST}.doc_id").alias("keep_id"),
        F.col(SIZE).alias("group_size"),
        _stays().alias("kept"),
        F.lower(F.hex(DIGEST)).alias("text_sha256"),
    )


@passes_columns
def drop_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents with one row of every group of equal texts, in the columns of ``docs``."""
    keyed = with_row_key(docs)
    rows = digests(keyed)
    heavy = heavy_winners(rows, counters)
    rest = rows.join(F.broadcast(heavy.select(DIGEST)), DIGEST, "left_anti")
    losers = stored(rest.join(_winners(rest).where(F.col(SIZE) > 1), DIGEST).where(~_stays()).select(*ROW), "losers")
    first = keyed.withColumn(DIGEST, _digest()).join(F.broadcast(heavy), DIGEST, "left")
    first = first.where(F.col(BEST).isNull() | _stays())
    return without_rows(first.select(*[named(c) for c in docs.columns], *ROW), losers, docs.columns)
