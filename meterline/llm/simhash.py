"""SimHash near-duplicates through a Gray-order hierarchical index.

A fingerprint has 64 bits; bit i is 1 if more than half of the text's shingle hashes have it set. Two
fingerprints link at ``MAX_BITS`` or fewer differing bits, and documents are classed by the components of
those links.

The index works on distinct fingerprints, so copies cost nothing and never meet in one task.

- Upper nodes are shared masked bit patterns. The bits that aren't masked yet are cut into
  ``MAX_BITS + 1`` runs; two fingerprints that link agree on at least one run in full, so both lie in the
  upper node ``(mask of the run, bits under it)``. A node of more than ``NODE_ROWS`` fingerprints is cut
  again the same way, with the pattern of the parent added to the mask. A pattern of 64 - b bits holds at most 2^b
  fingerprints, so this ends, and no node is ever capped.
- Inside a node the fingerprints are sorted by Gray rank, which brings those with long common patterns
  together. Blocks of neighbours are factored bottom-up: a parent keeps the bits that all below share, its
  children only what they add. A search walks down with the differences accumulated so far and drops a
  whole group as soon as they pass ``MAX_BITS``. Inner links are joined at once, so a node hands on fewer
  links than it has fingerprints, however many pairs it holds.
- Links of all nodes meet in a distributed component search (``components``).

Defined cases. Null text counts as empty; a text without words has fingerprint zero and links like any other.
Fewer words than the shingle length make one shingle of the whole sequence. Rows that repeat are one point of the
index. ``component_id`` is the smallest doc_id reachable (null if all are null). Texts are read whole, in slices of
bounded length. Other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import FILE, POS, ROW, in_slices, passes_columns, stored, whole_text, with_row_key, without_rows
from meterline.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
NODE_ROWS = 2048
BUCKET_ROWS = 20_000
FAN_OUT = 8
SLICE = 65_536


def _slices(words: list[bytes], length: int) -> Iterator[np.ndarray]:
    """The XXH64 hashes of the word shingles, a bounded number at a time."""
    if len(words) < length:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(length))))
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    while (part := np.fromiter(islice(hashes, SLICE), dtype="<u8")).size:
        yield part


def fingerprint(text: bytes, length: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text as an unsigned number."""
    words = text.lower().split()  # on bytes both know ASCII only
    if not words:
        return 0
    total, ones = 0, np.zeros(64, dtype=np.int64)
    for part in _slices(words, length):
        total += part.size
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(keyed: DataFrame, length: int = SHINGLE) -> DataFrame:
    """Row key, doc_id and fingerprint (``fp``, its 64 bits as a signed number) of every whole text."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = np.fromiter((fingerprint(t, length) for t in batch.column(3).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(found.view(np.int64))],
                names=[FILE, POS, "doc_id", "fp"],
            )

    texts = keyed.select(*ROW, F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().cast("binary").alias("t"))
    return stored(texts.mapInArrow(make, f"{FILE} bigint, {POS} bigint, doc_id bigint, fp bigint"), "fingerprints")


# --- upper nodes ----------------------------------------------------------------------------------


def submasks(mask: int, max_bits: int = MAX_BITS) -> list[int]:
    """The masks below ``mask``: it and one of the ``max_bits + 1`` runs of the bits it leaves free."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << int(b) for b in run) for run in np.array_split(free, max_bits + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _below(rows: DataFrame, masks: list[int], max_bits: int) -> DataFrame:
    """Put each row (``fp, mask``) below each submask of its mask."""
    cells = [F.lit(x) if isinstance(x, int) else F.array(*x) for m in masks for x in (_signed(m), [F.lit(_signed(s)) for s in submasks(m, max_bits)])]
    return rows.select("fp", F.explode(F.element_at(F.create_map(*cells), F.col("mask"))).alias("mask"))


def nodes(distinct: DataFrame, max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> list[DataFrame]:
    """Rows ``fp, mask`` of the nodes that hold 2 to ``node_rows`` fingerprints, one table per level."""
    rows, masks, levels = distinct.select("fp", F.lit(0).cast("bigint").alias("mask")), [0], []
    while masks:
        placed = _below(rows, masks, max_bits).withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = placed.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        level = stored(placed.join(sizes, ["mask", "pattern"]).select("fp", "mask", (F.col("n") > node_rows).alias("cut")), "nodes")
        levels.append(level.where(~F.col("cut")).select("fp", "mask"))
        rows = level.where("cut").select("fp", "mask")
        masks = [r["mask"] % (1 << 64) for r in rows.select("mask").distinct().collect()]  # at most 3 per level of cutting, to its power
    return levels


# --- inside a node --------------------------------------------------------------------------------


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the Gray order."""
    ranks = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        ranks ^= ranks >> np.uint64(shift)
    return ranks


def _factored(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of the index over Gray-sorted codes, top first: (bits the node adds, pattern, first child).

    The last level is the codes themselves, each adding the bits that its parent doesn't share.
    """
    value, mask = codes, np.full(codes.size, np.uint64(0xFFFFFFFFFFFFFFFF))
    levels = [(value, mask)]
    while value.size > 1:
        starts = np.arange(0, value.size, FAN_OUT)
        all_and = np.bitwise_and.reduceat(value & mask, starts)
        none_or = np.bitwise_or.reduceat(value & mask, starts)
        shared = np.bitwise_and.reduceat(mask, starts) & (all_and | ~none_or)
        value, mask = all_and & shared, shared
        levels.append((value, mask))
    levels.reverse()
    out = []
    for depth, (value, mask) in enumerate(levels):
        above = np.repeat(levels[depth - 1][1], FAN_OUT)[: value.size] if depth else np.zeros(1, dtype=np.uint64)
        out.append((mask & ~above, value, np.arange(value.size) * FAN_OUT))
    return out


def search(codes: np.ndarray, queries: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in ``queries``, place in ``codes``) within ``max_bits``; codes are in Gray order."""
    levels = _factored(codes)
    who, at = np.arange(queries.size), np.zeros(queries.size, dtype=np.int64)
    spent = np.zeros(queries.size, dtype=np.int64)
    for depth, (adds, value, first) in enumerate(levels):
        if depth:
            at = (levels[depth - 1][2][at][:, None] + np.arange(FAN_OUT)).ravel()
            who, spent = np.repeat(who, FAN_OUT), np.repeat(spent, FAN_OUT)
            real = at < value.size
            who, at, spent = who[real], at[real], spent[real]
        spent = spent + np.bitwise_count((queries[who] ^ value[at]) & adds[at])
        near = spent <= max_bits
        who, at, spent = who[near], at[near], spent[near]
    return who, at


def _flat(roots: np.ndarray) -> np.ndarray:
    while not np.array_equal(up := roots[roots], roots):
        roots = up
    return roots


def _join(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the classes of each pair (a, b); ``roots`` is flat before and after."""
    while True:
        x, y = roots[a], roots[b]
        apart = x != y
        if not apart.any():
            return roots
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        roots = roots.copy()
        np.minimum.at(roots, np.maximum(x, y), np.minimum(x, y))
        roots = _flat(roots)


def node_links(codes: np.ndarray, max_bits: int = MAX_BITS, at_once: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is joined inside one node: (code, code of its class)."""
    codes = codes[np.argsort(gray_rank(codes))]
    roots = np.arange(codes.size)
    for start in range(0, codes.size, at_once):
        who, at = search(codes, codes[start : start + at_once], max_bits)
        roots = _join(roots, who + start, at)
    joined = np.flatnonzero(roots != np.arange(codes.size))
    return codes[joined], codes[roots[joined]]


def _bucket_links(max_bits: int):
    def links(rows: pd.DataFrame) -> pd.DataFrame:
        fp, mask = rows["fp"].to_numpy().view(np.uint64), rows["mask"].to_numpy().view(np.uint64)
        order = np.lexsort((fp, fp & mask, mask))
        fp, mask = fp[order], mask[order]
        ends = np.flatnonzero((mask[1:] != mask[:-1]) | ((fp & mask)[1:] != (fp & mask)[:-1])) + 1
        found: list[tuple[np.ndarray, np.ndarray]] = []
        starts, stops = np.r_[0, ends], np.r_[ends, fp.size]
        pairs = starts[stops - starts == 2]
        near = pairs[np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= max_bits]
        found.append((fp[near], fp[near + 1]))
        for a, b in zip(starts, stops):
            if b - a > 2:
                found.append(node_links(fp[a:b], max_bits))
        u, v = (np.concatenate([f[i] for f in found]).view(np.int64) for i in (0, 1))
        return pd.DataFrame({"u": u, "v": v})

    return links


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links ``u, v`` between distinct fingerprints that span every class of near fingerprints."""
    out = None
    for level in nodes(distinct, max_bits, node_rows):
        buckets = max(1, -(-level.count() // BUCKET_ROWS))
        bucket = F.pmod(F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("mask"))), F.lit(buckets))
        found = level.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(_bucket_links(max_bits), "u long, v long")
        out = found if out is None else out.unionByName(found)
    return out.distinct()


# --- classes of documents -------------------------------------------------------------------------


def _classed(rows: DataFrame, max_bits: int, node_rows: int) -> DataFrame:
    """``rows`` (row key, doc_id, fp) with ``root``: one fingerprint for each class."""
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    roots = components(near_links(distinct, max_bits, node_rows))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    return stored(named, "classes")


def simhash_classes(docs: DataFrame, length: int = SHINGLE, max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    rows = fingerprints(with_row_key(docs), length)
    classes = _classed(rows, max_bits, node_rows)
    ids = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    per_fp = stored(classes.join(ids, "root").select("fp", "component_id"), "components")
    return rows.join(per_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@passes_columns
def drop_near_copies(docs: DataFrame, length: int = SHINGLE, max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """The documents with one row of every class, that of the smallest doc_id, in the columns of ``docs``."""
    keyed = with_row_key(docs)
    rows = fingerprints(keyed, length)
    classes = _classed(rows, max_bits, node_rows).select("fp", "root")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", FILE, POS)
    best = rows.groupBy("fp").agg(F.min(order).alias("best")).join(classes, "fp")
    best = best.groupBy("root").agg(F.min("best").alias("best"))
    stays = best.select(F.col(f"best.{FILE}").alias(FILE), F.col(f"best.{POS}").alias(POS))
    losers = stored(rows.select(*ROW).join(stays, ROW, "left_anti"), "losers")
    return without_rows(keyed, losers, docs.columns)
