"""What the training-data operators share: stored steps, row keys, whole texts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import run_dir

# White space and words of the contracts: ASCII blanks only.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

# Names of the columns that tell rows apart. Names that begin with OWN are the operators' own.
OWN = "__"
FILE = "__row_file"
POS = "__row_pos"
ROW = [FILE, POS]

# Plan nodes below which every row still is one row of one file.
_ROW_WISE = {"Relation", "Filter", "Project", "SubqueryAlias", "View"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared folder and read it back: later steps survive lost executors."""
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def named(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def passes_columns(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators that return rows of ``docs`` in its columns: any column may have a name of the operator's own.

    Such columns travel under a free name and come back under theirs; other tables are not touched.
    """

    @wraps(operator)
    def run(docs: DataFrame, *args, **settings) -> DataFrame:
        free = "given"
        while any(c.lower().startswith(free) for c in docs.columns):
            free += "_"
        given = {c: free + c for c in docs.columns if c.startswith(OWN)}
        if not given:
            return operator(docs, *args, **settings)
        out = operator(docs.withColumnsRenamed(given), *args, **settings)
        return out.withColumnsRenamed({new: c for c, new in given.items()})

    return run


def with_row_key(df: DataFrame) -> DataFrame:
    """Add ``FILE`` and ``POS``: the file (hashed path) and the position in it that a row was read from.

    They name a row for good, also when an executor is lost and the file is read again, whatever
    doc_ids repeat or are null. A frame that isn't read straight from files is stored first. Columns of
    ``df`` under these two names, in whatever case, are left out; ``passes_columns`` keeps them.
    """
    if clashing := [c for c in df.columns if c.lower() in ROW]:
        df = df.drop(*clashing)
    plan = df._jdf.queryExecution().analyzed().toString()
    nodes = {m[1] for line in plan.splitlines() if (m := re.match(r"[\s:+-]*([A-Za-z]+)", line))}
    if not nodes <= _ROW_WISE or "Relation" not in nodes:
        df = stored(df, "rows")
    place = df.metadataColumn("_metadata")
    return df.select("*", F.xxhash64(place["file_path"]).alias(FILE), place["row_index"].alias(POS))


def whole_text(name: str = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(named(name).cast("string"), F.lit(""))


def without_rows(keyed: DataFrame, dropped: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``keyed`` whose key isn't in ``dropped``; Spark picks the join by the size of the keys."""
    return keyed.join(dropped.select(*ROW), ROW, "left_anti").select(*[named(c) for c in columns])


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The rows of a task, a few hundred at a time: Python objects of one slice only are alive at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
