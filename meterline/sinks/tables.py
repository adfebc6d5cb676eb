"""Table writers. File sizes come from rebalancing, which splits large partitions and joins small ones."""

from __future__ import annotations

import logging
import uuid

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators.layout import quantile_cuts, z_value
from meterline.session import apart_session
from meterline.sinks.folders import delete_folder, names_below
from meterline.sources.catalog import row_count, table_exists
from meterline.sources.files import conform

log = logging.getLogger(__name__)

MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Spread rows by columns before a write; a hot value is split over several tasks."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def load_table(df: DataFrame, name: str, if_exists: str = "replace", path: str | None = None) -> bool:
    """Load a catalog table, external where a path is given.

    Empty input is skipped with a warning and returns False.
    """
    if if_exists not in MODES:
        raise ValueError(f"if_exists must be one of {sorted(MODES)}")
    if df.isEmpty():
        log.warning("no rows, table %s is left alone", name)
        return False
    if if_exists == "replace" and table_exists(df.sparkSession, name):
        log.warning("replacing table %s", name)
    writer = df.write.mode(MODES[if_exists]).format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return True


def verify_table(spark: SparkSession, name: str) -> dict[str, int]:
    if not table_exists(spark, name):
        raise ValueError(f"table {name} does not exist")
    return {"row_count": row_count(spark, name), "column_count": len(spark.table(name).columns)}


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def reset_table(spark: SparkSession, name: str) -> None:
    """Empty a table between runs, external ones included, which TRUNCATE refuses. Schema and location stay."""
    spark.createDataFrame([], spark.table(name).schema).write.insertInto(name, overwrite=True)


def write_files(
    df: DataFrame, path: str, files: int, finish: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> None:
    """Exactly ``files`` Parquet files of even size.

    A file is one task's work, which reads its share of the rows, so ``files`` should grow with the table; ``write_clustered`` with
    ``rows_per_file`` derives the number from the rows. To keep that share small the tasks that make the rows deal them to a folder per
    file, beside ``path``, as compressed columns: about a third of what a shuffle of the same rows takes. The task of a file reads
    its folder; ``finish`` computes there, row by row, columns that needn't be stored twice.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"
    # Every task deals its rows in turn, each from another folder on.
    turn = F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(files)).cast("int")
    dealt = df.withColumn("__file", turn)
    try:
        dealt.write.option("compression", "zstd").partitionBy("__file").parquet(staged)
        rows = apart_session(spark).read.schema(dealt.schema).parquet(staged)
        shares = [rows.where(F.col("__file") == i).drop("__file").coalesce(1) for i in range(files)]
        finish(reduce(DataFrame.union, shares)).write.mode("overwrite").parquet(path)
    finally:
        delete_folder(spark, staged)


ROWS_PER_FILE = 4_000_000


def write_clustered(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    cluster_by: list[str] | None = None,
    mode: str = "overwrite",
    bloom_on: list[str] | None = None,
    rows_per_file: int | None = None,
    z_bits: int | None = None,
) -> None:
    """Partitioned table, sorted inside each file so that min/max statistics can skip row groups.

    ``bloom_on`` names lookup columns that get Parquet bloom filters, in the place of an index. A partition
    column should leave some hundred MB per value: a folder per day of a small table is mostly file overhead.

    Without further settings large partitions are split over tasks and small ones share one. With ``rows_per_file`` the rows are dealt to
    as many tasks as their number asks for, by ranges of partition, cluster columns and a hash of the row, so that a
    partition of any size, even one of equal keys, is split and files grow in number with the data. With ``z_bits`` the ranges are over the
    interleaved quantile ranks of the (numeric) cluster columns in place of one column after the other: a filter on any one of them then skips
    files, where a plain sort helps the first only.
    """
    parts, order = partition_by or [], cluster_by or []
    columns = df.columns
    if z_bits is not None:
        df = df.withColumn("__z", z_value(quantile_cuts(df, order, z_bits), z_bits))
        order = ["__z", *order]
    if rows_per_file is not None or z_bits is not None:
        files = max(-(-df.count() // (rows_per_file or ROWS_PER_FILE)), 1)
        df = df.repartitionByRange(files, *parts, *order, F.xxhash64(*columns))
    elif parts:
        df = rebalanced(df, *parts)
    if parts or order:
        df = df.sortWithinPartitions(*parts, *order)
    writer = df.select(*columns).write.mode(mode)
    for column in bloom_on or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(path)


def reload_partitions(df: DataFrame, path: str, expected: list[tuple[int, int]]) -> dict[tuple[int, int], int]:
    """Replace the (year, month) partitions of the input; ``expected`` names them, an empty list takes what comes.

    Rows per month are counted first, from two columns: a month that is expected and has no rows, or has rows and isn't
    expected, is an error before anything is written. Running a load again gives the same table. Spark replaces
    the partitions in one commit of the job; on stores without an atomic rename readers may see it half done.
    """
    found = df.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {(r["year"], r["month"]): r["n"] for r in found}
    if not counts:
        raise ValueError("no rows to load")
    if expected:
        if missing := sorted(set(expected) - set(counts)):
            raise ValueError(f"no rows for {missing}")
        if strays := sorted(set(counts) - set(expected), key=str):
            raise ValueError(f"unexpected months {strays}")
    (
        rebalanced(df, "year", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(path)
    )
    return counts


def in_partitions(by: list[str], keys: list[tuple[int, ...]]) -> Column:
    """Rows of the named partitions, as a condition that prunes folders."""
    each = [reduce(Column.__and__, [F.col(c) == v for c, v in zip(by, key, strict=True)]) for key in keys]
    return reduce(Column.__or__, each, F.lit(False))


def replace_partitions(
    df: DataFrame, path: str, by: list[str], keys: list[tuple[int, ...]], cluster_by: list[str] | None = None
) -> list[tuple[int, ...]]:
    """Replace the named partitions, and no others, by the rows of ``df`` that belong there; returns those that have rows.

    Partition columns are whole numbers. A partition without rows any more is deleted: its files are the ones it had
    before, as a write names all of its files anew. Doing it again gives the same table.
    """
    if not keys:
        return []
    spark = df.sparkSession
    folders = {key: "/".join([path, *[f"{c}={v}" for c, v in zip(by, key, strict=True)]]) for key in keys}
    before = {key: names_below(spark, folder) for key, folder in folders.items()}
    (
        rebalanced(df.where(in_partitions(by, keys)), *by)
        .sortWithinPartitions(*by, *(cluster_by or []))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
    filled = [key for key, folder in folders.items() if names_below(spark, folder) != before[key]]
    for key in set(keys) - set(filled):
        delete_folder(spark, folders[key])
    return filled


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> None:
    """External catalog table hashed and sorted on ``keys``, one file per bucket.

    Tables of the same number of buckets join on these keys, and group by them, without a shuffle. A bucket is one task's
    work, so their number grows with the table; a hot key stays in its bucket.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def append_evolving(df: DataFrame, path: str, schema: T.StructType, time: str, cluster_by: list[str]) -> None:
    """Append with a fixed schema, month partitions and clustering. New fields are allowed.

    Unlike a partition reload this is not idempotent: loading a file twice doubles its rows.
    """
    fixed = conform(df, schema, keep_new=True)
    dated = fixed.withColumn("pickup_month_start", F.trunc(F.col(time), "month"))
    write_clustered(dated, path, ["pickup_month_start"], cluster_by, mode="append")


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def time_slice(df: DataFrame, time: str, first: str, last: str, day_column: str | None = None) -> DataFrame:
    """Closed time range. ``day_column`` names the date partition, which then prunes folders too."""
    lower, upper = F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")
    out = df.where(F.col(time).between(lower, upper))
    if day_column:
        out = out.where(F.col(day_column).between(lower.cast("date"), upper.cast("date")))
    return out


def write_jdbc(df: DataFrame, url: str, name: str, mode: str = "append", batch: int = 10000, connections: int = 10) -> None:
    """Chunked insert into a database table; ``connections`` bounds the parallel writers."""
    df.write.mode(mode).option("batchsize", batch).option("numPartitions", connections).jdbc(url, name)
