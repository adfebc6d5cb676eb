"""Catalog and metadata queries."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.numbers import rounded


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def row_count(spark: SparkSession, name: str) -> int:
    """Rows of a table, 0 when it is absent."""
    return spark.table(name).count() if table_exists(spark, name) else 0


def sample(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def file_list(df: DataFrame) -> DataFrame:
    """Files behind a file-based DataFrame with their size and row count; no data column is read."""
    return (
        df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
        .groupBy("path")
        .agg(F.max("size").alias("size_bytes"), F.count(F.lit(1)).alias("row_count"))
    )


def file_stats(df: DataFrame) -> DataFrame:
    """File count, rows, total and average size."""
    return file_list(df).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("row_count").alias("row_count"),
        F.sum("size_bytes").alias("total_bytes"),
        rounded(F.avg("size_bytes") / F.lit(1024 * 1024), 2).alias("avg_mb"),
        F.min("size_bytes").alias("smallest_bytes"),
    )


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and size of file-based tables."""
    parts = []
    for name, df in tables.items():
        stats = file_list(df).agg(F.sum("row_count").alias("row_count"), F.sum("size_bytes").alias("size_bytes"))
        parts.append(
            stats.select(
                F.lit(name).alias("table_name"),
                F.coalesce("row_count", F.lit(0)).alias("row_count"),
                F.lit(len(df.columns)).cast("bigint").alias("column_count"),
                F.coalesce("size_bytes", F.lit(0)).alias("size_bytes"),
                rounded(F.coalesce("size_bytes", F.lit(0)) / F.lit(1e9), 2).alias("size_gb"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


# --- statistics kept in the catalog ---------------------------------------------------------------


def analyze(spark: SparkSession, name: str, columns: list[str] | None = None) -> None:
    """Store size and row count of a table in the catalog; with ``columns`` their figures, an empty list takes all columns.

    Figures are those of this moment: a later write leaves them as they are until the next call.
    """
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    if columns is not None:
        wanted = "FOR COLUMNS " + ", ".join(f"`{c}`" for c in columns) if columns else "FOR ALL COLUMNS"
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS {wanted}")


def table_statistics(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    """Rows, columns and bytes of catalog tables as last analyzed, without a look at their files.

    ``names`` maps the name to report to the table. Both figures are null for a table that wasn't analyzed.
    """
    rows = []
    for shown, name in names.items():
        kept = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Statistics'").collect()
        stated = re.fullmatch(r"(\d+) bytes(?:, (\d+) rows)?", kept[0]["data_type"]) if kept else None
        size, n = stated.groups() if stated else (None, None)
        rows.append((shown, n and int(n), len(spark.table(name).columns), size and int(size)))
    return spark.createDataFrame(rows, "table_name string, row_count long, column_count long, size_bytes long")


COLUMN_FIGURES = {"min": "min_value", "max": "max_value", "num_nulls": "null_count", "distinct_count": "distinct_count"}


def column_statistics(spark: SparkSession, name: str, columns: list[str]) -> DataFrame:
    """One row per column from the catalog: least, greatest, nulls (exact) and distinct values (an estimate).

    Null where a column wasn't analyzed.
    """
    rows = []
    for column in columns:
        told = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {name} `{column}`").collect()}
        figures = [None if told.get(k) == "NULL" else told.get(k) for k in COLUMN_FIGURES]
        rows.append((column, *figures))
    stated = spark.createDataFrame(rows, "column_name string, " + ", ".join(f"{n} string" for n in COLUMN_FIGURES.values()))
    return stated.withColumns({n: F.col(n).cast("bigint") for n in ("null_count", "distinct_count")})
