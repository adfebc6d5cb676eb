"""Paged JSON resources, read from landed responses.

A landing file holds one response, or a part of one, per line: ``{"page": n, "body": ...}``. Lines
are split over tasks like any JSON-lines file, so there is no file per page, no single reader
walking the pages and no limit on what a page may hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.names import snake_columns


def _pages(spark: SparkSession, path: str, body: T.DataType) -> DataFrame:
    schema = T.StructType([T.StructField("page", T.LongType()), T.StructField("body", body)])
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_numbered_pages(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Records of a resource paged by number, up to the first empty page.

    Pages behind the first empty one are not part of the resource.
    """
    pages = _pages(spark, path, T.ArrayType(record))
    # Both numbers come from the records-per-page counts, never from the records themselves.
    empty = F.coalesce(F.size("body"), F.lit(0)) <= 0
    end = pages.agg(F.coalesce(F.min(F.when(empty, F.col("page"))), F.lit(2**62))).scalar()
    records = pages.where(F.col("page") < end).select(F.explode("body").alias("r"))
    return snake_columns(records.select("r.*"))


def read_offset_pages(
    spark: SparkSession, path: str, record: T.StructType, limit: int, selector: str = "docs", total: str = "numFound"
) -> DataFrame:
    """Records of a resource paged by offset, up to the total the responses state.

    ``page`` holds the offset. A request at or behind the total, or off the page grid, would never
    have been made and is ignored.
    """
    body = T.StructType([T.StructField(total, T.LongType()), T.StructField(selector, T.ArrayType(record))])
    pages = _pages(spark, path, body)
    stated = F.col(f"body.{total}")
    asked = (F.col("page") < stated) & (F.col("page") % limit == 0)
    records = pages.where(asked).select(F.explode(F.col(f"body.{selector}")).alias("r"))
    return snake_columns(records.select("r.*"))


def child_table(df: DataFrame, key: str, field: str) -> DataFrame:
    """Rows of a list field with the parent key and their position. Empty lists give no row."""
    return df.select(F.col(key).alias("parent_key"), F.posexplode(F.col(field)).alias("position", "value"))


def split_child_tables(df: DataFrame, key: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Parent table without its list fields, and one child table per list field."""
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.drop(*lists), {name: child_table(df, key, name) for name in lists}


def land_pages(records: DataFrame, page: str, path: str) -> None:
    """Write records as page responses plus the empty page that ends them.

    Each record is a line of its own under its page number; nothing is gathered per page.
    """
    body = [c for c in records.columns if c != page]
    lines = records.select(F.col(page).alias("page"), F.array(F.struct(*body)).alias("body"))
    end = records.agg((F.max(page) + 1).alias("page")).select(
        "page", F.array().cast(lines.schema["body"].dataType).alias("body")
    )
    lines.unionByName(end).write.option("ignoreNullFields", "false").json(path)
