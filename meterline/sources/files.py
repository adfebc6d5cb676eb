"""File readers."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.names import lower_columns, normalize_columns
from meterline.functions.timeparts import month_range
from meterline.schemas import PICKUP_PREFIX, get_schema


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan with normalised column names. A missing path raises when the scan is planned."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return normalize_columns(reader.parquet(path))


def counted(df: DataFrame, observation: Observation) -> DataFrame:
    """Count rows while they flow to whatever uses them, without a second pass."""
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))


def month_paths(spark: SparkSession, root: str, service: str, months: list[tuple[int, int]] | None = None) -> list[str]:
    """The monthly files or folders of a service, all or some; no file is read.

    Only one path per month reaches the driver, however many part files a month has.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    month = F.regexp_extract("path", rf"^(.*/{service}_tripdata_=?(\d{{4}}-\d{{2}})[^/]*)", 1)
    found = sorted(r.month for r in listed.select(month.alias("month")).where("month <> ''").distinct().collect())
    if months is None:
        return found
    wanted = {f"{year:04d}-{number:02d}" for year, number in months}
    return [path for path in found if re.search(r"_tripdata_=?(\d{4}-\d{2})", path)[1] in wanted]


def read_monthly(spark: SparkSession, root: str, service: str, months: list[tuple[int, int]] | None = None) -> DataFrame:
    """Monthly Parquet of one service in its fixed schema, whatever types a month was written with."""
    return read_drifting(spark, month_paths(spark, root, service, months), get_schema(service))


def conform(df: DataFrame, schema: T.StructType, keep_new: bool = False) -> DataFrame:
    """Cast to a fixed schema by name; absent columns become NULL, new ones are dropped or kept."""
    have = {f.name.lower(): f for f in df.schema.fields}

    def fixed_column(f: T.StructField):
        given = have.get(f.name.lower())
        if given is None:
            return F.lit(None).cast(f.dataType).alias(f.name)
        column = F.col(given.name)
        if isinstance(given.dataType, T.StringType) and isinstance(f.dataType, T.IntegralType):
            # "1.0" is a whole number, too; text that is no number stays an error
            column = F.coalesce(column.try_cast(f.dataType), F.bround(column.cast("double")).cast(f.dataType))
        return column.cast(f.dataType).alias(f.name)

    fixed = [fixed_column(f) for f in schema.fields]
    known = {f.name.lower() for f in schema.fields}
    extra = [F.col(c) for c in df.columns if c.lower() not in known] if keep_new else []
    return df.select(*fixed, *extra)


def read_drifting(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Files whose column types differ from month to month, as one table of the fixed schema.

    ``paths`` are months (files, or folders whose parts share one schema). One footer per month is read, and one scan
    made per distinct schema.
    """
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for path in paths:
        found = spark.read.parquet(path).schema
        groups.setdefault(found.json(), (found, []))[1].append(path)
    if not groups:
        raise ValueError("no files to read")
    scans = [conform(spark.read.schema(found).parquet(*members), schema) for found, members in groups.values()]
    return reduce(DataFrame.unionByName, scans)


def read_csv(spark: SparkSession, path, schema: T.StructType | None = None, null_value: str | None = None) -> DataFrame:
    """CSV with a header; every column is text unless a schema is given."""
    reader = spark.read.option("header", "true")
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_month_csv(
    spark: SparkSession, root: str, service: str, months: list[tuple[int, int]] | None = None
) -> DataFrame:
    """Monthly ``.csv.gz`` files, lower-case names, typed, tagged with the year and month of their file.

    All months are one scan, named ones or every one found. A gzip file is read by one task, so
    parallelism is the file count; the writers rebalance what follows.
    """
    if months is None:
        paths = [f"{root}/{service}_tripdata_*"]
    else:
        paths = [f"{root}/{service}_tripdata_{y:04d}-{m:02d}.csv.gz" for y, m in months]
    text = read_csv(spark, paths)
    file_month = r"_tripdata_(?:=)?(\d{4})-(\d{2})"
    tags = {
        name: F.regexp_extract(F.col("_metadata.file_path"), file_month, group).cast("int")
        for name, group in (("year", 1), ("month", 2))
    }
    return lower_columns(conform(text.withColumns(tags), get_schema(service), keep_new=True))


def drop_missing_pickup(df: DataFrame, service: str, observation: Observation | None = None) -> DataFrame:
    """Drop rows without a pickup time; the observation receives how many."""
    column = f"{PICKUP_PREFIX[service]}_pickup_datetime"
    if observation is not None:
        df = df.observe(observation, F.count_if(F.col(column).isNull()).alias("dropped"))
    return df.where(F.col(column).isNotNull())


def head_n(df: DataFrame, order: list[str], n: int = 1000) -> DataFrame:
    """First rows by a total order."""
    return df.orderBy(*order).limit(n)


def month_slice(df: DataFrame, column: str, year: int, month: int) -> DataFrame:
    first, after = month_range(year, month)
    return df.where((F.col(column) >= F.lit(first).cast("timestamp")) & (F.col(column) < F.lit(after).cast("timestamp")))


def external_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Catalog table over existing Parquet files; nothing is copied."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    return spark.table(name)
