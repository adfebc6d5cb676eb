"""Writers: each query loads a table under the shared folder and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from meterline.jobs.monthly_etl import append_months
from meterline.queries.base import GREEN, RAW, query
from meterline.plans.reports import distinct_counts
from meterline.schemas import DOUBLE, INT, TIME, struct
from meterline.session import run_dir
from meterline.sinks import tables
from meterline.sources import catalog
from meterline.sources.sample import as_trips, raw_trips, trip_inputs


# Number of files of the evenly split table: a parameter of the queries and of their SQL.
FILES = 4

# Rows that a task of the partitioned tables writes: few, so that the small sample tables are dealt out as well.
ROWS = 10_000


@query(
    "repartition_write",
    f"WITH {RAW} SELECT COUNT(*) AS row_count, COUNT(DISTINCT RatecodeID) AS rate_codes, COUNT(tolls_amount) AS tolls, "
    "CAST(21 AS BIGINT) AS column_count FROM raw",
)
def repartition_write(spark, sf_dir):
    path = run_dir(spark, "repartitioned")
    tables.write_files(trip_inputs(spark, sf_dir), path, FILES, as_trips)
    written = spark.read.parquet(path)
    return written.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("RatecodeID").alias("rate_codes"),
        F.count("tolls_amount").alias("tolls"),
        F.lit(len(written.columns)).cast("bigint").alias("column_count"),
    )


@query(
    "file_size_stats",
    f"SELECT CAST({FILES} AS BIGINT) AS file_count, COUNT(*) AS row_count, TRUE AS all_filled, TRUE AS adds_up FROM lineitem",
)
def file_size_stats(spark, sf_dir):
    path = run_dir(spark, "sized")
    tables.write_files(trip_inputs(spark, sf_dir), path, FILES, as_trips)
    written = spark.read.parquet(path)
    listed = catalog.file_list(written).agg(F.sum("size_bytes").alias("listed_bytes"))
    return catalog.file_stats(written).select(
        "file_count",
        "row_count",
        ((F.col("smallest_bytes") > 0) & (F.col("avg_mb") >= 0)).alias("all_filled"),
        (F.col("total_bytes") == listed.scalar()).alias("adds_up"),
    )


@query("replace_load", f"WITH {GREEN} SELECT VendorID, COUNT(*) AS row_count FROM green GROUP BY VendorID")
def replace_load(spark, sf_dir):
    name, root = f"trips_{uuid.uuid4().hex}", run_dir(spark, "replaced")
    trips = raw_trips(spark, sf_dir, "green")
    for _ in range(2):
        tables.load_table(trips, name, "replace", f"{root}/{name}")
    schema = spark.table(name).schema
    tables.drop_table(spark, name)  # the files of an external table stay
    return spark.read.schema(schema).parquet(f"{root}/{name}").groupBy("VendorID").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "partition_reload",
    f"""WITH {GREEN} SELECT CAST(year(pickup) AS BIGINT) AS year, CAST(month(pickup) AS BIGINT) AS month, COUNT(*) AS row_count,
    CAST(SUM(CASE WHEN year(pickup) = 1999 THEN 2 ELSE 1 END * CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM green GROUP BY ALL""",
)
def partition_reload(spark, sf_dir):
    """All months are loaded, then those of 1999 again with doubled amounts, twice."""
    path = run_dir(spark, "reloaded")
    t = "lpep_pickup_datetime"
    trips = raw_trips(spark, sf_dir, "green").withColumns({"year": F.year(t), "month": F.month(t)})
    trips = trips.withColumn("total_amount", F.col("total_amount").cast("decimal(18,2)"))
    tables.reload_partitions(trips, path, [])
    changed = trips.where(F.col("year") == 1999).withColumn(
        "total_amount", (F.col("total_amount") * 2).cast("decimal(18,2)")
    )
    for _ in range(2):
        tables.reload_partitions(changed, path, [(1999, m) for m in range(1, 13)])
    return spark.read.parquet(path).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("total_amount").alias("revenue")
    )


EVOLVING = struct(VendorID=INT, pickup=TIME, PULocationID=INT, DOLocationID=INT, ehail_fee=DOUBLE, total_amount=DOUBLE)


@query(
    "append_evolve",
    f"""WITH {RAW} SELECT CAST(date_trunc('month', pickup) AS DATE) AS pickup_month_start, COUNT(*) AS row_count,
    COUNT(*) FILTER (line_status = 'O') AS with_fee, COUNT(*) FILTER (line_status = 'F') AS with_new_field,
    CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM raw GROUP BY ALL""",
)
def append_evolve(spark, sf_dir):
    """One load has the fee as a whole number, the other lacks it and brings a new field."""
    path = run_dir(spark, "evolving")
    yellow = raw_trips(spark, sf_dir, "yellow").drop("ehail_fee")
    green = raw_trips(spark, sf_dir, "green").drop("ehail_fee")
    first = yellow.withColumnRenamed("tpep_pickup_datetime", "pickup").withColumn("ehail_fee", F.lit(0).cast("bigint"))
    second = green.withColumnRenamed("lpep_pickup_datetime", "pickup").withColumn("cbd_fee", F.lit(0.75))
    for load in (first, second):
        tables.append_evolving(load, path, EVOLVING, "pickup", ["PULocationID", "DOLocationID"])
    return (
        tables.read_evolving(spark, path)
        .groupBy("pickup_month_start")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count("ehail_fee").alias("with_fee"),
            F.count("cbd_fee").alias("with_new_field"),
            F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("revenue"),
        )
    )


@query(
    "ctas_profile",
    f"""WITH {RAW} SELECT COUNT(*) AS total_rows, COUNT(DISTINCT VendorID) AS unique_vendors,
    COUNT(DISTINCT PULocationID) AS unique_pickup_locations FROM raw""",
)
def ctas_profile(spark, sf_dir):
    name, root = f"copied_{uuid.uuid4().hex}", run_dir(spark, "ctas")
    tables.load_table(raw_trips(spark, sf_dir), name, "fail", f"{root}/{name}")
    schema = spark.table(name).schema
    tables.drop_table(spark, name)  # the files of an external table stay
    return distinct_counts(spark.read.schema(schema).parquet(f"{root}/{name}"))


@query(
    "ctas_partitioned",
    f"""WITH {RAW} SELECT VendorID, COUNT(*) AS row_count FROM raw
    WHERE dropoff BETWEEN TIMESTAMP '1998-03-01' AND TIMESTAMP '1998-03-15 23:59:59' GROUP BY VendorID""",
)
def ctas_partitioned(spark, sf_dir):
    path = run_dir(spark, "clustered")
    t = "trip_dropoff_datetime"
    trips = raw_trips(spark, sf_dir)
    tables.write_clustered(trips.withColumn("dropoff_date", F.to_date(t)), path, ["dropoff_date"], ["VendorID"], rows_per_file=ROWS)
    chosen = tables.time_slice(spark.read.parquet(path), t, "1998-03-01", "1998-03-15 23:59:59", "dropoff_date")
    return chosen.groupBy("VendorID").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "append_month",
    f"""WITH {GREEN} SELECT CAST(date_trunc('month', pickup) AS DATE) AS pickup_month_start, COUNT(*) AS row_count,
    COUNT(DISTINCT PULocationID) AS locations FROM green WHERE date_trunc('month', pickup) IN (DATE '1998-03-01', DATE '1998-04-01') GROUP BY ALL""",
)
def append_month(spark, sf_dir):
    """Two months appended one after the other: the second leaves the first as it was."""
    source, target, t = run_dir(spark, "months"), run_dir(spark, "appended"), "lpep_pickup_datetime"
    trips = raw_trips(spark, sf_dir, "green").withColumn("green_tripdata_", F.date_format(t, "yyyy-MM"))
    tables.rebalanced(trips, "green_tripdata_").write.partitionBy("green_tripdata_").parquet(source)
    for month in (3, 4):
        append_months(spark, source, target, "green", [(1998, month)])
    return (
        spark.read.parquet(target)
        .groupBy("pickup_month_start")
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("PULocationID").alias("locations"))
    )


@query(
    "reload_refuses",
    f"""WITH {GREEN} SELECT CAST(year(pickup) AS BIGINT) AS year, COUNT(*) AS row_count, TRUE AS refused_stray, TRUE AS refused_empty
    FROM green GROUP BY ALL""",
)
def reload_refuses(spark, sf_dir):
    """A load with a month too many and one with a month too few raise and change nothing."""
    path, t = run_dir(spark, "refusing"), "lpep_pickup_datetime"
    trips = raw_trips(spark, sf_dir, "green").withColumns({"year": F.year(t), "month": F.month(t)})
    months = sorted(tables.reload_partitions(trips, path, []))

    def refused(expected) -> bool:
        try:
            tables.reload_partitions(trips.limit(0).unionByName(trips), path, expected)
        except ValueError:
            return True
        return False

    stray, none = refused(months[1:]), refused([*months, (1900, 1)])
    return (
        spark.read.parquet(path)
        .groupBy("year")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select("year", "row_count", F.lit(stray).alias("refused_stray"), F.lit(none).alias("refused_empty"))
    )


@query(
    "model_table_clustered",
    f"""WITH {RAW} SELECT CAST(date_trunc('month', pickup) AS DATE) AS pickup_month_start, COUNT(*) AS row_count,
    CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM raw WHERE PULocationID = 7 GROUP BY ALL""",
)
def model_table_clustered(spark, sf_dir):
    """A model as a table: month partitions, clustered by both locations alike, with a bloom filter on the lookup column."""
    path, t = run_dir(spark, "model"), "trip_pickup_datetime"
    trips = raw_trips(spark, sf_dir).withColumn("pickup_month_start", F.trunc(t, "month"))
    order = ["PULocationID", "DOLocationID"]
    tables.write_clustered(trips, path, ["pickup_month_start"], order, bloom_on=["PULocationID"], rows_per_file=ROWS, z_bits=3)
    found = spark.read.parquet(path).where(F.col("PULocationID") == 7)
    return found.groupBy("pickup_month_start").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("revenue")
    )


@query(
    "sink_reset",
    f"WITH {GREEN} SELECT COUNT(*) AS loaded, CAST(0 AS BIGINT) AS after_reset, COUNT(*) AS loaded_again FROM green",
)
def sink_reset(spark, sf_dir):
    """An external table is emptied between two runs and filled again."""
    name, root = f"reset_{uuid.uuid4().hex}", run_dir(spark, "reset")
    trips = raw_trips(spark, sf_dir, "green")
    counts = []
    for step in (lambda: tables.load_table(trips, name, "append", f"{root}/{name}"), lambda: tables.reset_table(spark, name),
                 lambda: tables.load_table(trips, name, "append", f"{root}/{name}")):
        step()
        counts.append(catalog.row_count(spark, name))
    tables.drop_table(spark, name)
    return spark.createDataFrame([tuple(counts)], "loaded long, after_reset long, loaded_again long")
