"""Trip-shaped views over the star-schema sample tables.

``lineitem`` plays the trip records. Status F is the green service, status O the yellow one.
Lookups are left joins on unique keys, so a join whose columns nobody asked for is left out
without changing the rows. ``orders`` meets ``customer`` before the large table, so the large
table is shuffled once, on the order key. No join is hinted: the planner broadcasts a side only
below its size threshold and AQE splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERVICES = {"green": ("F", "lpep"), "yellow": ("O", "tpep")}


# Read once per path, so that a query over four tables does not open four footers first.
_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One sample table, zone-less timestamps turned into timestamps of the session zone (UTC)."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    df = spark.read.schema(_SCHEMAS[path]).parquet(path)
    zoneless = [f.name for f in _SCHEMAS[path].fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in zoneless}) if zoneless else df


def _minutes_after(day: str, key: str):
    return F.timestamp_add("MINUTE", F.col(key) % 1440, F.col(day))


def _hundredths(name: str):
    """A two-decimal amount as a whole number, which multiplies exactly and fast."""
    return F.floor(F.col(name) * 100 + 0.5)


def _tip():
    """price * discount, rounded half up to cents."""
    return F.floor((_hundredths("l_extendedprice") * _hundredths("l_discount") + 50) / 100) / 100.0


def _total():
    """price * (1 - discount) * (1 + tax), rounded half up to cents."""
    charged = _hundredths("l_extendedprice") * (100 - _hundredths("l_discount")) * (100 + _hundredths("l_tax"))
    return F.floor((charged + 5000) / 10000) / 100.0


def _raw_columns(prefix: str) -> dict[str, Callable[[], Column]]:
    return {
        "VendorID": lambda: (1 + F.col("l_suppkey") % 2).cast("int"),
        f"{prefix}_pickup_datetime": lambda: _minutes_after("o_orderdate", "l_partkey"),
        f"{prefix}_dropoff_datetime": lambda: _minutes_after("l_shipdate", "l_suppkey"),
        "store_and_fwd_flag": lambda: F.when(F.col("l_returnflag") == "R", "Y").when(F.col("l_returnflag") == "A", "N"),
        "RatecodeID": lambda: (1 + F.col("l_partkey") % 7).cast("int"),
        "PULocationID": lambda: F.col("c_nationkey"),
        "DOLocationID": lambda: F.col("s_nationkey"),
        "passenger_count": lambda: F.nullif(F.col("l_linenumber") - 1, F.lit(6)).cast("double"),
        "trip_distance": lambda: F.col("l_quantity"),
        "fare_amount": lambda: F.col("l_extendedprice"),
        "extra": lambda: F.col("l_discount"),
        "mta_tax": lambda: F.lit(0.5),
        "tip_amount": _tip,
        "tolls_amount": lambda: F.col("l_tax"),
        "ehail_fee": lambda: F.lit(None).cast("double"),
        "improvement_surcharge": lambda: F.lit(0.3),
        "total_amount": _total,
        "congestion_surcharge": lambda: F.when(F.col("l_linestatus") == "O", 2.5),
        "payment_type": lambda: F.col("l_linenumber"),
        "trip_type": lambda: F.when(F.col("l_returnflag") == "N", 2).otherwise(1),
    }


def _joined(spark: SparkSession, sf_dir: str, lines: DataFrame, wanted: set[str]) -> DataFrame:
    out = lines
    if wanted & {"pickup", "PULocationID"}:
        booked = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        if "PULocationID" in wanted:
            homes = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            booked = booked.join(homes, booked.o_custkey == homes.c_custkey, "left")
        out = out.join(booked, out.l_orderkey == booked.o_orderkey, "left")
    if "DOLocationID" in wanted:
        depots = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        out = out.join(depots, out.l_suppkey == depots.s_suppkey, "left")
    return out


def _both_columns() -> dict[str, Callable[[], Column]]:
    return {
        **_raw_columns("trip"),
        "service_type": lambda: F.when(F.col("l_linestatus") == "F", "Green").otherwise("Yellow"),
    }


# What the raw records of both services are computed from: fewer columns than theirs, and narrower ones.
INPUTS = [
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
    "o_orderdate",
    "c_nationkey",
    "s_nationkey",
]


def trip_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined rows of the raw records of both services, for ``as_trips``."""
    lines = table(spark, sf_dir, "lineitem")
    return _joined(spark, sf_dir, lines, {"pickup", "PULocationID", "DOLocationID"}).select(*INPUTS)


def as_trips(inputs: DataFrame) -> DataFrame:
    """The raw records of both services, row by row: ``as_trips(trip_inputs(...))`` is ``raw_trips(...)``."""
    return inputs.select(*[column().alias(name) for name, column in _both_columns().items()])


def raw_trips(
    spark: SparkSession, sf_dir: str, service: str | None = None, columns: list[str] | None = None
) -> DataFrame:
    """Raw records of one service, or of both with a ``service_type`` column when none is named.

    For one service the time columns carry its prefix; for both the prefix is ``trip``.
    ``columns`` prunes the view and with it the joins.
    """
    lines = table(spark, sf_dir, "lineitem")
    if service is None:
        available = _both_columns()
    else:
        status, prefix = SERVICES[service]
        lines = lines.where(F.col("l_linestatus") == status)
        available = _raw_columns(prefix)
    if service == "yellow":
        available.pop("ehail_fee")
        available.pop("trip_type")
    names = list(available) if columns is None else columns
    wanted = {"pickup" if n.endswith("_pickup_datetime") else n for n in names}
    joined = _joined(spark, sf_dir, lines, wanted)
    return joined.select(*[available[n]().alias(n) for n in names])


def raw_fhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For-hire records; some have no base number, some no pickup time."""
    lines = table(spark, sf_dir, "lineitem")
    joined = _joined(spark, sf_dir, lines, {"pickup", "PULocationID", "DOLocationID"})
    return joined.select(
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("dispatching_base_num"),
        F.when(F.col("l_linenumber") < 7, _minutes_after("o_orderdate", "l_partkey")).alias("pickup_datetime"),
        _minutes_after("l_shipdate", "l_suppkey").alias("dropoff_datetime"),
        F.col("c_nationkey").alias("pulocationid"),
        F.col("s_nationkey").alias("dolocationid"),
        F.when(F.col("l_linestatus") == "O", 1).alias("sr_flag"),
    )


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.when(F.col("r_name") == "AMERICA", "Yellow Zone")
        .when(F.col("r_name") == "EUROPE", "Airports")
        .otherwise("Boro Zone")
        .alias("service_zone"),
    )


def ride_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table in the shape of decoded ride messages, event time included."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("PULocationID"),
        "event_type",
        F.col("value").alias("total_amount"),
        F.col("ts").alias("event_timestamp"),
    )
