"""Staging: cast, rename, tag and filter raw records. Lazy; nothing is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.keys import surrogate_key
from meterline.functions.numbers import to_int, to_long, to_money
from meterline.functions.timeparts import elapsed_minutes

MONEY_COLUMNS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
]


def _stamp(name: str) -> Column:
    return F.col(name).cast("timestamp")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


# Staged name -> raw name and cast. "{p}" stands for the service's prefix of the time columns.
STAGED = {
    "vendor_id": ("VendorID", to_int),
    "rate_code_id": ("RatecodeID", to_int),
    "pickup_location_id": ("PULocationID", to_int),
    "dropoff_location_id": ("DOLocationID", to_int),
    "pickup_datetime": ("{p}_pickup_datetime", _stamp),
    "dropoff_datetime": ("{p}_dropoff_datetime", _stamp),
    "passenger_count": ("passenger_count", to_int),
    "trip_distance": ("trip_distance", to_money),
    "store_and_forward_flag": ("store_and_fwd_flag", _text),
    "payment_type": ("payment_type", to_int),
    **{name: (name, to_money) for name in MONEY_COLUMNS},
}
REQUIRED = ("vendor_id", "pickup_datetime", "dropoff_datetime")


def raw_columns(prefix: str, only: list[str] | None = None) -> list[str]:
    """Raw columns needed to stage the given columns (all by default)."""
    names = list(STAGED) if only is None else [n for n in STAGED if n in only or n in REQUIRED]
    return [STAGED[n][0].format(p=prefix) for n in names]


def stage_trips(raw: DataFrame, prefix: str, service: str | Column, only: list[str] | None = None) -> DataFrame:
    """The 19 staged columns shared by all metered services, or some of them.

    ``prefix`` is the service's prefix of the time columns, ``service`` a name or a Column. ``only``
    is for raw views whose columns cost a join.
    """
    sources = {n: (raw_name.format(p=prefix), cast) for n, (raw_name, cast) in STAGED.items()}
    known = raw
    for name in REQUIRED:
        known = known.where(F.col(sources[name][0]).isNotNull())
    names = [n for n in STAGED if only is None or n in only]
    return known.select(
        *[sources[n][1](sources[n][0]).alias(n) for n in names],
        (F.lit(service) if isinstance(service, str) else service).alias("service_type"),
    )


def stage_green(raw: DataFrame) -> DataFrame:
    return stage_trips(raw, "lpep", "Green")


def stage_yellow(raw: DataFrame) -> DataFrame:
    return stage_trips(raw, "tpep", "Yellow")


def stage_fhv(raw: DataFrame, require_base_num: bool = False) -> DataFrame:
    """For-hire trips. Only the pickup time is required unless ``require_base_num`` is set."""
    kept = raw.where(F.col("pickup_datetime").isNotNull())
    if require_base_num:
        kept = kept.where(F.col("dispatching_base_num").isNotNull())
    return kept.select(
        F.col("dispatching_base_num").cast("string").alias("dispatching_base_num"),
        F.col("pickup_datetime").cast("timestamp").alias("pickup_datetime"),
        F.col("dropoff_datetime").cast("timestamp").alias("dropoff_datetime"),
        to_int("pulocationid").alias("pickup_location_id"),
        to_int("dolocationid").alias("dropoff_location_id"),
        to_int("sr_flag").alias("shared_ride_flag"),
        F.lit("FHV").alias("service_type"),
    )


def stage_keyed_trips(raw: DataFrame, prefix: str = "lpep") -> DataFrame:
    """Staging of the second project: surrogate key, duration, suspicious flag and a strict filter."""
    pickup = F.col(f"{prefix}_pickup_datetime").cast("timestamp")
    dropoff = F.col(f"{prefix}_dropoff_datetime").cast("timestamp")
    # A comparison with NULL is not true, so the ordering test also drops NULL times.
    kept = raw.where((pickup < dropoff) & (F.col("trip_distance") > 0) & (F.col("fare_amount") > 0))
    doubtful = (F.col("passenger_count") < 1) | (F.col("trip_distance") <= 0) | (F.col("total_amount") <= 0)
    amounts = [c for c in MONEY_COLUMNS if c != "congestion_surcharge"]
    return kept.select(
        surrogate_key("VendorID", f"{prefix}_pickup_datetime", "PULocationID").alias("trip_id"),
        F.col("VendorID").cast("bigint").alias("vendor_id"),
        pickup.alias("pickup_datetime"),
        dropoff.alias("dropoff_datetime"),
        to_long("passenger_count").alias("passenger_count"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        to_long("PULocationID").alias("pickup_location_id"),
        to_long("DOLocationID").alias("dropoff_location_id"),
        *[F.col(c).cast("double").alias(c) for c in amounts],
        elapsed_minutes(pickup, dropoff).alias("trip_duration_minutes"),
        F.coalesce(doubtful, F.lit(False)).alias("is_suspicious"),
    )
