"""Registry and shared views."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.plans.marts import dim_zones, fct_trips
from meterline.plans.staging import raw_columns, stage_trips
from meterline.session import pin_settings
from meterline.sources.sample import raw_trips, raw_zones


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    """Plain result types: whole numbers as BIGINT, decimals as DOUBLE, times in UTC."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, T.TimestampNTZType):
            c = c.cast("timestamp")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    def register(fn):
        REGISTRY[name] = Query(lambda spark, sf_dir: present(fn(pin_settings(spark), sf_dir)), sql)
        return fn

    return register


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_zones(raw_zones(spark, sf_dir))


def staged(spark: SparkSession, sf_dir: str, only: list[str] | None = None) -> DataFrame:
    """Both services staged in one scan: the service is a column of the raw view."""
    names = [*raw_columns("trip", only), "service_type"]
    return stage_trips(raw_trips(spark, sf_dir, None, names), "trip", F.col("service_type"), only)


FLAG_INPUTS = ["pickup_datetime", "dropoff_datetime", "trip_distance", "fare_amount"]


def fct(spark: SparkSession, sf_dir: str, only: list[str] | None = None) -> DataFrame:
    """The trip facts. ``only`` lists staged columns needed besides those of the flags."""
    return fct_trips(staged(spark, sf_dir, None if only is None else [*FLAG_INPUTS, *only]))


# --- SQL building blocks, for DuckDB -------------------------------------------------------------

RAW = """raw AS (
  SELECT l_linestatus AS line_status,
         1 + l_suppkey % 2 AS VendorID,
         o_orderdate + (l_partkey % 1440) * INTERVAL 1 MINUTE AS pickup,
         l_shipdate + (l_suppkey % 1440) * INTERVAL 1 MINUTE AS dropoff,
         CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN 'N' END AS store_and_fwd_flag,
         1 + l_partkey % 7 AS RatecodeID,
         CAST(c_nationkey AS BIGINT) AS PULocationID,
         CAST(s_nationkey AS BIGINT) AS DOLocationID,
         CAST(NULLIF(l_linenumber - 1, 6) AS DOUBLE) AS passenger_count,
         l_quantity AS trip_distance,
         l_extendedprice AS fare_amount,
         l_discount AS extra,
         CAST(0.5 AS DOUBLE) AS mta_tax,
         CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS DOUBLE) AS tip_amount,
         l_tax AS tolls_amount,
         CAST(NULL AS DOUBLE) AS ehail_fee,
         CAST(0.3 AS DOUBLE) AS improvement_surcharge,
         CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
              * (CAST(1 AS DECIMAL(4,2)) + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
         CASE WHEN l_linestatus = 'O' THEN CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
         CAST(l_linenumber AS BIGINT) AS payment_type,
         CASE WHEN l_returnflag = 'N' THEN CAST(2 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS trip_type
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
       LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey)"""

GREEN = RAW + ", green AS (SELECT * FROM raw WHERE line_status = 'F')"

ZONES = """zones AS (
  SELECT CAST(n_nationkey AS BIGINT) AS location_id, r_name AS borough, n_name AS zone,
         CASE r_name WHEN 'AMERICA' THEN 'Yellow Zone' WHEN 'EUROPE' THEN 'Airports' ELSE 'Boro Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

MONEY_SQL = ", ".join(
    f"CAST({c} AS DECIMAL(18,3)) AS {c}"
    for c in (
        "fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "improvement_surcharge",
        "total_amount",
        "congestion_surcharge",
    )
)

STAGED_SQL = RAW + f""", staged AS (
  SELECT VendorID AS vendor_id, RatecodeID AS rate_code_id, PULocationID AS pickup_location_id,
         DOLocationID AS dropoff_location_id, pickup AS pickup_datetime, dropoff AS dropoff_datetime,
         CAST(passenger_count AS BIGINT) AS passenger_count, CAST(trip_distance AS DECIMAL(18,3)) AS trip_distance,
         store_and_fwd_flag AS store_and_forward_flag, payment_type, {MONEY_SQL},
         CASE line_status WHEN 'F' THEN 'Green' ELSE 'Yellow' END AS service_type
  FROM raw WHERE VendorID IS NOT NULL AND pickup IS NOT NULL AND dropoff IS NOT NULL)"""

FCT_SQL = STAGED_SQL + """, fct AS (
  SELECT *, epoch(dropoff_datetime) - epoch(pickup_datetime) AS trip_duration_seconds,
         date_diff('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes,
         COALESCE(epoch(dropoff_datetime) <= epoch(pickup_datetime) OR trip_distance <= 0 OR fare_amount <= 0, FALSE) AS is_invalid_trip,
         CAST(pickup_datetime AS DATE) AS pickup_date,
         CAST(year(pickup_datetime) AS BIGINT) AS pickup_year, CAST(month(pickup_datetime) AS BIGINT) AS pickup_month,
         CAST(dayofweek(pickup_datetime) AS BIGINT) AS pickup_dayofweek, CAST(hour(pickup_datetime) AS BIGINT) AS pickup_hour
  FROM staged), good AS (SELECT * FROM fct WHERE NOT is_invalid_trip)"""

ZONE_REVENUE_SQL = FCT_SQL + ", " + ZONES + """, zone_revenue AS (
  SELECT service_type, pickup_year, pickup_month, pickup_location_id, zone AS pickup_zone, borough AS pickup_borough,
         COUNT(*) AS total_monthly_trips, SUM(fare_amount) AS revenue_monthly_fare,
         SUM(total_amount) AS revenue_monthly_total_amount,
         CAST(SUM(trip_distance) AS DOUBLE) / COUNT(trip_distance) AS avg_trip_distance,
         CAST(SUM(trip_duration_minutes) AS DOUBLE) / COUNT(trip_duration_minutes) AS avg_trip_duration_minutes
  FROM good LEFT JOIN zones ON pickup_location_id = location_id
  GROUP BY ALL)"""

GROWTH_SQL = FCT_SQL + ", " + ZONES + """, monthly AS (
  SELECT service_type, zone AS pickup_zone, borough AS pickup_borough, pickup_year AS year,
         pickup_month AS month_number, date_trunc('month', pickup_datetime) AS month,
         SUM(total_amount) AS revenue, COUNT(*) AS trip_count
  FROM good JOIN zones ON pickup_location_id = location_id WHERE zone IS NOT NULL GROUP BY ALL),
lagged AS (
  SELECT *, LAG(revenue) OVER w AS prev_revenue, LAG(trip_count) OVER w AS prev_trips
  FROM monthly WINDOW w AS (PARTITION BY service_type, pickup_zone ORDER BY year, month_number)),
growth AS (
  SELECT service_type, pickup_zone, pickup_borough, year, month_number, CAST(month AS TIMESTAMP) AS month,
         ROUND(revenue, 2) AS revenue, trip_count, ROUND(prev_revenue, 2) AS prev_month_revenue,
         prev_trips AS prev_month_trip_count,
         ROUND(100.0 * (CAST(revenue AS DOUBLE) - CAST(prev_revenue AS DOUBLE)) / NULLIF(CAST(prev_revenue AS DOUBLE), 0), 2) AS mom_growth_pct,
         ROUND(CAST(100.0 AS DOUBLE) * (trip_count - prev_trips) / NULLIF(prev_trips, 0), 2) AS mom_trip_growth_pct,
         ROUND(CAST(revenue AS DOUBLE) / NULLIF(trip_count, 0), 2) AS revenue_per_trip
  FROM lagged)"""

KEYED_SQL = """keyed AS (
  SELECT md5(concat_ws('-', CAST(VendorID AS VARCHAR), CAST(pickup AS VARCHAR), CAST(PULocationID AS VARCHAR))) AS trip_id,
         VendorID AS vendor_id, pickup AS pickup_datetime, dropoff AS dropoff_datetime,
         CAST(passenger_count AS BIGINT) AS passenger_count, trip_distance,
         PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id,
         fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
         CAST(floor((epoch(dropoff) - epoch(pickup)) / 60) AS BIGINT) AS trip_duration_minutes,
         COALESCE(passenger_count < 1 OR trip_distance <= 0 OR total_amount <= 0, FALSE) AS is_suspicious
  FROM {source} WHERE pickup < dropoff AND trip_distance > 0 AND fare_amount > 0)"""

FACT2_SQL = GREEN + ", " + KEYED_SQL.format(source="green") + """, fact2 AS (
  SELECT trip_id, vendor_id, pickup_location_id, dropoff_location_id, pickup_datetime, dropoff_datetime,
         CAST(pickup_datetime AS DATE) AS pickup_date, CAST(year(pickup_datetime) AS BIGINT) AS pickup_year,
         CAST(month(pickup_datetime) AS BIGINT) AS pickup_month, CAST(day(pickup_datetime) AS BIGINT) AS pickup_day,
         CAST(dayofweek(pickup_datetime) + 1 AS BIGINT) AS pickup_dayofweek, CAST(hour(pickup_datetime) AS BIGINT) AS pickup_hour,
         passenger_count, trip_distance, trip_duration_minutes, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
         improvement_surcharge, total_amount,
         ROUND(trip_distance / NULLIF(trip_duration_minutes, 0) * 60, 2) AS avg_speed_mph,
         ROUND(total_amount / NULLIF(trip_distance, 0), 2) AS revenue_per_mile
  FROM keyed WHERE NOT is_suspicious)"""


def as_double(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


def replaced(relation: str, *names: str) -> str:
    """All columns of a relation, the named ones as DOUBLE."""
    return f"SELECT * REPLACE ({as_double(*names)}) FROM {relation}"
