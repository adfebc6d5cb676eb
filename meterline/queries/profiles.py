"""Profiles of the raw trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.functions.numbers import rounded
from meterline.operators import profile
from meterline.queries.base import RAW, query
from meterline.sources.sample import raw_trips, table

NUMERIC = [
    "VendorID", "RatecodeID", "PULocationID", "DOLocationID", "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax",
    "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge", "payment_type", "trip_type",
]


def _describe_sql(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, COUNT({column}) AS value_count, ROUND(AVG({column}), 4) AS mean_value,
    ROUND(STDDEV({column}), 4) AS std_value, MIN({column}) AS min_value, MAX({column}) AS max_value,
    ROUND(quantile_cont({column}, 0.25), 4) AS q25_value, ROUND(quantile_cont({column}, 0.5), 4) AS q50_value,
    ROUND(quantile_cont({column}, 0.75), 4) AS q75_value FROM raw"""


@query("describe_numeric", f"WITH {RAW} " + " UNION ALL ".join(_describe_sql(c) for c in NUMERIC))
def describe_numeric(spark, sf_dir):
    rows = profile.describe(raw_trips(spark, sf_dir, None, NUMERIC), NUMERIC)
    figures = ("mean_value", "std_value", "q25_value", "q50_value", "q75_value")
    return rows.withColumns({c: rounded(c, 4) for c in figures})


@query(
    "missing_profile",
    f"""WITH {RAW} SELECT * FROM (""" + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS missing_count,
        ROUND(CAST(100.0 AS DOUBLE) * COUNT(*) FILTER ({c} IS NULL) / COUNT(*), 2) AS missing_pct FROM raw"""
        for c in ("VendorID", "store_and_fwd_flag", "passenger_count", "trip_distance", "ehail_fee",
                  "congestion_surcharge", "payment_type", "PULocationID", "DOLocationID", "total_amount")
    ) + ") WHERE missing_count > 0",
)
def missing_profile(spark, sf_dir):
    return profile.missing_values(raw_trips(spark, sf_dir))


@query(
    "duplicate_count",
    "SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicate_rows FROM lineitem",
)
def duplicate_count(spark, sf_dir):
    return profile.duplicate_rows(table(spark, sf_dir, "lineitem"))


ANOMALIES = {
    "negative_distance": "trip_distance < 0",
    "negative_amount": "total_amount < 0",
    "extreme_distance": "trip_distance > 100",
    "extreme_amount": "total_amount > 500",
}


@query(
    "anomaly_counts",
    f"WITH {RAW} SELECT " + ", ".join(f"COUNT(*) FILTER ({c}) AS {n}" for n, c in ANOMALIES.items()) + " FROM raw",
)
def anomaly_counts(spark, sf_dir):
    trips = raw_trips(spark, sf_dir, None, ["trip_distance", "total_amount"])
    return profile.count_matching(trips, {n: F.expr(c) for n, c in ANOMALIES.items()})


@query(
    "median_mean",
    f"WITH {RAW} SELECT ROUND(quantile_cont(total_amount, 0.5), 4) AS median_value, ROUND(AVG(total_amount), 4) AS mean_value FROM raw",
)
def median_mean(spark, sf_dir):
    return profile.median_and_mean(raw_trips(spark, sf_dir, None, ["total_amount"]), "total_amount").select(
        rounded("median_value", 4).alias("median_value"), rounded("mean_value", 4).alias("mean_value")
    )


@query(
    "histogram",
    f"""WITH {RAW}, kept AS (SELECT trip_distance AS v FROM raw WHERE trip_distance < 100),
    b AS (SELECT MIN(v) AS lo, MAX(v) AS hi FROM kept),
    binned AS (SELECT CAST(COALESCE(LEAST(floor((v - lo) / NULLIF(hi - lo, 0) * 50), 49), 0) AS BIGINT) AS bin, lo, hi - lo AS width FROM kept, b)
    SELECT bin, ROUND(lo + bin * width / 50, 6) AS bin_start, ROUND(lo + (bin + 1) * width / 50, 6) AS bin_end, COUNT(*) AS value_count
    FROM binned GROUP BY bin, lo, width""",
)
def histogram(spark, sf_dir):
    bins = profile.histogram(raw_trips(spark, sf_dir, None, ["trip_distance"]), "trip_distance", 50, 100.0)
    return bins.withColumns({c: rounded(c, 6) for c in ("bin_start", "bin_end")})


@query(
    "box_stats",
    f"""WITH {RAW}, q AS (SELECT payment_type, quantile_cont(fare_amount, 0.25) AS q1, quantile_cont(fare_amount, 0.5) AS median,
    quantile_cont(fare_amount, 0.75) AS q3 FROM raw GROUP BY payment_type)
    SELECT payment_type, ROUND(q1, 4) AS q1, ROUND(median, 4) AS median, ROUND(q3, 4) AS q3,
    ROUND(q1 - 1.5 * (q3 - q1), 4) AS lower_fence, ROUND(q3 + 1.5 * (q3 - q1), 4) AS upper_fence FROM q""",
)
def box_stats(spark, sf_dir):
    rows = profile.box_stats(raw_trips(spark, sf_dir, None, ["payment_type", "fare_amount"]), "fare_amount", ["payment_type"])
    return rows.withColumns({c: rounded(c, 4) for c in ("q1", "median", "q3", "lower_fence", "upper_fence")})


@query(
    "short_trip_share",
    f"""WITH {RAW} SELECT COUNT(*) FILTER (trip_distance <= 1) AS matching, COUNT(*) AS total,
    ROUND(CAST(100.0 AS DOUBLE) * COUNT(*) FILTER (trip_distance <= 1) / COUNT(*), 2) AS matching_pct FROM raw""",
)
def short_trip_share(spark, sf_dir):
    return profile.match_share(raw_trips(spark, sf_dir, None, ["trip_distance"]), F.col("trip_distance") <= 1)
