"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from meterline.functions.numbers import rounded
from meterline.jobs.quality_run import RATIO_RULES, monthly_suite
from meterline.operators import quality as dq
from meterline.queries.base import (
    FACT2_SQL,
    FCT_SQL,
    GREEN,
    GROWTH_SQL,
    RAW,
    STAGED_SQL,
    ZONES,
    fct,
    query,
    staged,
    zones,
)
from meterline.queries.models import PERCENTILES_SQL, _fact2, _fare_percentiles, _growth
from meterline.sources.files import drop_missing_pickup
from meterline.sources.sample import raw_trips, table

PICKUP, DROPOFF = "lpep_pickup_datetime", "lpep_dropoff_datetime"

def _ratio_sql(name: str, source: str) -> str:
    rule, limit = RATIO_RULES[name]
    ratio = f"CAST(COUNT(*) FILTER ({rule}) AS DOUBLE) / NULLIF(COUNT(*), 0)"
    return (
        f"SELECT '{name}' AS check_name, 'custom' AS kind, 'error' AS severity, ROUND({ratio}, 6) AS value, "
        f"COALESCE({ratio} < {limit}, FALSE) AS passed FROM {source}"
    )


SUITE_SQL = f"""WITH {GREEN}
SELECT 'data_freshness' AS check_name, 'row_count' AS kind, 'error' AS severity, CAST(COUNT(*) AS DOUBLE) AS value, COUNT(*) > 0 AS passed FROM green
UNION ALL SELECT 'pickup_not_null', 'null_check', 'error', CAST(COUNT(*) FILTER (pickup IS NULL) AS DOUBLE), COUNT(*) FILTER (pickup IS NULL) = 0 FROM green
UNION ALL SELECT 'dropoff_not_null', 'null_check', 'error', CAST(COUNT(*) FILTER (dropoff IS NULL) AS DOUBLE), COUNT(*) FILTER (dropoff IS NULL) = 0 FROM green
UNION ALL SELECT 'trip_distances', 'range_check', 'error', MAX(trip_distance), MAX(trip_distance) <= 200 FROM green
UNION ALL """ + " UNION ALL ".join(_ratio_sql(n, "green") for n in RATIO_RULES)


@query("dq_report", SUITE_SQL)
def dq_report(spark, sf_dir):
    report = dq.run_checks(raw_trips(spark, sf_dir, "green"), monthly_suite(PICKUP, DROPOFF))
    return report.withColumn("value", rounded("value", 6))


@query("dq_ratio_checks", f"WITH {RAW} " + " UNION ALL ".join(_ratio_sql(n, "raw") for n in RATIO_RULES))
def dq_ratio_checks(spark, sf_dir):
    checks = [c for c in monthly_suite(PICKUP, DROPOFF) if c.kind == "custom"]
    columns = ["passenger_count", "total_amount", "PULocationID", "DOLocationID"]
    return dq.run_checks(raw_trips(spark, sf_dir, None, columns), checks).withColumn("value", rounded("value", 6))


def _rule_sql(test: str, column: str, broken: str, source: str, severity: str = "error") -> str:
    return (
        f"SELECT '{test}' AS test, '{column}' AS column_name, '{severity}' AS severity, "
        f"COUNT(*) FILTER ({broken}) AS failures, COUNT(*) FILTER ({broken}) = 0 AS passed FROM {source}"
    )


NOT_NULL = ["vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "service_type", "store_and_forward_flag"]


@query("dq_not_null", f"WITH {STAGED_SQL} " + " UNION ALL ".join(_rule_sql("not_null", c, f"{c} IS NULL", "staged") for c in NOT_NULL))
def dq_not_null(spark, sf_dir):
    return dq.run_rules(staged(spark, sf_dir, NOT_NULL), [dq.not_null(c) for c in NOT_NULL])


ACCEPTED = {
    "vendor_id": [1, 2],
    "payment_type": [1, 2, 3, 4, 5, 6],
    "service_type": ["Green", "Yellow"],
    "store_and_forward_flag": ["Y"],
}


@query(
    "dq_accepted_values",
    f"WITH {STAGED_SQL} "
    + " UNION ALL ".join(
        _rule_sql("accepted_values", c, f"{c} NOT IN ({', '.join(repr(v) for v in values)})", "staged")
        for c, values in ACCEPTED.items()
    ),
)
def dq_accepted_values(spark, sf_dir):
    rules = [dq.accepted_values(c, values) for c, values in ACCEPTED.items()]
    return dq.run_rules(staged(spark, sf_dir, list(ACCEPTED)), rules)


@query(
    "dq_unique",
    f"""WITH {FACT2_SQL}, {ZONES},
    a AS (SELECT trip_id FROM fact2 GROUP BY trip_id HAVING COUNT(*) > 1),
    b AS (SELECT location_id FROM zones GROUP BY location_id HAVING COUNT(*) > 1)
    SELECT 'unique' AS test, 'trip_id' AS column_name, 'error' AS severity, COUNT(*) AS failures, COUNT(*) = 0 AS passed FROM a
    UNION ALL SELECT 'unique', 'location_id', 'error', COUNT(*), COUNT(*) = 0 FROM b""",
)
def dq_unique(spark, sf_dir):
    return dq.combine(dq.unique(_fact2(spark, sf_dir), "trip_id"), dq.unique(zones(spark, sf_dir), "location_id"))


@query(
    "dq_relationships",
    f"""WITH {STAGED_SQL}, {ZONES}, some_zones AS (SELECT * FROM zones WHERE borough <> 'ASIA')
    SELECT 'relationships' AS test, 'pickup_location_id' AS column_name, 'error' AS severity, COUNT(*) AS failures, COUNT(*) = 0 AS passed
    FROM staged ANTI JOIN zones ON pickup_location_id = location_id WHERE pickup_location_id IS NOT NULL
    UNION ALL SELECT 'relationships', 'dropoff_location_id', 'error', COUNT(*), COUNT(*) = 0
    FROM staged ANTI JOIN some_zones ON dropoff_location_id = location_id WHERE dropoff_location_id IS NOT NULL""",
)
def dq_relationships(spark, sf_dir):
    # The second test runs against an incomplete dimension, so that there are orphans to count.
    trips, parents = staged(spark, sf_dir, ["pickup_location_id", "dropoff_location_id"]), zones(spark, sf_dir)
    return dq.combine(
        dq.relationships(trips, "pickup_location_id", parents, "location_id"),
        dq.relationships(trips, "dropoff_location_id", parents.where("borough <> 'ASIA'"), "location_id"),
    )


@query(
    "dq_expression",
    f"WITH {GROWTH_SQL}, {PERCENTILES_SQL.split(FCT_SQL + ', ', 1)[1]} "
    + " UNION ALL ".join(
        [
            _rule_sql("expression_is_true", "revenue", "NOT (revenue >= 0)", "growth"),
            _rule_sql("expression_is_true", "mom_growth_pct", "NOT (mom_growth_pct >= -10)", "growth", "warn"),
            _rule_sql("expression_is_true", "revenue_per_trip", "NOT (revenue_per_trip > 0) AND trip_count > 0", "growth"),
            _rule_sql("expression_is_true", "p95_fare", "NOT (p95_fare >= p90_fare)", "percentiles", "warn"),
            _rule_sql("expression_is_true", "p97_fare", "NOT (p97_fare >= p95_fare)", "percentiles", "warn"),
        ]
    ),
)
def dq_expression(spark, sf_dir):
    growth = [
        dq.expression_is_true("revenue", ">= 0"),
        dq.expression_is_true("mom_growth_pct", ">= -10", severity="warn"),
        dq.expression_is_true("revenue_per_trip", "> 0", where="trip_count > 0"),
    ]
    order = [
        dq.expression_is_true("p95_fare", ">= p90_fare", severity="warn"),
        dq.expression_is_true("p97_fare", ">= p95_fare", severity="warn"),
    ]
    return dq.combine(
        dq.run_rules(_growth(spark, sf_dir), growth), dq.run_rules(_fare_percentiles(spark, sf_dir), order)
    )


@query("dq_positive_fares", f"WITH {RAW} SELECT payment_type, fare_amount FROM raw WHERE fare_amount - tip_amount * 10 <= 0")
def dq_positive_fares(spark, sf_dir):
    # Fares here are all positive. The same test on fare less ten tips returns rows.
    trips = raw_trips(spark, sf_dir, None, ["payment_type", "fare_amount", "tip_amount"])
    return trips.where(F.col("fare_amount") - F.col("tip_amount") * 10 <= 0).select("payment_type", "fare_amount")


@query(
    "dq_freshness",
    f"""WITH {GREEN}, n AS (SELECT MAX(pickup) AS newest FROM green),
    a AS (SELECT newest, epoch(TIMESTAMP '2001-08-03 00:00:00') / 3600 - epoch(newest) / 3600 AS hours FROM n)
    SELECT newest, ROUND(hours, 4) AS age_hours, CASE WHEN hours > 48 THEN 'error' WHEN hours > 24 THEN 'warn' ELSE 'pass' END AS status FROM a""",
)
def dq_freshness(spark, sf_dir):
    raw = raw_trips(spark, sf_dir, "green", [PICKUP])
    out = dq.freshness(raw, PICKUP, F.lit("2001-08-03 00:00:00").cast("timestamp"))
    return out.withColumn("age_hours", rounded("age_hours", 4))


ROW_RULES = {
    "total_not_positive": ("total_amount <= 0", "total_amount <= 0"),
    "distance_out_of_range": ("NOT trip_distance BETWEEN 0 AND 100", "NOT trip_distance BETWEEN 0 AND 100"),
    "passengers_out_of_range": ("NOT passenger_count BETWEEN 1 AND 6", "NOT passenger_count BETWEEN 1 AND 6"),
    "dropoff_not_after_pickup": ("trip_dropoff_datetime <= trip_pickup_datetime", "dropoff <= pickup"),
    "bad_location": ("PULocationID < 1 OR DOLocationID < 1", "PULocationID < 1 OR DOLocationID < 1"),
}


@query(
    "dq_row_rules",
    f"WITH {RAW} SELECT " + ", ".join(f"COUNT(*) FILTER ({sql}) AS {n}" for n, (_, sql) in ROW_RULES.items()) + " FROM raw",
)
def dq_row_rules(spark, sf_dir):
    return raw_trips(spark, sf_dir).agg(*[F.count_if(F.expr(rule)).alias(n) for n, (rule, _) in ROW_RULES.items()])


@query(
    "valid_split",
    f"""WITH {RAW} SELECT COALESCE(trip_distance >= 0 AND trip_distance < 100 AND total_amount > 0 AND total_amount < 50000, FALSE) AS is_valid, COUNT(*) AS trip_count FROM raw GROUP BY ALL""",
)
def valid_split(spark, sf_dir):
    trips = raw_trips(spark, sf_dir, None, ["trip_distance", "total_amount"])
    tagged = dq.split_valid(trips, "trip_distance >= 0 AND trip_distance < 100 AND total_amount > 0 AND total_amount < 50000")
    return tagged.groupBy("is_valid").agg(F.count(F.lit(1)).alias("trip_count"))


@query(
    "partition_validation",
    f"""WITH {RAW} SELECT COUNT(*) AS row_count, MIN(pickup) AS earliest_pickup, MAX(pickup) AS latest_pickup,
    COUNT(*) FILTER (pickup < TIMESTAMP '1998-03-01' OR pickup >= TIMESTAMP '1998-04-01') AS stray_rows
    FROM raw WHERE year(dropoff) = 1998 AND month(dropoff) = 3""",
)
def partition_validation(spark, sf_dir):
    # The partition is the month of the dropoff, so trips begun in another month are strays.
    t = "trip_dropoff_datetime"
    trips = raw_trips(spark, sf_dir, None, ["trip_pickup_datetime", t])
    part = trips.where((F.year(t) == 1998) & (F.month(t) == 3))
    return dq.partition_validation(part, "trip_pickup_datetime", "1998-03-01", "1998-04-01")


@query(
    "reconcile_counts",
    f"""WITH {FCT_SQL}, s AS (SELECT line_status, year(pickup) AS y, COUNT(*) AS n FROM raw GROUP BY ALL),
    t AS (SELECT service_type, pickup_year AS y, COUNT(*) AS n FROM good GROUP BY ALL),
    named AS (SELECT CASE line_status WHEN 'F' THEN 'Green' ELSE 'Yellow' END AS service_type, CAST(y AS BIGINT) AS year, n FROM s)
    SELECT COALESCE(a.service_type, b.service_type) AS service_type, COALESCE(a.year, b.y) AS year, COALESCE(a.n, 0) AS source_rows,
    COALESCE(b.n, 0) AS target_rows, COALESCE(a.n, 0) = COALESCE(b.n, 0) AS is_match,
    ROUND(CAST(100.0 AS DOUBLE) * abs(COALESCE(a.n, 0) - COALESCE(b.n, 0)) / NULLIF(COALESCE(a.n, 0), 0), 2) AS diff_pct
    FROM named a FULL JOIN t b ON a.service_type = b.service_type AND a.year = b.y""",
)
def reconcile_counts(spark, sf_dir):
    raw = raw_trips(spark, sf_dir, None, ["trip_pickup_datetime", "service_type"])
    source = raw.select("service_type", F.year("trip_pickup_datetime").alias("year"))
    kept = fct(spark, sf_dir, []).where(~F.col("is_invalid_trip"))
    return dq.reconcile(source, kept.select("service_type", F.col("pickup_year").alias("year")), ["service_type", "year"])


@query(
    "dropna_count",
    f"""WITH {GREEN} SELECT COUNT(*) FILTER (passenger_count IS NULL) AS dropped, COUNT(passenger_count) AS kept FROM green""",
)
def dropna_count(spark, sf_dir):
    """Trips without passengers lose their pickup time, then the operator drops and counts them."""
    seen, pickup = Observation(), F.when(F.col("passenger_count").isNotNull(), F.col(PICKUP))
    trips = raw_trips(spark, sf_dir, "green", ["passenger_count", PICKUP]).withColumn(PICKUP, pickup)
    kept = drop_missing_pickup(trips, "green", seen).agg(F.count(F.lit(1)).alias("kept")).first()["kept"]
    return spark.createDataFrame([(seen.get["dropped"], kept)], "dropped long, kept long")


COMPARED = {"eq": ("=", 5), "gt": (">", 0), "gte": (">=", 50), "lt": ("<", 51), "lte": ("<=", 49)}


@query(
    "dq_comparators",
    " UNION ALL ".join(
        f"""SELECT 'quantity_{n}' AS check_name, 'custom' AS kind, 'error' AS severity, CAST(MAX(l_quantity) AS DOUBLE) AS value,
        MAX(l_quantity) {sign} {limit} AS passed FROM lineitem"""
        for n, (sign, limit) in COMPARED.items()
    ),
)
def dq_comparators(spark, sf_dir):
    checks = [
        dq.Check(f"quantity_{n}", "custom", threshold=limit, comparison=n, expression="max(l_quantity)")
        for n, (_, limit) in COMPARED.items()
    ]
    return dq.run_checks(table(spark, sf_dir, "lineitem"), checks)


@query(
    "dq_partition_filter",
    """SELECT 'rows_of_1998' AS check_name, 'row_count' AS kind, 'error' AS severity,
    CAST(COUNT(*) FILTER (year(l_shipdate) = 1998) AS DOUBLE) AS value, COUNT(*) FILTER (year(l_shipdate) = 1998) > 0 AS passed FROM lineitem
    UNION ALL SELECT 'quantity_of_1998', 'range_check', 'warn', CAST(MAX(l_quantity) FILTER (year(l_shipdate) = 1998) AS DOUBLE),
    COALESCE(MAX(l_quantity) FILTER (year(l_shipdate) = 1998) <= 40 AND MIN(l_quantity) FILTER (year(l_shipdate) = 1998) >= 1, FALSE) FROM lineitem""",
)
def dq_partition_filter(spark, sf_dir):
    """Checks that see one partition only."""
    one_year = "year(l_shipdate) = 1998"
    checks = [
        dq.Check("rows_of_1998", "row_count", where=one_year),
        dq.Check("quantity_of_1998", "range_check", "l_quantity", 40, "lte", minimum=1, where=one_year, severity="warn"),
    ]
    return dq.run_checks(table(spark, sf_dir, "lineitem"), checks)
