"""Reports over raw trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.functions.numbers import nan_to_null
from meterline.functions.labels import payment_label, rate_label
from meterline.operators.ranking import extreme_days, top_n
from meterline.plans import reports
from meterline.queries.base import GREEN, RAW, ZONES, query, zones
from meterline.sinks.tables import time_slice
from meterline.sources.files import head_n
from meterline.sources.sample import raw_trips, table

FIRST, AFTER, DAY, ZONE = "1997-11-01", "1997-12-01", "1997-11-18", "NATION_7"
PICKUP, DROPOFF = "lpep_pickup_datetime", "lpep_dropoff_datetime"


@query(
    "top_zone_revenue",
    f"""WITH {GREEN}, {ZONES} SELECT zone, CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
    FROM green JOIN zones ON PULocationID = location_id WHERE CAST(pickup AS DATE) = DATE '{DAY}'
    GROUP BY zone ORDER BY total_revenue DESC, zone LIMIT 1""",
)
def top_zone_revenue(spark, sf_dir):
    trips = raw_trips(spark, sf_dir, "green", [PICKUP, "PULocationID", "total_amount"])
    return reports.zone_revenue_of_day(trips, zones(spark, sf_dir), PICKUP, DAY)


@query(
    "max_tip_by_dropoff",
    f"""WITH {GREEN}, {ZONES} SELECT e.zone AS dropoff_zone, MAX(tip_amount) AS max_tip
    FROM green JOIN zones s ON PULocationID = s.location_id JOIN zones e ON DOLocationID = e.location_id
    WHERE s.zone = '{ZONE}' AND pickup >= TIMESTAMP '{FIRST}' AND pickup < TIMESTAMP '{AFTER}'
    GROUP BY e.zone ORDER BY max_tip DESC, dropoff_zone LIMIT 1""",
)
def max_tip_by_dropoff(spark, sf_dir):
    trips = raw_trips(spark, sf_dir, "green", [PICKUP, "PULocationID", "DOLocationID", "tip_amount"])
    return reports.best_tip_by_dropoff(trips, zones(spark, sf_dir), PICKUP, ZONE, FIRST, AFTER)


@query(
    "short_trips",
    f"""WITH {GREEN} SELECT COUNT(*) AS short_trips FROM green
    WHERE pickup >= TIMESTAMP '{FIRST}' AND pickup < TIMESTAMP '{AFTER}' AND trip_distance <= 1""",
)
def short_trips(spark, sf_dir):
    return reports.short_trips(raw_trips(spark, sf_dir, "green", [PICKUP, "trip_distance"]), PICKUP, FIRST, AFTER)


@query(
    "longest_per_day",
    f"""WITH {GREEN} SELECT CAST(pickup AS DATE) AS pickup_day, MAX(trip_distance) AS max_distance FROM green
    WHERE pickup >= TIMESTAMP '{FIRST}' AND pickup < TIMESTAMP '{AFTER}' AND trip_distance < 100
    GROUP BY pickup_day ORDER BY max_distance DESC, pickup_day LIMIT 1""",
)
def longest_per_day(spark, sf_dir):
    trips = raw_trips(spark, sf_dir, "green", [PICKUP, "trip_distance"])
    return top_n(reports.longest_per_day(trips, PICKUP, FIRST, AFTER), "max_distance", 1, ["pickup_day"])


@query("trips_on_day", f"WITH {GREEN} SELECT COUNT(*) AS trip_count FROM green WHERE CAST(pickup AS DATE) = DATE '{DAY}'")
def trips_on_day(spark, sf_dir):
    return reports.trips_on_day(raw_trips(spark, sf_dir, "green", [PICKUP]), PICKUP, DAY)


@query(
    "longest_duration",
    f"WITH {GREEN} SELECT CAST(MAX((epoch(dropoff) - epoch(pickup)) / 3600) AS DOUBLE) AS max_hours FROM green",
)
def longest_duration(spark, sf_dir):
    return reports.longest_duration(raw_trips(spark, sf_dir, "green", [PICKUP, DROPOFF]), PICKUP, DROPOFF)


@query(
    "rare_pickup_zones",
    f"""WITH {RAW}, {ZONES}, counts AS (SELECT PULocationID, COUNT(*) AS trip_count FROM raw GROUP BY PULocationID)
    SELECT PULocationID, zone, trip_count FROM counts LEFT JOIN zones ON PULocationID = location_id
    ORDER BY trip_count, PULocationID LIMIT 10""",
)
def rare_pickup_zones(spark, sf_dir):
    return reports.rare_pickup_zones(raw_trips(spark, sf_dir, None, ["PULocationID"]), zones(spark, sf_dir))


@query(
    "top_pickup_zones",
    f"""WITH {RAW}, {ZONES}, best AS (SELECT PULocationID, COUNT(*) AS trip_count FROM raw GROUP BY PULocationID
    ORDER BY trip_count DESC, PULocationID LIMIT 10)
    SELECT PULocationID, zone, trip_count FROM best JOIN zones ON PULocationID = location_id""",
)
def top_pickup_zones(spark, sf_dir):
    return reports.top_pickup_zones(raw_trips(spark, sf_dir, None, ["PULocationID"]), zones(spark, sf_dir))


@query("count_all", "SELECT COUNT(*) AS total_rows FROM lineitem")
def count_all(spark, sf_dir):
    return raw_trips(spark, sf_dir, None, ["VendorID"]).agg(F.count(F.lit(1)).alias("total_rows"))


@query(
    "zero_fare",
    f"""WITH {RAW} SELECT COUNT(*) FILTER (fare_amount = 0) AS zero_fare_trips,
    COUNT(*) FILTER (tip_amount = 0) AS zero_tip_trips FROM raw""",
)
def zero_fare(spark, sf_dir):
    trips = raw_trips(spark, sf_dir, None, ["fare_amount", "tip_amount"])
    return trips.agg(
        F.count_if(F.col("fare_amount") == 0).alias("zero_fare_trips"),
        F.count_if(F.col("tip_amount") == 0).alias("zero_tip_trips"),
    )


@query("long_trips", f"WITH {RAW} SELECT COUNT(*) AS long_trips FROM raw WHERE trip_distance > 5.0")
def long_trips(spark, sf_dir):
    trips = raw_trips(spark, sf_dir, None, ["trip_distance"])
    return reports.count_where(trips, F.col("trip_distance") > 5.0, "long_trips")


@query(
    "distinct_counts",
    f"""WITH {RAW} SELECT COUNT(*) AS total_rows, COUNT(DISTINCT VendorID) AS unique_vendors,
    COUNT(DISTINCT PULocationID) AS unique_pickup_locations FROM raw""",
)
def distinct_counts(spark, sf_dir):
    return reports.distinct_counts(raw_trips(spark, sf_dir, None, ["VendorID", "PULocationID"]))


@query(
    "distinct_between",
    f"""WITH {RAW} SELECT DISTINCT VendorID FROM raw
    WHERE dropoff BETWEEN TIMESTAMP '1998-03-01' AND TIMESTAMP '1998-03-15 23:59:59'""",
)
def distinct_between(spark, sf_dir):
    from meterline.sinks.tables import time_slice

    trips = raw_trips(spark, sf_dir, None, ["VendorID", "trip_dropoff_datetime"])
    return time_slice(trips, "trip_dropoff_datetime", "1998-03-01", "1998-03-15 23:59:59").select("VendorID").distinct()


@query(
    "time_extent",
    f"WITH {RAW} SELECT COUNT(*) AS total_rows, MIN(pickup) AS earliest_trip, MAX(dropoff) AS latest_trip FROM raw",
)
def time_extent(spark, sf_dir):
    trips = raw_trips(spark, sf_dir, None, ["trip_pickup_datetime", "trip_dropoff_datetime"])
    return reports.time_extent(trips, "trip_pickup_datetime", "trip_dropoff_datetime")


@query(
    "rows_by_month",
    f"""WITH {RAW} SELECT CAST(year(pickup) AS BIGINT) AS year, CAST(month(pickup) AS BIGINT) AS month,
    COUNT(*) AS row_count FROM raw GROUP BY ALL""",
)
def rows_by_month(spark, sf_dir):
    trips = raw_trips(spark, sf_dir, None, ["trip_pickup_datetime"])
    return (
        trips.groupBy(F.year("trip_pickup_datetime").alias("year"), F.month("trip_pickup_datetime").alias("month"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("year", "month")
    )


@query(
    "months_loaded",
    f"""WITH {RAW} SELECT CASE line_status WHEN 'F' THEN 'Green 1998' ELSE 'Yellow 1998' END AS dataset,
    COUNT(DISTINCT month(pickup)) AS months_loaded, COUNT(*) AS total_rows
    FROM raw WHERE year(pickup) = 1998 GROUP BY ALL""",
)
def months_loaded(spark, sf_dir):
    def year_of(service, prefix):
        column = F.col(f"{prefix}_pickup_datetime")
        trips = raw_trips(spark, sf_dir, service, [f"{prefix}_pickup_datetime"])
        return trips.where(F.year(column) == 1998).select(F.month(column).alias("month"))

    return reports.months_loaded({"Green 1998": year_of("green", "lpep"), "Yellow 1998": year_of("yellow", "tpep")})


@query("total_tips", f"WITH {RAW} SELECT ROUND(CAST(SUM(CAST(tip_amount AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_tips FROM raw")
def total_tips(spark, sf_dir):
    trips = raw_trips(spark, sf_dir, None, ["tip_amount"])
    return trips.agg(F.round(F.sum(F.col("tip_amount").cast("decimal(18,2)")), 2).alias("total_tips"))


@query(
    "payment_type_pct",
    f"""WITH {RAW} SELECT payment_type, COUNT(*) AS trip_count,
    ROUND(CAST(COUNT(*) AS DOUBLE) * 100 / SUM(COUNT(*)) OVER (), 2) AS pct FROM raw GROUP BY payment_type""",
)
def payment_type_pct(spark, sf_dir):
    return reports.payment_type_pct(raw_trips(spark, sf_dir, None, ["payment_type"]))


@query(
    "payment_labels",
    f"""WITH {RAW} SELECT payment_type, CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash'
    WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 6 THEN 'Voided trip' ELSE 'Unknown' END AS payment_method,
    COUNT(*) AS trip_count FROM raw GROUP BY ALL""",
)
def payment_labels(spark, sf_dir):
    counts = raw_trips(spark, sf_dir, None, ["payment_type"]).groupBy("payment_type").agg(F.count(F.lit(1)).alias("trip_count"))
    return counts.select("payment_type", payment_label("payment_type").alias("payment_method"), "trip_count")


@query(
    "rate_labels",
    f"""WITH {RAW} SELECT RatecodeID, CASE RatecodeID WHEN 1 THEN 'Standard rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
    WHEN 4 THEN 'Nassau or Westchester' WHEN 5 THEN 'Negotiated fare' WHEN 6 THEN 'Group ride' ELSE 'Unknown' END AS rate_type,
    COUNT(*) AS trip_count FROM raw GROUP BY ALL""",
)
def rate_labels(spark, sf_dir):
    counts = raw_trips(spark, sf_dir, None, ["RatecodeID"]).groupBy("RatecodeID").agg(F.count(F.lit(1)).alias("trip_count"))
    return counts.select("RatecodeID", rate_label("RatecodeID").alias("rate_type"), "trip_count")


@query("head_n", "SELECT event_id, user_id, value FROM events ORDER BY event_id LIMIT 1000")
def first_events(spark, sf_dir):
    return head_n(table(spark, sf_dir, "events").select("event_id", "user_id", "value"), ["event_id"], 1000)


@query("project_columns", f"WITH {RAW} SELECT RatecodeID, payment_type FROM raw")
def project_columns(spark, sf_dir):
    return raw_trips(spark, sf_dir, None, ["RatecodeID", "payment_type"])


@query(
    "busiest_day",
    f"""WITH {RAW}, d AS (SELECT CAST(pickup AS DATE) AS pickup_day, COUNT(*) AS n FROM raw GROUP BY ALL)
    SELECT (SELECT pickup_day FROM d ORDER BY n DESC, pickup_day LIMIT 1) AS busiest_day, (SELECT MAX(n) FROM d) AS busiest_value,
           (SELECT pickup_day FROM d ORDER BY n, pickup_day LIMIT 1) AS quietest_day, (SELECT MIN(n) FROM d) AS quietest_value""",
)
def busiest_day(spark, sf_dir):
    trips = raw_trips(spark, sf_dir, None, ["trip_pickup_datetime"])
    per_day = trips.groupBy(F.to_date("trip_pickup_datetime").alias("pickup_day")).agg(F.count(F.lit(1)).alias("n"))
    return extreme_days(per_day, "pickup_day", "n")


@query(
    "anomaly_rate",
    """WITH s AS (SELECT AVG(l_extendedprice) + 1.5 * STDDEV(l_extendedprice) AS cut FROM lineitem)
    SELECT COUNT(*) FILTER (l_extendedprice > cut) AS anomalies, COUNT(*) AS total_rows,
    ROUND(CAST(COUNT(*) FILTER (l_extendedprice > cut) AS DOUBLE) / NULLIF(COUNT(*), 0), 6) AS anomaly_ratio FROM lineitem, s""",
)
def anomaly_rate(spark, sf_dir):
    # Prices are spread evenly, so none lies three deviations out; 1.5 leaves something to count.
    return reports.anomaly_rate(raw_trips(spark, sf_dir, None, ["fare_amount"]), "fare_amount", 1.5)


@query(
    "nan_to_null",
    """SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (event_type <> 'error') AS known_values,
    CAST(SUM(CAST(value AS DECIMAL(18,2))) FILTER (event_type <> 'error') AS DOUBLE) AS value_sum FROM events""",
)
def nan_values(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    spoiled = events.withColumn("value", F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")))
    return nan_to_null(spoiled.select("event_id", "value")).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("value").alias("known_values"),
        F.sum(F.col("value").cast("decimal(18,2)")).alias("value_sum"),
    )
