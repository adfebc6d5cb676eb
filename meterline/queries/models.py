"""Staging, marts and analytical models."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.functions.numbers import rounded
from meterline.functions.keys import surrogate_key
from meterline.functions.timeparts import boundary_minutes, elapsed_minutes, weekday_from_one
from meterline.plans import analytics, marts, platform, staging
from meterline.queries.base import (
    FACT2_SQL,
    FCT_SQL,
    GREEN,
    GROWTH_SQL,
    KEYED_SQL,
    RAW,
    STAGED_SQL,
    ZONE_REVENUE_SQL,
    ZONES,
    as_double,
    fct,
    query,
    replaced,
    staged,
    zones,
)
from meterline.sources.sample import raw_fhv, raw_trips, table

MONEY = ["trip_distance", *staging.MONEY_COLUMNS]
AS_OF = "2001-08-01"


@query("stg_green", f"WITH {STAGED_SQL} {replaced('staged', *MONEY)} WHERE service_type = 'Green'")
def stg_green(spark, sf_dir):
    return staging.stage_green(raw_trips(spark, sf_dir, "green", staging.raw_columns("lpep")))


@query("stg_yellow", f"WITH {STAGED_SQL} {replaced('staged', *MONEY)} WHERE service_type = 'Yellow'")
def stg_yellow(spark, sf_dir):
    return staging.stage_yellow(raw_trips(spark, sf_dir, "yellow", staging.raw_columns("tpep")))


FHV_SQL = RAW + """, fhv AS (
  SELECT CASE store_and_fwd_flag WHEN 'Y' THEN 'R' WHEN 'N' THEN 'A' END AS dispatching_base_num,
         pickup AS pickup_datetime, dropoff AS dropoff_datetime, PULocationID AS pickup_location_id,
         DOLocationID AS dropoff_location_id, CASE line_status WHEN 'O' THEN CAST(1 AS BIGINT) END AS shared_ride_flag,
         'FHV' AS service_type
  FROM raw WHERE payment_type < 7 AND pickup IS NOT NULL)"""


@query("stg_fhv", f"WITH {FHV_SQL} SELECT * FROM fhv")
def stg_fhv(spark, sf_dir):
    return staging.stage_fhv(raw_fhv(spark, sf_dir))


@query("stg_trips_keyed", f"WITH {GREEN}, {KEYED_SQL.format(source='green')} SELECT * FROM keyed")
def stg_trips_keyed(spark, sf_dir):
    return staging.stage_keyed_trips(raw_trips(spark, sf_dir, "green"))


@query(
    "surrogate_key",
    f"""WITH {RAW}, k AS (SELECT md5(concat_ws('-', CAST(VendorID AS VARCHAR), CAST(pickup AS VARCHAR),
    COALESCE(store_and_fwd_flag, '_dbt_utils_surrogate_key_null_'))) AS trip_id FROM raw)
    SELECT trip_id, COUNT(*) AS row_count FROM k GROUP BY trip_id""",
)
def keys(spark, sf_dir):
    raw = raw_trips(spark, sf_dir, None, ["VendorID", "trip_pickup_datetime", "store_and_fwd_flag"])
    keyed = raw.select(surrogate_key("VendorID", "trip_pickup_datetime", "store_and_fwd_flag").alias("trip_id"))
    return keyed.groupBy("trip_id").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "suspicious_split",
    f"""WITH {RAW}, {KEYED_SQL.format(source='raw')} SELECT is_suspicious, COUNT(*) AS trip_count,
    CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM keyed GROUP BY is_suspicious""",
)
def suspicious_split(spark, sf_dir):
    keyed = staging.stage_keyed_trips(raw_trips(spark, sf_dir), "trip")
    return keyed.groupBy("is_suspicious").agg(
        F.count(F.lit(1)).alias("trip_count"), F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("revenue")
    )


@query("trips_unioned", f"WITH {STAGED_SQL} {replaced('staged', *MONEY)}")
def trips_unioned(spark, sf_dir):
    return marts.union_trips(stg_green(spark, sf_dir), stg_yellow(spark, sf_dir))


@query("fct_trips", f"WITH {FCT_SQL} {replaced('fct', *MONEY, 'trip_duration_seconds')}")
def fct_trips(spark, sf_dir):
    return fct(spark, sf_dir)


@query("dim_zones", f"WITH {ZONES} SELECT * FROM zones")
def dim_zones(spark, sf_dir):
    return zones(spark, sf_dir)


@query(
    "date_parts",
    f"""WITH {RAW} SELECT DISTINCT CAST(pickup AS DATE) AS day_of, CAST(year(pickup) AS BIGINT) AS year_of, CAST(month(pickup) AS BIGINT) AS month_of,
    CAST(day(pickup) AS BIGINT) AS day_no, CAST(hour(pickup) AS BIGINT) AS hour_of, CAST(dayofweek(pickup) AS BIGINT) AS dow_zero,
    CAST(dayofweek(pickup) + 1 AS BIGINT) AS dow_one FROM raw""",
)
def date_parts(spark, sf_dir):
    t = "trip_pickup_datetime"
    return (
        raw_trips(spark, sf_dir, None, [t])
        .select(
            F.to_date(t).alias("day_of"),
            F.year(t).alias("year_of"),
            F.month(t).alias("month_of"),
            F.dayofmonth(t).alias("day_no"),
            F.hour(t).alias("hour_of"),
            (F.dayofweek(t) - 1).alias("dow_zero"),
            weekday_from_one(t).alias("dow_one"),
        )
        .distinct()
    )


@query(
    "duration_minutes",
    """WITH spans AS (SELECT event_type, ts AS start_ts, ts + to_microseconds(CAST(floor(value * 1000000) AS BIGINT)) AS end_ts FROM events)
    SELECT event_type, CAST(SUM(date_diff('minute', start_ts, end_ts)) AS BIGINT) AS boundary_minutes,
    CAST(SUM(floor((epoch_us(end_ts) - epoch_us(start_ts)) / 60000000)) AS BIGINT) AS elapsed_minutes
    FROM spans GROUP BY event_type""",
)
def duration_minutes(spark, sf_dir):
    """Events as spans of ``value`` seconds."""
    end = F.timestamp_micros(F.unix_micros("ts") + F.floor(F.col("value") * 1000000))
    spans = table(spark, sf_dir, "events").select("event_type", "ts", end.alias("end_ts"))
    return spans.groupBy("event_type").agg(
        F.sum(boundary_minutes("ts", "end_ts")).alias("boundary_minutes"),
        F.sum(elapsed_minutes("ts", "end_ts")).alias("elapsed_minutes"),
    )


@query(
    "monthly_zone_revenue",
    f"WITH {ZONE_REVENUE_SQL} {replaced('zone_revenue', 'revenue_monthly_fare', 'revenue_monthly_total_amount')}",
)
def monthly_zone_revenue(spark, sf_dir):
    return marts.monthly_zone_revenue(
        fct(spark, sf_dir, ["pickup_location_id", "total_amount"]), zones(spark, sf_dir)
    )


@query(
    "best_zone_of_year",
    f"""WITH {ZONE_REVENUE_SQL} SELECT pickup_zone, CAST(SUM(revenue_monthly_total_amount) AS DOUBLE) AS total_revenue FROM zone_revenue
    WHERE service_type = 'Green' AND pickup_year = 1999 GROUP BY pickup_zone ORDER BY total_revenue DESC, pickup_zone LIMIT 1""",
)
def best_zone_of_year(spark, sf_dir):
    return analytics.best_zone(monthly_zone_revenue(spark, sf_dir), "Green", 1999)


@query(
    "answers_union",
    f"""WITH {ZONE_REVENUE_SQL}, best AS (SELECT pickup_zone FROM zone_revenue WHERE service_type = 'Green' AND pickup_year = 1999
    GROUP BY pickup_zone ORDER BY SUM(revenue_monthly_total_amount) DESC, pickup_zone LIMIT 1)
    SELECT 'zone_rows' AS question, CAST(COUNT(*) AS VARCHAR) AS answer FROM zone_revenue
    UNION ALL SELECT 'best_zone', pickup_zone FROM best
    UNION ALL SELECT 'month_trips', CAST(SUM(total_monthly_trips) AS VARCHAR) FROM zone_revenue
      WHERE service_type = 'Green' AND pickup_year = 1998 AND pickup_month = 10
    UNION ALL SELECT 'fhv_rows', CAST(COUNT(*) AS VARCHAR) FROM raw WHERE payment_type < 7 AND pickup IS NOT NULL""",
)
def answers_union(spark, sf_dir):
    return analytics.answers(monthly_zone_revenue(spark, sf_dir), stg_fhv(spark, sf_dir), "Green", 1999, 1998, 10)


PERCENTILES_SQL = FCT_SQL + """, percentiles AS (
  SELECT service_type, pickup_year AS year, pickup_month AS month_number,
         CAST(date_trunc('month', pickup_datetime) AS TIMESTAMP) AS month,
         ROUND(quantile_cont(CAST(fare_amount AS DOUBLE), 0.90), 4) AS p90_fare,
         ROUND(quantile_cont(CAST(fare_amount AS DOUBLE), 0.95), 4) AS p95_fare,
         ROUND(quantile_cont(CAST(fare_amount AS DOUBLE), 0.97), 4) AS p97_fare,
         COUNT(*) AS trip_count, ROUND(CAST(SUM(fare_amount) AS DOUBLE) / COUNT(*), 2) AS avg_fare,
         CAST(ROUND(MIN(fare_amount), 2) AS DOUBLE) AS min_fare, CAST(ROUND(MAX(fare_amount), 2) AS DOUBLE) AS max_fare,
         ROUND(CAST(SUM(trip_distance) AS DOUBLE) / COUNT(*), 2) AS avg_distance
  FROM good WHERE fare_amount > 0 AND trip_distance > 0 GROUP BY ALL)"""


def _fare_percentiles(spark, sf_dir):
    table = analytics.fare_percentiles(fct(spark, sf_dir, []))
    return table.withColumns({c: rounded(c, 4) for c in ("p90_fare", "p95_fare", "p97_fare")})


@query("fare_percentiles", f"WITH {PERCENTILES_SQL} SELECT * FROM percentiles")
def fare_percentiles(spark, sf_dir):
    return _fare_percentiles(spark, sf_dir)


@query(
    "percentiles_of_month",
    f"""WITH {PERCENTILES_SQL} SELECT service_type, p90_fare, p95_fare, p97_fare, trip_count FROM percentiles
    WHERE year = 1999 AND month_number = 4""",
)
def percentiles_of_month(spark, sf_dir):
    return analytics.percentiles_of_month(_fare_percentiles(spark, sf_dir), 1999, 4)


def _growth(spark, sf_dir):
    return analytics.revenue_growth(fct(spark, sf_dir, ["pickup_location_id", "total_amount"]), zones(spark, sf_dir))


@query("revenue_growth", f"WITH {GROWTH_SQL} {replaced('growth', 'revenue', 'prev_month_revenue')}")
def revenue_growth(spark, sf_dir):
    return _growth(spark, sf_dir)


EXTREMES_SQL = f"""WITH {GROWTH_SQL} SELECT pickup_zone, service_type, {as_double('revenue', 'prev_month_revenue')}, mom_growth_pct
FROM growth WHERE year = 1999 AND month_number = 1 AND mom_growth_pct IS NOT NULL ORDER BY mom_growth_pct"""


@query("top_growth", f"{EXTREMES_SQL} DESC, pickup_zone, service_type LIMIT 5")
def top_growth(spark, sf_dir):
    return analytics.growth_extremes(_growth(spark, sf_dir), 1999, 1)


@query("top_declines", f"{EXTREMES_SQL}, pickup_zone, service_type LIMIT 5")
def top_declines(spark, sf_dir):
    return analytics.growth_extremes(_growth(spark, sf_dir), 1999, 1, declines=True)


@query(
    "revenue_volatility",
    f"""WITH {GROWTH_SQL}, v AS (SELECT pickup_zone, service_type, STDDEV(mom_growth_pct) AS swing, AVG(CAST(revenue AS DOUBLE)) AS mean_revenue,
    COUNT(*) AS months_tracked FROM growth WHERE mom_growth_pct IS NOT NULL GROUP BY ALL HAVING COUNT(*) >= 12)
    SELECT pickup_zone, service_type, ROUND(swing, 2) AS volatility_stddev, ROUND(mean_revenue, 0) AS avg_revenue, months_tracked
    FROM v ORDER BY swing DESC, pickup_zone, service_type LIMIT 10""",
)
def revenue_volatility(spark, sf_dir):
    return analytics.revenue_volatility(_growth(spark, sf_dir))


@query(
    "declining_zones",
    f"""WITH {GROWTH_SQL} SELECT service_type, pickup_zone, COUNT(*) AS negative_months FROM growth
    WHERE mom_growth_pct < 0 GROUP BY ALL HAVING COUNT(*) > 2""",
)
def declining_zones(spark, sf_dir):
    return analytics.declining_zones(_growth(spark, sf_dir))


@query(
    "yoy_growth",
    f"""WITH {GROWTH_SQL}, a AS (SELECT pickup_zone, service_type, year, SUM(revenue) AS annual FROM growth
    WHERE year IN (1998, 1999) GROUP BY ALL)
    SELECT n.pickup_zone, n.service_type, CAST(o.annual AS DOUBLE) AS revenue_before, CAST(n.annual AS DOUBLE) AS revenue_after,
    ROUND(100.0 * (CAST(n.annual AS DOUBLE) - CAST(o.annual AS DOUBLE)) / CAST(o.annual AS DOUBLE), 2) AS yoy_growth
    FROM a n LEFT JOIN a o ON n.pickup_zone = o.pickup_zone AND n.service_type = o.service_type AND o.year = 1998
    WHERE n.year = 1999 AND o.annual > 10000 ORDER BY yoy_growth DESC, n.pickup_zone, n.service_type LIMIT 10""",
)
def yoy_growth(spark, sf_dir):
    return analytics.yoy_growth(_growth(spark, sf_dir), 1998, 1999)


@query(
    "seasonality",
    f"""WITH {GROWTH_SQL} SELECT month_number, monthname(make_date(2000, CAST(month_number AS INT), 1)) AS month_name, service_type,
    CAST(SUM(revenue) AS DOUBLE) / COUNT(*) AS avg_monthly_revenue, COUNT(DISTINCT pickup_zone) AS active_zones
    FROM growth GROUP BY month_number, service_type""",
)
def seasonality(spark, sf_dir):
    return analytics.seasonality(_growth(spark, sf_dir))


PAYMENT_SQL = FCT_SQL + f""", payments AS (
  SELECT service_type, CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
           WHEN 4 THEN 'Dispute' WHEN 6 THEN 'Voided trip' ELSE 'Unknown' END AS payment_method,
         CASE rate_code_id WHEN 1 THEN 'Standard rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark' WHEN 4 THEN 'Nassau or Westchester'
           WHEN 5 THEN 'Negotiated fare' WHEN 6 THEN 'Group ride' ELSE 'Unknown' END AS rate_type,
         COUNT(*) AS trip_count, CAST(ROUND(SUM(total_amount), 2) AS DOUBLE) AS total_revenue,
         ROUND(CAST(SUM(total_amount) AS DOUBLE) / COUNT(total_amount), 2) AS avg_revenue
  FROM fct WHERE pickup_datetime >= DATE '{AS_OF}' - INTERVAL 30 DAY
  GROUP BY service_type, payment_type, rate_code_id)"""


def _payments(spark, sf_dir):
    facts = fct(spark, sf_dir, ["payment_type", "rate_code_id", "total_amount"])
    return analytics.payment_analysis(facts, AS_OF, 30)


@query("payment_analysis", f"WITH {PAYMENT_SQL} SELECT * FROM payments")
def payment_analysis(spark, sf_dir):
    return _payments(spark, sf_dir)


@query(
    "payment_share",
    f"""WITH {PAYMENT_SQL} SELECT *, ROUND(CAST(trip_count AS DOUBLE) * 100 / SUM(trip_count) OVER (), 2) AS pct_of_trips FROM payments""",
)
def payment_share(spark, sf_dir):
    return analytics.payment_share(_payments(spark, sf_dir))


def _fact2(spark, sf_dir):
    return platform.fact_trips(staging.stage_keyed_trips(raw_trips(spark, sf_dir, "green")))


@query("fact_trips_enriched", f"WITH {FACT2_SQL} SELECT * FROM fact2")
def fact_trips_enriched(spark, sf_dir):
    return _fact2(spark, sf_dir)


KPI_MEANS = {
    "avg_passengers_per_trip": "passenger_count",
    "avg_trip_distance": "trip_distance",
    "avg_trip_duration_minutes": "trip_duration_minutes",
    "avg_revenue_per_trip": "total_amount",
    "avg_tip_per_trip": "tip_amount",
    "avg_speed_mph": "avg_speed_mph",
    "avg_revenue_per_mile": "revenue_per_mile",
}
KPI_SQL = FACT2_SQL + """, kpis AS (
  SELECT pickup_year, pickup_month, COUNT(*) AS total_trips,
         COUNT(DISTINCT pickup_location_id) AS unique_pickup_locations,
         COUNT(DISTINCT dropoff_location_id) AS unique_dropoff_locations,
         CAST(SUM(passenger_count) AS BIGINT) AS total_passengers,
         CAST(ROUND(SUM(CAST(trip_distance AS DECIMAL(24,6))), 2) AS DOUBLE) AS total_distance_miles,
         CAST(ROUND(SUM(CAST(total_amount AS DECIMAL(24,6))), 2) AS DOUBLE) AS total_revenue,
         CAST(ROUND(SUM(CAST(tip_amount AS DECIMAL(24,6))), 2) AS DOUBLE) AS total_tips,
""" + ",\n".join(
    f"ROUND(CAST(SUM(CAST({c} AS DECIMAL(24,6))) AS DOUBLE) / COUNT({c}), 2) AS {n}" for n, c in KPI_MEANS.items()
) + """
  FROM fact2 GROUP BY pickup_year, pickup_month)
SELECT *, LAG(total_revenue) OVER w AS prev_month_revenue,
       ROUND((total_revenue - LAG(total_revenue) OVER w) / NULLIF(LAG(total_revenue) OVER w, 0) * 100, 2) AS revenue_growth_pct
FROM kpis WINDOW w AS (ORDER BY pickup_year, pickup_month)"""


@query("monthly_kpis", f"WITH {KPI_SQL}")
def monthly_kpis(spark, sf_dir):
    return platform.monthly_kpis(_fact2(spark, sf_dir))
