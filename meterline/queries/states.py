"""Models kept as states: months replaced alone, distinct counts from bitmaps, joins of tables stored for them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from meterline.functions.numbers import rounded
from meterline.jobs.refresh_models import Store, refresh
from meterline.operators.bitmaps import bitmap_distinct, id_bitmaps
from meterline.plans import analytics, platform
from meterline.queries.base import FACT2_SQL, FCT_SQL, GROWTH_SQL, REGISTRY, ZONE_REVENUE_SQL, fct, query, replaced
from meterline.queries.models import KPI_MEANS, KPI_SQL, PERCENTILES_SQL, _growth
from meterline.session import run_dir
from meterline.sinks.tables import drop_table, write_bucketed
from meterline.sources.sample import raw_trips, raw_zones, table

# The month that is loaded anew: in the first build its trips have other amounts, and some are missing.
RELOADED = (1998, 3)


def _refreshed(spark, sf_dir, name: str):
    """A model built from a wrong month, after that month has been loaded anew."""
    target = run_dir(spark, "refreshed")

    def raw(wrong: bool):
        def read(what: str):
            if what == "zones":
                return raw_zones(spark, sf_dir)
            trips = raw_trips(spark, sf_dir, what)
            if not wrong:
                return trips
            t = F.col("lpep_pickup_datetime" if what == "green" else "tpep_pickup_datetime")
            spoiled = (F.year(t) == RELOADED[0]) & (F.month(t) == RELOADED[1])
            amounts = {c: F.when(spoiled, F.col(c) * 2).otherwise(F.col(c)) for c in ("fare_amount", "total_amount", "tip_amount")}
            return trips.withColumns(amounts).where(~(spoiled & (F.col("PULocationID") % 3 == 0)))

        return read

    refresh(Store(spark, raw(True), target), names=[name])
    refresh(Store(spark, raw(False), target), [RELOADED], [name])
    return spark.read.parquet(f"{target}/{name}")


@query(
    "refreshed_zone_revenue",
    f"WITH {ZONE_REVENUE_SQL} {replaced('zone_revenue', 'revenue_monthly_fare', 'revenue_monthly_total_amount')}",
)
def refreshed_zone_revenue(spark, sf_dir):
    return _refreshed(spark, sf_dir, "monthly_zone_revenue")


@query("refreshed_growth", f"WITH {GROWTH_SQL} {replaced('growth', 'revenue', 'prev_month_revenue')}")
def refreshed_growth(spark, sf_dir):
    """The growth of the months behind the reloaded one changes, too."""
    return _refreshed(spark, sf_dir, "revenue_growth")


@query("refreshed_percentiles", f"WITH {PERCENTILES_SQL} SELECT * FROM percentiles")
def refreshed_percentiles(spark, sf_dir):
    stored = _refreshed(spark, sf_dir, "fare_percentiles")
    return stored.withColumns({c: rounded(c, 4) for c in ("p90_fare", "p95_fare", "p97_fare")})


@query("refreshed_kpis", f"WITH {KPI_SQL}")
def refreshed_kpis(spark, sf_dir):
    return _refreshed(spark, sf_dir, "monthly_kpis")


YEARLY_SQL = FACT2_SQL + """ SELECT pickup_year, COUNT(*) AS total_trips,
         COUNT(DISTINCT pickup_location_id) AS unique_pickup_locations,
         COUNT(DISTINCT dropoff_location_id) AS unique_dropoff_locations,
         CAST(SUM(passenger_count) AS BIGINT) AS total_passengers,
         CAST(ROUND(SUM(CAST(trip_distance AS DECIMAL(24,6))), 2) AS DOUBLE) AS total_distance_miles,
         CAST(ROUND(SUM(CAST(total_amount AS DECIMAL(24,6))), 2) AS DOUBLE) AS total_revenue,
         CAST(ROUND(SUM(CAST(tip_amount AS DECIMAL(24,6))), 2) AS DOUBLE) AS total_tips,
""" + ",\n".join(
    f"ROUND(CAST(SUM(CAST({c} AS DECIMAL(24,6))) AS DOUBLE) / COUNT({c}), 2) AS {n}" for n, c in KPI_MEANS.items()
) + " FROM fact2 GROUP BY pickup_year"


@query("yearly_kpis", f"WITH {YEARLY_SQL}")
def yearly_kpis(spark, sf_dir):
    """From the monthly states, bitmaps of the location ids included."""
    return _refreshed(spark, sf_dir, "yearly_kpis")


@query(
    "distinct_rollup",
    f"""WITH {FCT_SQL} SELECT pickup_year, COUNT(DISTINCT vendor_id) AS unique_vendors,
    COUNT(DISTINCT pickup_location_id) AS unique_pickup_locations, COUNT(DISTINCT dropoff_location_id) AS unique_dropoff_locations
    FROM fct GROUP BY pickup_year""",
)
def distinct_rollup(spark, sf_dir):
    """Bitmaps stored by month, counted by year."""
    path, counts = run_dir(spark, "bitmaps"), {"vendor_id": "unique_vendors", **platform.UNIQUE}
    monthly = id_bitmaps(fct(spark, sf_dir, list(counts)), platform.MONTH, list(counts))
    monthly.write.partitionBy(*platform.MONTH).parquet(path)
    return bitmap_distinct(spark.read.parquet(path), ["pickup_year"], counts)


@query(
    "active_users",
    """SELECT date_trunc('week', ts)::TIMESTAMP AS week_start, COUNT(DISTINCT user_id) AS active_users, COUNT(DISTINCT event_id) AS events
    FROM events GROUP BY ALL""",
)
def active_users(spark, sf_dir):
    """Daily bitmaps of users and events rolled up to weeks; the event ids take several blocks of a bitmap each."""
    path, day = run_dir(spark, "active"), F.to_date("ts").alias("day")
    daily = id_bitmaps(table(spark, sf_dir, "events").select(day, "user_id", "event_id"), ["day"], ["user_id", "event_id"])
    daily.write.parquet(path)
    weekly = spark.read.parquet(path).withColumn("week_start", F.date_trunc("week", "day"))
    return bitmap_distinct(weekly, ["week_start"], {"user_id": "active_users", "event_id": "events"})


@query("yoy_stored", REGISTRY["yoy_growth"].sql)
def yoy_stored(spark, sf_dir):
    """Annual revenue stored in buckets of its join key: its two years meet without a shuffle."""
    name, root = f"annual_{uuid.uuid4().hex}", run_dir(spark, "annual")
    annual = analytics.annual_revenue(_growth(spark, sf_dir), 1998, 1999)
    write_bucketed(annual, name, f"{root}/{name}", ["pickup_zone", "service_type"], 8)
    stored = spark.table(name)
    compared = analytics.compare_years(stored, 1998, 1999)
    compared.schema  # noqa: B018  resolved while the table is there; the files of an external table stay
    drop_table(spark, name)
    return compared
