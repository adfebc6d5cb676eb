"""Core models of the second project: enriched facts and monthly key figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.numbers import rounded, safe_ratio
from meterline.functions.timeparts import month_start, weekday_from_one
from meterline.operators.bitmaps import bitmap_distinct

AMOUNTS = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount"]


def fact_trips(staged: DataFrame, stamped: bool = False) -> DataFrame:
    """Trustworthy trips with date parts and ratios. ``stamped`` adds the load time."""
    out = staged.where(~F.col("is_suspicious")).select(
        "trip_id",
        "vendor_id",
        "pickup_location_id",
        "dropoff_location_id",
        "pickup_datetime",
        "dropoff_datetime",
        F.to_date("pickup_datetime").alias("pickup_date"),
        F.year("pickup_datetime").alias("pickup_year"),
        F.month("pickup_datetime").alias("pickup_month"),
        F.dayofmonth("pickup_datetime").alias("pickup_day"),
        weekday_from_one("pickup_datetime").alias("pickup_dayofweek"),
        F.hour("pickup_datetime").alias("pickup_hour"),
        "passenger_count",
        "trip_distance",
        "trip_duration_minutes",
        *AMOUNTS,
        rounded(F.col("trip_distance") / F.nullif("trip_duration_minutes", F.lit(0)) * 60, 2).alias("avg_speed_mph"),
        safe_ratio(F.col("total_amount"), F.col("trip_distance"), 2).alias("revenue_per_mile"),
    )
    return out.withColumn("created_at", F.current_timestamp()) if stamped else out


def with_month_partition(fact: DataFrame) -> DataFrame:
    return fact.withColumn("pickup_month_start", month_start("pickup_datetime").cast("date"))


def _exact(c: Column | str) -> Column:
    """Decimal form of an amount, so that sums do not depend on the order of rows."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(24,6)")


MONTH = ["pickup_year", "pickup_month"]
UNIQUE = {"pickup_location_id": "unique_pickup_locations", "dropoff_location_id": "unique_dropoff_locations"}


def _measured() -> dict[str, Column]:
    return {
        "passenger_count": F.col("passenger_count"),
        "trip_distance": _exact("trip_distance"),
        "trip_duration_minutes": F.col("trip_duration_minutes"),
        "total_amount": _exact("total_amount"),
        "tip_amount": _exact("tip_amount"),
        "avg_speed_mph": _exact("avg_speed_mph"),
        "revenue_per_mile": _exact("revenue_per_mile"),
    }


def kpi_pairs(fact: DataFrame) -> DataFrame:
    """Counts and sums per month and location pair, from one pass over the trips. They add up to those of any coarser group."""
    return fact.groupBy(*MONTH, *UNIQUE).agg(
        F.count(F.lit(1)).alias("trips"),
        *[F.sum(c).alias(f"sum_{n}") for n, c in _measured().items()],
        *[F.count(c).alias(f"cnt_{n}") for n, c in _measured().items()],
    )


def _kpis(pairs: DataFrame, keys: list[str], *distinct: Column) -> DataFrame:
    """The measures per group of ``keys``; ``distinct`` are the two counts of locations where the pairs give them."""

    def total(name: str) -> Column:
        return F.sum(f"sum_{name}")

    def mean(name: str) -> Column:
        return rounded(total(name).cast("double") / F.nullif(F.sum(f"cnt_{name}"), F.lit(0)), 2)

    return pairs.groupBy(*keys).agg(
        F.sum("trips").alias("total_trips"),
        *distinct,
        total("passenger_count").alias("total_passengers"),
        mean("passenger_count").alias("avg_passengers_per_trip"),
        F.round(total("trip_distance"), 2).alias("total_distance_miles"),
        mean("trip_distance").alias("avg_trip_distance"),
        mean("trip_duration_minutes").alias("avg_trip_duration_minutes"),
        F.round(total("total_amount"), 2).alias("total_revenue"),
        mean("total_amount").alias("avg_revenue_per_trip"),
        F.round(total("tip_amount"), 2).alias("total_tips"),
        mean("tip_amount").alias("avg_tip_per_trip"),
        mean("avg_speed_mph").alias("avg_speed_mph"),
        mean("revenue_per_mile").alias("avg_revenue_per_mile"),
    )


def _with_growth(metrics: DataFrame) -> DataFrame:
    # One row per month: an unpartitioned window is fine here. It works on the rounded total.
    before = F.lag("total_revenue").over(Window.orderBy(*MONTH))
    now, prev = F.col("total_revenue").cast("double"), F.col("prev_month_revenue").cast("double")
    return metrics.withColumn("prev_month_revenue", before).withColumn(
        "revenue_growth_pct", rounded((now - prev) / F.nullif(prev, F.lit(0.0)) * 100, 2)
    )


def monthly_kpis(fact: DataFrame) -> DataFrame:
    """Fourteen measures per month with growth against the previous month of the table.

    Grouped by month and location pair first. The two distinct counts then run over those groups
    instead of multiplying every trip, and the large table is shuffled once, already summed.
    """
    return _with_growth(_kpis(kpi_pairs(fact), MONTH, *[F.count_distinct(c).alias(n) for c, n in UNIQUE.items()]))


def kpis_of(pairs: DataFrame, ids: DataFrame, keys: list[str]) -> DataFrame:
    """The fourteen measures from their states: sums per location pair and bitmaps of the location ids."""
    metrics, unique = _kpis(pairs, keys), bitmap_distinct(ids, keys, UNIQUE)
    counted = metrics.join(unique, keys, "left").withColumns({n: F.coalesce(n, F.lit(0)) for n in UNIQUE.values()})
    rest = [c for c in metrics.columns if c not in (*keys, "total_trips")]
    return counted.select(*keys, "total_trips", *UNIQUE.values(), *rest)


def monthly_kpis_of(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    return _with_growth(kpis_of(pairs, ids, MONTH))


def yearly_kpis_of(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """The measures per year. Locations seen in several months count once, which sums of monthly counts could not tell."""
    return kpis_of(pairs, ids, ["pickup_year"])
