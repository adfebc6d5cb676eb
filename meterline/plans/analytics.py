"""Analytical models of the first project: percentiles, growth, payments, comparisons."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.labels import month_label, payment_label, rate_label
from meterline.functions.numbers import pct_change, rounded
from meterline.operators.percentiles import exact_percentiles
from meterline.operators.ranking import share_of_total, top_n
from meterline.plans.marts import valid_trips, zone_state


def fare_percentiles(fct: DataFrame) -> DataFrame:
    """P90, P95 and P97 fares per service and month with supporting figures, from one pass."""
    paid = valid_trips(fct).where((F.col("fare_amount") > 0) & (F.col("trip_distance") > 0)).select(
        "service_type", F.date_trunc("month", "pickup_datetime").alias("month"), "fare_amount", "trip_distance"
    )
    shares = {"p90_fare": 0.90, "p95_fare": 0.95, "p97_fare": 0.97}
    totals = {"_fares": F.col("fare_amount"), "_distances": F.col("trip_distance")}
    figures = exact_percentiles(paid, ["service_type", "month"], "fare_amount", shares, totals)
    return figures.select(
        "service_type",
        F.year("month").alias("year"),
        F.month("month").alias("month_number"),
        "month",
        *shares,
        F.col("value_count").alias("trip_count"),
        rounded(F.col("_fares") / F.col("value_count"), 2).alias("avg_fare"),
        rounded("value_min", 2).alias("min_fare"),
        rounded("value_max", 2).alias("max_fare"),
        rounded(F.col("_distances") / F.col("value_count"), 2).alias("avg_distance"),
    )


def revenue_growth(fct: DataFrame, zones: DataFrame) -> DataFrame:
    """Month-over-month revenue and trips per pickup zone name and service.

    LAG takes the previous row, so after a month without trips an older month is compared. The
    sums are taken per location id before the zone lookup and then per zone name; decimal sums
    make both steps exact.
    """
    return growth_of(zone_state(fct), zones)


def growth_of(state: DataFrame, zones: DataFrame) -> DataFrame:
    """Month-over-month revenue and trips from the sums per location and month."""
    month_keys = ["service_type", "pickup_year", "pickup_month"]
    named = zones.where(F.col("zone").isNotNull()).select(
        "location_id", F.col("zone").alias("pickup_zone"), F.col("borough").alias("pickup_borough")
    )
    monthly = (
        state.join(named, state.pickup_location_id == named.location_id)
        .groupBy(*month_keys, "pickup_zone", "pickup_borough")
        .agg(F.sum("revenue").alias("_revenue"), F.sum("trips").alias("trip_count"))
    )
    order = Window.partitionBy("service_type", "pickup_zone").orderBy("pickup_year", "pickup_month")
    lagged = monthly.withColumns(
        {"_before": F.lag("_revenue").over(order), "prev_month_trip_count": F.lag("trip_count").over(order)}
    )
    return lagged.select(
        "service_type",
        "pickup_zone",
        "pickup_borough",
        F.col("pickup_year").alias("year"),
        F.col("pickup_month").alias("month_number"),
        F.make_date("pickup_year", "pickup_month", F.lit(1)).cast("timestamp").alias("month"),
        F.round("_revenue", 2).alias("revenue"),
        "trip_count",
        F.round("_before", 2).alias("prev_month_revenue"),
        "prev_month_trip_count",
        pct_change(F.col("_revenue"), F.col("_before")).alias("mom_growth_pct"),
        pct_change(F.col("trip_count"), F.col("prev_month_trip_count")).alias("mom_trip_growth_pct"),
        rounded(F.col("_revenue").cast("double") / F.nullif(F.col("trip_count"), F.lit(0)), 2).alias(
            "revenue_per_trip"
        ),
    )


def days_back(given: int | None = None, default: int = 30) -> int:
    """Look-back in days: the argument, else the environment variable DAYS_BACK, else the default."""
    return int(given if given is not None else os.environ.get("DAYS_BACK", default))


def payment_analysis(fct: DataFrame, as_of: Column | str | None = None, days: int | None = None) -> DataFrame:
    """Trips and revenue by payment and rate code over the last days before ``as_of`` (today)."""
    today = F.current_date() if as_of is None else (F.lit(as_of) if isinstance(as_of, str) else as_of).cast("date")
    since = F.date_sub(today, days_back(days)).cast("timestamp")
    grouped = (
        fct.where(F.col("pickup_datetime") >= since)
        .groupBy("service_type", "payment_type", "rate_code_id")
        .agg(F.count(F.lit(1)).alias("trip_count"), F.sum("total_amount").alias("_sum"), F.count("total_amount").alias("_n"))
    )
    # Grouped by code, labelled afterwards: two codes may share a label and stay two rows.
    return grouped.select(
        "service_type",
        payment_label("payment_type").alias("payment_method"),
        rate_label("rate_code_id").alias("rate_type"),
        "trip_count",
        F.round("_sum", 2).alias("total_revenue"),
        rounded(F.col("_sum").cast("double") / F.nullif(F.col("_n"), F.lit(0)), 2).alias("avg_revenue"),
    )


def payment_share(payments: DataFrame) -> DataFrame:
    return share_of_total(payments, "trip_count", "pct_of_trips")


def percentiles_of_month(percentiles: DataFrame, year: int, month: int) -> DataFrame:
    chosen = percentiles.where((F.col("year") == year) & (F.col("month_number") == month))
    return chosen.select("service_type", "p90_fare", "p95_fare", "p97_fare", "trip_count")


def growth_extremes(growth: DataFrame, year: int, month: int, n: int = 5, declines: bool = False) -> DataFrame:
    """Zones with the largest growth of a month, or the largest decline."""
    known = growth.where(
        (F.col("year") == year) & (F.col("month_number") == month) & F.col("mom_growth_pct").isNotNull()
    )
    ranked = top_n(known, "mom_growth_pct", n, ["pickup_zone", "service_type"], ascending=declines)
    return ranked.select("pickup_zone", "service_type", "revenue", "prev_month_revenue", "mom_growth_pct")


def revenue_volatility(growth: DataFrame, months: int = 12, n: int = 10) -> DataFrame:
    """Zones with the widest swings of growth, given enough months of history."""
    per_zone = (
        growth.where(F.col("mom_growth_pct").isNotNull())
        .groupBy("pickup_zone", "service_type")
        .agg(
            F.stddev("mom_growth_pct").alias("_swing"),
            F.avg(F.col("revenue").cast("double")).alias("_mean"),
            F.count(F.lit(1)).alias("months_tracked"),
        )
        .where(F.col("months_tracked") >= months)
    )
    return top_n(per_zone, "_swing", n, ["pickup_zone", "service_type"]).select(
        "pickup_zone",
        "service_type",
        rounded("_swing", 2).alias("volatility_stddev"),
        rounded("_mean", 0).alias("avg_revenue"),
        "months_tracked",
    )


def declining_zones(growth: DataFrame, more_than: int = 2) -> DataFrame:
    negative = growth.where(F.col("mom_growth_pct") < 0)
    counted = negative.groupBy("service_type", "pickup_zone").agg(F.count(F.lit(1)).alias("negative_months"))
    return counted.where(F.col("negative_months") > more_than)


def annual_revenue(growth: DataFrame, before: int, after: int) -> DataFrame:
    """Revenue per zone, service and year, of two years."""
    chosen = growth.where(F.col("year").isin(before, after))
    return chosen.groupBy("pickup_zone", "service_type", "year").agg(F.sum("revenue").alias("_annual"))


def compare_years(annual: DataFrame, before: int, after: int, at_least: float = 10000, n: int = 10) -> DataFrame:
    """Two years of annual revenue side by side, zones of the earlier year above a floor."""
    keys = ["pickup_zone", "service_type"]
    old = annual.where((F.col("year") == before) & (F.col("_annual") > at_least)).select(
        *keys, F.col("_annual").alias("revenue_before")
    )
    new = annual.where(F.col("year") == after).select(*keys, F.col("_annual").alias("revenue_after"))
    compared = new.join(old, keys).withColumn("yoy_growth", pct_change(F.col("revenue_after"), F.col("revenue_before")))
    return top_n(compared, "yoy_growth", n, keys)


def yoy_growth(growth: DataFrame, before: int, after: int, at_least: float = 10000, n: int = 10) -> DataFrame:
    """Annual revenue of two years side by side, zones of the earlier year above a floor."""
    return compare_years(annual_revenue(growth, before, after), before, after, at_least, n)


def seasonality(growth: DataFrame) -> DataFrame:
    """Average zone revenue and active zones per calendar month and service."""
    return (
        growth.groupBy("month_number", "service_type")
        .agg(
            (F.sum("revenue").cast("double") / F.count("revenue")).alias("avg_monthly_revenue"),
            F.count_distinct("pickup_zone").alias("active_zones"),
        )
        .select(
            "month_number",
            month_label(F.col("month_number")).alias("month_name"),
            "service_type",
            "avg_monthly_revenue",
            "active_zones",
        )
    )


def best_zone(zone_revenue: DataFrame, service: str, year: int) -> DataFrame:
    """Zone with the highest revenue of one service in one year."""
    chosen = zone_revenue.where((F.col("service_type") == service) & (F.col("pickup_year") == year))
    total = chosen.groupBy("pickup_zone").agg(F.sum("revenue_monthly_total_amount").alias("total_revenue"))
    return top_n(total, "total_revenue", 1, ["pickup_zone"])


def month_trips(zone_revenue: DataFrame, service: str, year: int, month: int) -> DataFrame:
    chosen = zone_revenue.where(
        (F.col("service_type") == service) & (F.col("pickup_year") == year) & (F.col("pickup_month") == month)
    )
    return chosen.agg(F.sum("total_monthly_trips").alias("total_trips"))


def answers(zone_revenue: DataFrame, fhv: DataFrame, service: str, year: int, month_year: int, month: int) -> DataFrame:
    """Four unlike answers as text in one two-column frame."""
    def line(question: str, frame: DataFrame, column: str) -> DataFrame:
        return frame.select(F.lit(question).alias("question"), F.col(column).cast("string").alias("answer"))

    lines = [
        line("zone_rows", zone_revenue.agg(F.count(F.lit(1)).alias("n")), "n"),
        line("best_zone", best_zone(zone_revenue, service, year), "pickup_zone"),
        line("month_trips", month_trips(zone_revenue, service, month_year, month), "total_trips"),
        line("fhv_rows", fhv.agg(F.count(F.lit(1)).alias("n")), "n"),
    ]
    out = lines[0]
    for more in lines[1:]:
        out = out.unionByName(more)
    return out
