"""Intermediate and mart models of the first project."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.timeparts import boundary_minutes, seconds_between, weekday_from_zero


def union_trips(*staged: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, staged)


def dim_zones(zones: DataFrame) -> DataFrame:
    return zones.select(
        F.col("LocationID").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        F.col("service_zone").alias("service_zone"),
    )


def fct_trips(trips: DataFrame) -> DataFrame:
    """Trips with duration, validity flag and pickup date parts."""
    seconds = seconds_between("pickup_datetime", "dropoff_datetime")
    invalid = (seconds <= 0) | (F.col("trip_distance") <= 0) | (F.col("fare_amount") <= 0)
    return trips.withColumns(
        {
            "trip_duration_seconds": seconds,
            "trip_duration_minutes": boundary_minutes("pickup_datetime", "dropoff_datetime"),
            "is_invalid_trip": F.coalesce(invalid, F.lit(False)),
            "pickup_date": F.to_date("pickup_datetime"),
            "pickup_year": F.year("pickup_datetime"),
            "pickup_month": F.month("pickup_datetime"),
            "pickup_dayofweek": weekday_from_zero("pickup_datetime"),
            "pickup_hour": F.hour("pickup_datetime"),
        }
    )


def valid_trips(fct: DataFrame) -> DataFrame:
    return fct.where(~F.col("is_invalid_trip"))


def zone_state(fct: DataFrame) -> DataFrame:
    """Counts and sums of valid trips per service, month and pickup location. States of parts add up to that of the whole."""
    return (
        valid_trips(fct)
        .groupBy("service_type", "pickup_year", "pickup_month", "pickup_location_id")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.sum("fare_amount").alias("fares"),
            F.sum("total_amount").alias("revenue"),
            F.sum("trip_distance").alias("distance"),
            F.count("trip_distance").alias("distances"),
            F.sum("trip_duration_minutes").alias("minutes"),
            F.count("trip_duration_minutes").alias("durations"),
        )
    )


def zone_revenue_of(state: DataFrame, zones: DataFrame) -> DataFrame:
    """Monthly trips and revenue per pickup zone, from their state."""
    names = zones.select("location_id", F.col("zone").alias("pickup_zone"), F.col("borough").alias("pickup_borough"))
    joined = state.join(names, state.pickup_location_id == names.location_id, "left")
    return joined.select(
        "service_type",
        "pickup_year",
        "pickup_month",
        "pickup_location_id",
        "pickup_zone",
        "pickup_borough",
        F.col("trips").alias("total_monthly_trips"),
        F.col("fares").alias("revenue_monthly_fare"),
        F.col("revenue").alias("revenue_monthly_total_amount"),
        # The inputs are exact, so sum over count is the mean; NULLs stay out of both.
        (F.col("distance").cast("double") / F.col("distances")).alias("avg_trip_distance"),
        (F.col("minutes").cast("double") / F.col("durations")).alias("avg_trip_duration_minutes"),
    )


def monthly_zone_revenue(fct: DataFrame, zones: DataFrame) -> DataFrame:
    """Monthly trips and revenue per pickup zone; trips of an unknown zone keep a NULL zone.

    Aggregated by location id first: the zone lookup then meets one row per group, not every trip.
    """
    return zone_revenue_of(zone_state(fct), zones)
