"""Stand-alone reports over raw or loaded trip tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.numbers import rounded
from meterline.functions.timeparts import elapsed_hours, on_day, within
from meterline.operators.ranking import top_n


def count_where(df: DataFrame, condition, name: str) -> DataFrame:
    return df.where(condition).agg(F.count(F.lit(1)).alias(name))


def short_trips(trips: DataFrame, pickup: str, first: str, after: str, distance: float = 1.0) -> DataFrame:
    return count_where(trips, within(F.col(pickup), first, after) & (F.col("trip_distance") <= distance), "short_trips")


def longest_per_day(trips: DataFrame, pickup: str, first: str, after: str, below: float = 100.0) -> DataFrame:
    """Longest credible distance per pickup day of a period."""
    kept = trips.where(within(F.col(pickup), first, after) & (F.col("trip_distance") < below))
    return kept.groupBy(F.to_date(pickup).alias("pickup_day")).agg(F.max("trip_distance").alias("max_distance"))


def zone_revenue_of_day(trips: DataFrame, zones: DataFrame, pickup: str, day: str, n: int = 1) -> DataFrame:
    """Pickup zones with the highest revenue of one day. Summed per location before the lookup."""
    per_location = (
        trips.where(on_day(F.col(pickup), day))
        .groupBy("PULocationID")
        .agg(F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("_sum"))
    )
    named = per_location.join(zones, per_location.PULocationID == zones.location_id)
    total = named.groupBy("zone").agg(F.sum("_sum").alias("total_revenue"))
    return top_n(total, "total_revenue", n, ["zone"])


def best_tip_by_dropoff(
    trips: DataFrame, zones: DataFrame, pickup: str, pickup_zone: str, first: str, after: str, n: int = 1
) -> DataFrame:
    """Dropoff zones with the largest tip for pickups in one zone."""
    best = (
        trips.where(within(F.col(pickup), first, after))
        .groupBy("PULocationID", "DOLocationID")
        .agg(F.max("tip_amount").alias("_tip"))
    )
    start, end = zones.alias("start"), zones.alias("end")
    named = (
        best.join(start, F.col("PULocationID") == F.col("start.location_id"))
        .where(F.col("start.zone") == pickup_zone)
        .join(end, F.col("DOLocationID") == F.col("end.location_id"))
    )
    by_zone = named.groupBy(F.col("end.zone").alias("dropoff_zone")).agg(F.max("_tip").alias("max_tip"))
    return top_n(by_zone, "max_tip", n, ["dropoff_zone"])


def trips_on_day(trips: DataFrame, pickup: str, day: str) -> DataFrame:
    return count_where(trips, on_day(F.col(pickup), day), "trip_count")


def longest_duration(trips: DataFrame, pickup: str, dropoff: str) -> DataFrame:
    return trips.agg(F.max(elapsed_hours(pickup, dropoff)).alias("max_hours"))


def rare_pickup_zones(trips: DataFrame, zones: DataFrame, n: int = 10) -> DataFrame:
    """Least frequent pickup zones; a location without a zone row keeps a NULL name."""
    counts = trips.groupBy("PULocationID").agg(F.count(F.lit(1)).alias("trip_count"))
    named = counts.join(zones, counts.PULocationID == zones.location_id, "left")
    return top_n(named, "trip_count", n, ["PULocationID"], ascending=True).select("PULocationID", "zone", "trip_count")


def top_pickup_zones(trips: DataFrame, zones: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent pickup locations with their zone names."""
    counts = trips.groupBy("PULocationID").agg(F.count(F.lit(1)).alias("trip_count"))
    best = top_n(counts, "trip_count", n, ["PULocationID"])
    return best.join(zones, best.PULocationID == zones.location_id).select("PULocationID", "zone", "trip_count")


def time_extent(trips: DataFrame, pickup: str, dropoff: str) -> DataFrame:
    return trips.agg(
        F.count(F.lit(1)).alias("total_rows"), F.min(pickup).alias("earliest_trip"), F.max(dropoff).alias("latest_trip")
    )


def distinct_counts(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("VendorID").alias("unique_vendors"),
        F.count_distinct("PULocationID").alias("unique_pickup_locations"),
    )


def months_loaded(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct months and rows per named table."""
    rows = None
    for name, df in tables.items():
        row = df.agg(F.count_distinct("month").alias("months_loaded"), F.count(F.lit(1)).alias("total_rows"))
        row = row.select(F.lit(name).alias("dataset"), "months_loaded", "total_rows")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def payment_type_pct(trips: DataFrame) -> DataFrame:
    """Share of rows per payment type: a window over the grouped counts."""
    trips.createOrReplaceTempView("_payment_rows")
    return trips.sparkSession.sql(
        """SELECT payment_type, count(*) AS trip_count,
                  round(count(*) * 100.0D / sum(count(*)) OVER (), 2) AS pct
           FROM _payment_rows GROUP BY payment_type"""
    )


def anomaly_rate(trips: DataFrame, value: str, deviations: float = 3.0) -> DataFrame:
    """Share of rows above the mean by a number of standard deviations."""
    v = F.col(value).cast("double")
    limit = trips.agg(F.avg(v) + F.lit(deviations) * F.stddev(v)).scalar()
    marked = trips.select((v > limit).alias("_high"))
    return marked.agg(
        F.count_if("_high").alias("anomalies"),
        F.count(F.lit(1)).alias("total_rows"),
        rounded(F.count_if("_high") * 1.0 / F.nullif(F.count(F.lit(1)), F.lit(0)), 6).alias("anomaly_ratio"),
    )
