"""Revenue between zones, from the stored source tables: a join whose order is worth planning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lane_revenue(trips: DataFrame, bookings: DataFrame, riders: DataFrame, drivers: DataFrame, segment: str, first: str, last: str) -> DataFrame:
    """Trips and fares per pickup and dropoff zone, of one rider segment and the bookings of ``first`` <= day < ``last``.

    Written from the trips outwards. With statistics the filtered riders and bookings meet first, so the trips are joined to few
    rows; without them the trips go through every join.
    """
    day = F.col("o_orderdate").cast("timestamp")
    wanted = bookings.where((day >= F.lit(first).cast("timestamp")) & (day < F.lit(last).cast("timestamp")))
    joined = (
        trips.join(drivers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(wanted, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(riders.where(F.col("c_mktsegment") == segment), F.col("o_custkey") == F.col("c_custkey"))
    )
    fare = F.sum(F.col("l_extendedprice").cast("decimal(12,2)"))
    return joined.groupBy(F.col("c_nationkey").alias("pickup_zone"), F.col("s_nationkey").alias("dropoff_zone")).agg(
        F.count(F.lit(1)).alias("trip_count"), fare.alias("fare_amount")
    )
