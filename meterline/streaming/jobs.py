"""The stream transformations. Each takes decoded events, batch or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.operators.windows import hop, sessions, tumble
from meterline.sources.messages import to_message

LOCATION = ["PULocationID"]


def trips_and_revenue() -> dict:
    # Amounts carry two decimals; as decimals their sum does not depend on arrival order.
    revenue = F.sum(F.col("total_amount").cast("decimal(18,2)")).cast("double")
    return {"num_trips": F.count(F.lit(1)), "total_revenue": revenue}


def pass_through(rides: DataFrame) -> DataFrame:
    """Ride messages as rows, epoch milliseconds turned into a timestamp."""
    return rides.select(
        "PULocationID",
        "DOLocationID",
        "trip_distance",
        "total_amount",
        F.timestamp_millis("tpep_pickup_datetime").alias("pickup_datetime"),
    )


def location_revenue(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """Trips and revenue per location in tumbling windows."""
    return tumble(events, width, LOCATION, trips_and_revenue()).drop("window_end")


def location_trips(events: DataFrame, width: str = "5 minutes") -> DataFrame:
    return tumble(events, width, LOCATION, {"num_trips": F.count(F.lit(1))}).drop("window_end")


def tips(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """Tips of all locations in tumbling windows."""
    total = F.sum(F.col("tip_amount").cast("decimal(18,2)")).cast("double")
    return tumble(events, width, [], {"total_tip": total}).drop("window_end")


def location_sessions(events: DataFrame, gap: str = "5 minutes", keys: list[str] | None = None) -> DataFrame:
    return sessions(events, gap, keys or LOCATION, {"num_trips": F.count(F.lit(1))})


def sliding_revenue(events: DataFrame, width: str = "1 hour", step: str = "15 minutes") -> DataFrame:
    return hop(events, width, step, LOCATION, trips_and_revenue())


def count_longer(events: DataFrame, distance: float = 5.0) -> DataFrame:
    """Running count of trips above a distance."""
    return events.where(F.col("trip_distance") > distance).agg(F.count(F.lit(1)).alias("trip_count"))


def rollup(windows: DataFrame) -> DataFrame:
    """Totals per window over all locations of a window table."""
    return windows.groupBy("window_start").agg(
        F.count(F.lit(1)).alias("locations"),
        F.sum("num_trips").alias("num_trips"),
        F.sum(F.col("total_revenue").cast("decimal(18,2)")).cast("double").alias("total_revenue"),
    )


def replay_messages(df: DataFrame) -> DataFrame:
    """Rows as JSON messages: NaN as null, timestamps as text."""
    columns = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        elif kind.startswith("timestamp"):
            c = c.cast("string")
        columns.append(c.alias(name))
    return df.select(to_message(columns).alias("value"))


def replay_to_text(df: DataFrame, path: str) -> None:
    replay_messages(df).write.text(path)


def replay_to_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Needs the Kafka connector on the class path."""
    replay_messages(df).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
