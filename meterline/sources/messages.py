"""Message sources and decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.timeparts import parse_stamp
from meterline.schemas import GREEN_EVENT, RIDE


def kafka_options(servers: str, topic: str, start: str | int = "earliest") -> dict[str, str]:
    """Reader options. ``start`` is earliest, latest or epoch milliseconds."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if isinstance(start, int):
        options["startingTimestamp"] = str(start)
    elif start in ("earliest", "latest"):
        options["startingOffsets"] = start
    else:
        raise ValueError("start must be 'earliest', 'latest' or epoch milliseconds")
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, start: str | int = "earliest") -> DataFrame:
    """Message stream with a binary ``value``. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, start)).load()


def kafka_sample(spark: SparkSession, servers: str, topic: str, n: int = 10) -> DataFrame:
    """Bounded read of a few messages."""
    return spark.read.format("kafka").options(**kafka_options(servers, topic)).load().limit(n)


def text_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Message stream from landed text files, one JSON message per line. Without a limit a batch takes all new files."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def decode(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON messages to columns. A field that does not fit its type is NULL, the rest of its record stays.

    Records that do not parse as an object, those with NaN included, are skipped.
    """
    text = F.col(value).cast("string")
    options = {"mode": "PERMISSIVE", "allowNonNumericNumbers": "false"}
    parsed = messages.where(F.ltrim(text).startswith("{") & F.try_parse_json(text).isNotNull()).select(
        F.from_json(text, schema, options).alias("r")
    )
    return parsed.select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])


def decode_rides(messages: DataFrame, value: str = "value") -> DataFrame:
    """Ride messages with event time from epoch milliseconds."""
    return decode(messages, RIDE, value).withColumn("event_timestamp", F.timestamp_millis("tpep_pickup_datetime"))


def decode_green_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Green trip messages with event time from text; records without a readable time are dropped."""
    decoded = decode(messages, GREEN_EVENT, value)
    return decoded.withColumn("event_timestamp", parse_stamp("lpep_pickup_datetime")).where(
        F.col("event_timestamp").isNotNull()
    )


def to_message(columns: list[Column]) -> Column:
    """JSON text of the columns; NULL fields are kept as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
