"""Starting stream jobs and storing their results."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.sinks.tables import write_jdbc

WATERMARK = "5 seconds"


def with_event_time(df: DataFrame, time: str = "event_timestamp", delay: str = WATERMARK) -> DataFrame:
    """Accept rows up to ``delay`` out of order. A longer delay is the allowance for late rows."""
    return df.withWatermark(time, delay)


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything available into Parquet, then stop. The same checkpoint resumes the job."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def start(stream: DataFrame, path: str, checkpoint: str, every: str = "10 seconds", mode: str = "append"):
    """Run continuously with a micro-batch and checkpoint per interval."""
    return (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )


def start_jdbc(stream: DataFrame, url: str, name: str, checkpoint: str, every: str = "10 seconds"):
    """Append micro-batches to a database table. A batch retried after a failure is inserted again."""
    return (
        stream.writeStream.outputMode("append")
        .foreachBatch(lambda batch, _: write_jdbc(batch, url, name))
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )


@dataclass(frozen=True)
class UpsertTable:
    """Keyed table fed by micro-batches.

    Each micro-batch is a folder named after its id, and writing a batch again replaces its folder,
    so a retried batch changes nothing. The current row of a key is the one of its newest batch.
    No stored row is ever read or rewritten while streaming.

    Batch ids belong to a checkpoint: a job started afresh needs a new path as well. A long-lived
    table is compacted now and then, since readers fold all of its batches.
    """

    path: str
    keys: tuple[str, ...]

    def put(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        log = spark.read.parquet(self.path)
        rest = [c for c in log.columns if c not in (*self.keys, "batch")]
        newest = log.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), F.col("batch")).alias("row"))
        return newest.select(*self.keys, "row.*")

    def compact(self, spark: SparkSession, path: str) -> UpsertTable:
        """Copy the current rows into a fresh table of one batch, older than any later batch."""
        self.read(spark).write.mode("errorifexists").parquet(f"{path}/batch=-1")
        return UpsertTable(path, self.keys)


class Sink(Protocol):
    """What takes micro-batches by their id; the same batch again changes nothing."""

    def put(self, batch: DataFrame, batch_id: int) -> None: ...


def drain_upsert(stream: DataFrame, table: Sink, checkpoint: str) -> None:
    """Process everything available in update mode into a keyed table, then stop."""
    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(table.put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def start_upsert(stream: DataFrame, table: Sink, checkpoint: str, every: str = "10 seconds"):
    """Feed a keyed table continuously in update mode."""
    return (
        stream.writeStream.outputMode("update")
        .foreachBatch(table.put)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )


def drain_complete(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything available, replacing the small result with each micro-batch."""
    query = (
        stream.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
