"""Keyed tables that micro-batches rewrite bucket by bucket, and sessions that late events correct."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.windows import TIME, batch_sessions, merge_sessions
from meterline.sinks.folders import delete_folder, names_below, numbers_below
from meterline.sinks.tables import rebalanced

BUCKET = "__bucket"

# Bucket of a window table: the day its window begins, so that a batch rewrites the days it touches only.
DAY_OF_WINDOW = "floor(unix_seconds(window_start) / 86400)"

Merge = Callable[[DataFrame | None, DataFrame], DataFrame]


@dataclass(frozen=True)
class BucketTable:
    """Keyed table whose reads cost the same after any number of micro-batches.

    A micro-batch is joined with the current rows of the buckets it touches, and these buckets are written anew below its id.
    A version, one small file per batch, then says for each bucket which batch wrote it last; a reader opens
    those folders and no others. Until its version is there a batch is invisible, and a batch tried again starts from the version
    before it and replaces its own folders.

    ``bucket`` is an SQL expression that gives a whole number; the default spreads the keys over ``buckets``. Rows that age, such as windows,
    are best put by their time. Batch ids belong to a checkpoint: a job started afresh needs a new path. ``vacuum`` deletes what no
    recent version names.
    """

    path: str
    keys: tuple[str, ...]
    bucket: str | None = None
    buckets: int = 64

    def _bucket(self) -> Column:
        spread = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets))
        return F.coalesce((spread if self.bucket is None else F.expr(self.bucket)).cast("bigint"), F.lit(-1))

    def versions(self, spark: SparkSession) -> list[int]:
        """Ids of the batches that are complete, oldest first."""
        found = numbers_below(spark, f"{self.path}/versions", "batch")
        return [n for n in found if "_SUCCESS" in names_below(spark, f"{self.path}/versions/batch={n}")]

    def newest(self, spark: SparkSession, before: int | None = None) -> int | None:
        """The newest version, or the newest before a batch; None where there is none."""
        return max((n for n in self.versions(spark) if before is None or n < before), default=None)

    def _written(self, spark: SparkSession, version: int | None) -> dict[int, int]:
        if version is None:
            return {}
        entries = spark.read.schema("bucket long, batch long").parquet(f"{self.path}/versions/batch={version}")
        return {r["bucket"]: r["batch"] for r in entries.collect()}  # a row per bucket

    def rows(self, spark: SparkSession, version: int | None, buckets: set[int] | None = None) -> DataFrame | None:
        """Rows of a version, of all buckets or of some; None where there are none."""
        entries = self._written(spark, version)
        folders = [
            f"{self.path}/data/batch={batch}/{BUCKET}={bucket}"
            for bucket, batch in sorted(entries.items())
            if buckets is None or bucket in buckets
        ]
        return spark.read.parquet(*folders) if folders else None

    def read(self, spark: SparkSession) -> DataFrame:
        """The current rows. A table that never got a row has no columns to show and raises."""
        current = self.rows(spark, self.newest(spark))
        if current is None:
            raise ValueError(f"no rows in {self.path}")
        return current

    def put(self, batch: DataFrame, batch_id: int, merge: Merge | None = None) -> None:
        """Join a micro-batch with the table. Without ``merge`` a row replaces the one of its key; a batch has one row per key."""
        spark = batch.sparkSession
        landed = f"{self.path}/landed/batch={batch_id}"
        batch.write.mode("overwrite").parquet(landed)
        given = spark.read.schema(batch.schema).parquet(landed)
        touched = {r[0] for r in given.select(self._bucket()).distinct().collect()}  # numbers of buckets, no rows
        before = self.newest(spark, batch_id)
        current = self.rows(spark, before, touched)
        merged = (merge or self._replaced)(current, given).withColumn(BUCKET, self._bucket())
        data = f"{self.path}/data/batch={batch_id}"
        delete_folder(spark, data)
        ordered = rebalanced(merged, BUCKET).sortWithinPartitions(BUCKET, *self.keys)
        ordered.write.mode("overwrite").partitionBy(BUCKET).parquet(data)
        kept = {b: n for b, n in self._written(spark, before).items() if b not in touched}
        kept |= dict.fromkeys(numbers_below(spark, data, BUCKET), batch_id)
        entries = spark.createDataFrame(sorted(kept.items()), "bucket long, batch long").coalesce(1)
        entries.write.mode("overwrite").parquet(f"{self.path}/versions/batch={batch_id}")
        delete_folder(spark, landed)

    def _replaced(self, current: DataFrame | None, given: DataFrame) -> DataFrame:
        if current is None:
            return given
        rest = [c for c in given.columns if c not in self.keys]
        both = current.withColumn("__new", F.lit(0)).unionByName(given.withColumn("__new", F.lit(1)))
        newest = both.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), F.col("__new")).alias("__row"))
        return newest.select(*self.keys, "__row.*")

    def vacuum(self, spark: SparkSession, keep: int = 10) -> int:
        """Delete all versions but the newest ones and the buckets that none of these names; returns how many folders went.

        Readers of a version older than that lose it, so ``keep`` covers the longest read.
        """
        found = self.versions(spark)
        kept = found[-max(keep, 2) :]  # a batch tried again needs the version before it
        named = {(bucket, batch) for version in kept for bucket, batch in self._written(spark, version).items()}
        gone = 0
        for version in found[: -len(kept)] if kept else []:
            gone += delete_folder(spark, f"{self.path}/versions/batch={version}")
        for batch in numbers_below(spark, f"{self.path}/data", "batch"):
            if kept and batch > kept[-1]:
                continue  # being written
            folder = f"{self.path}/data/batch={batch}"
            buckets = numbers_below(spark, folder, BUCKET)
            unnamed = [b for b in buckets if (b, batch) not in named]
            if len(unnamed) == len(buckets):
                gone += delete_folder(spark, folder)
            else:
                gone += sum(delete_folder(spark, f"{folder}/{BUCKET}={b}") for b in unnamed)
        return gone


@dataclass(frozen=True)
class SessionTable:
    """Sessions fed by micro-batches of events, corrected when late events extend or bridge them.

    Spark's own session windows are only stored once the watermark has closed them. Here every batch is sessionized alone, with the
    event folding of ``batch_sessions``, and its sessions are joined with the open ones of the keys it touches. A session that was
    joined with another is gone from the next version, so each one is a single row at any time.

    Events more than ``lateness_seconds`` older than the newest event of earlier batches are dropped, as by a watermark. A session that no
    accepted event can reach any more leaves the open buckets for an append-only log when its bucket is written the next time, so
    what a batch rewrites is bounded by the lateness and not by the history. Rows without a time have no session.
    """

    path: str
    keys: tuple[str, ...]
    gap_seconds: int
    lateness_seconds: int
    time: str = TIME
    buckets: int = 64

    @property
    def open_sessions(self) -> BucketTable:
        return BucketTable(f"{self.path}/open", self.keys, buckets=self.buckets)

    def _last_event(self, sessions: DataFrame | None) -> int | None:
        """Time of the newest event in microseconds. The newest session is always open."""
        if sessions is None:
            return None
        end = sessions.agg(F.max(F.unix_micros("window_end")).alias("end")).first()["end"]
        return None if end is None else end - self.gap_seconds * 1_000_000

    def put(self, events: DataFrame, batch_id: int) -> None:
        spark, allowed = events.sparkSession, self.lateness_seconds * 1_000_000
        seen = self._last_event(self.open_sessions.rows(spark, self.open_sessions.newest(spark, batch_id)))
        timed = events.where(F.col(self.time).isNotNull())
        if seen is not None:
            timed = timed.where(F.unix_micros(self.time) >= F.lit(seen - allowed))
        found = batch_sessions(timed, self.gap_seconds, list(self.keys), self.time)

        def merge(current: DataFrame | None, given: DataFrame) -> DataFrame:
            newest = max((t for t in (seen, self._last_event(given)) if t is not None), default=None)
            merged = given if current is None else merge_sessions(current.unionByName(given), self.gap_seconds, list(self.keys))
            staged = f"{self.path}/merged/batch={batch_id}"
            merged.write.mode("overwrite").parquet(staged)
            stored = spark.read.schema(merged.schema).parquet(staged)
            closed = F.lit(False) if newest is None else F.unix_micros("window_end") < F.lit(newest - allowed)
            stored.where(closed).write.mode("overwrite").parquet(f"{self.path}/closed/batch={batch_id}")
            return stored.where(~closed)

        self.open_sessions.put(found, batch_id, merge)
        delete_folder(spark, f"{self.path}/merged/batch={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        """All sessions as of the newest complete batch."""
        version = self.open_sessions.newest(spark)
        current = self.open_sessions.rows(spark, version)
        if current is None:
            raise ValueError(f"no sessions in {self.path}")
        closed = spark.read.schema(f"{_ddl(current)}, batch long").parquet(f"{self.path}/closed")
        return current.unionByName(closed.where(F.col("batch") <= version).drop("batch"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
