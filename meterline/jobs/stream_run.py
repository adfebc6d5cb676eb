"""Run one stream job, from a Kafka topic or from landed message files.

    python -m meterline.jobs.stream_run --job location_revenue --target DIR --checkpoint DIR \\
        (--servers HOST:PORT --topic rides [--start earliest] | --files DIR) [--once]

The same checkpoint folder resumes a job; a new one starts it afresh. Kafka needs the connector
package on the class path (spark-submit --packages).
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from meterline.operators.windows import TIME
from meterline.session import build_session, streaming_session
from meterline.sources.messages import decode_green_events, decode_rides, kafka_stream, text_stream
from meterline.streaming import jobs
from meterline.streaming.keyed import SessionTable
from meterline.streaming.run import Sink, UpsertTable, drain, drain_upsert, start, start_upsert, with_event_time


@dataclass(frozen=True)
class StreamJob:
    """``keys`` makes the target a keyed table fed in update mode, ``table`` one of another kind; without either rows are appended."""

    decode: Callable[[DataFrame], DataFrame]
    transform: Callable[[DataFrame], DataFrame]
    windowed: bool = True
    keys: tuple[str, ...] = ()
    table: Callable[[str], Sink] | None = None

    def sink(self, target: str) -> Sink | None:
        if self.table is not None:
            return self.table(target)
        return UpsertTable(target, self.keys) if self.keys else None


# How late an event may be to correct a stored session.
SESSION_LATENESS = 86_400

JOBS = {
    "pass_through": StreamJob(decode_rides, jobs.pass_through, windowed=False),
    "location_revenue": StreamJob(decode_rides, jobs.location_revenue, keys=("window_start", "PULocationID")),
    "location_revenue_10s": StreamJob(decode_rides, lambda e: jobs.location_revenue(e, "10 seconds")),
    "location_trips": StreamJob(decode_green_events, jobs.location_trips, keys=("window_start", "PULocationID")),
    "tips": StreamJob(decode_green_events, jobs.tips, keys=("window_start",)),
    "sliding_revenue": StreamJob(decode_rides, jobs.sliding_revenue),
    # Session windows are not allowed in update mode, so finished sessions are appended.
    "location_sessions": StreamJob(decode_green_events, jobs.location_sessions),
    # Sessions as they stand, corrected by late events. The table has its own lateness.
    "corrected_sessions": StreamJob(
        decode_green_events,
        lambda e: e.select("PULocationID", TIME),
        windowed=False,
        table=lambda target: SessionTable(target, ("PULocationID",), 300, SESSION_LATENESS),
    ),
}


def run(
    spark: SparkSession, messages: DataFrame, name: str, target: str, checkpoint: str, once: bool, delay: str = "5 seconds"
):
    """Drain the messages at hand, or return the running query."""
    job = JOBS[name]
    events = job.decode(messages)
    if job.windowed:
        events = with_event_time(events, delay=delay)
    result = job.transform(events)
    table = job.sink(target)
    if table is not None:
        return drain_upsert(result, table, checkpoint) if once else start_upsert(result, table, checkpoint)
    return drain(result, target, checkpoint) if once else start(result, target, checkpoint)


def main() -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--job", required=True, choices=sorted(JOBS))
    parser.add_argument("--target", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--servers")
    parser.add_argument("--topic")
    parser.add_argument("--start", default="earliest", help="earliest, latest or epoch milliseconds")
    parser.add_argument("--files")
    parser.add_argument("--files-per-batch", type=int, help="with --files: limit of a micro-batch")
    parser.add_argument("--delay", default="5 seconds", help="watermark delay, or the lateness to allow")
    parser.add_argument("--once", action="store_true")
    args = parser.parse_args()
    spark = streaming_session(build_session("stream_run"))
    if args.files:
        messages = text_stream(spark, args.files, args.files_per_batch)
    else:
        begin = int(args.start) if args.start.isdigit() else args.start
        messages = kafka_stream(spark, args.servers, args.topic, begin)
    query = run(spark, messages, args.job, args.target, args.checkpoint, args.once, args.delay)
    if query is not None:
        query.awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
