"""Stream jobs over the event table, drained once and read back, and their batch counterparts.

In append mode a window is stored once the watermark, five seconds behind the newest event, has
passed its end. The SQL states the same rule.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.operators.ranking import top_n
from meterline.operators.windows import batch_hop, batch_sessions
from meterline.queries.base import query
from meterline.queries.scans import ride_messages
from meterline.session import run_dir, streaming_session
from meterline.sources import messages
from meterline.sources.sample import ride_events
from meterline.streaming import jobs
from meterline.streaming.keyed import DAY_OF_WINDOW, BucketTable, SessionTable
from meterline.streaming.run import UpsertTable, drain, drain_complete, drain_upsert, with_event_time


def event_stream(spark, path: str):
    """Stream over Parquet event files, in the shape of decoded rides. ``path`` is a folder or one file."""
    stored = spark.read.parquet(path)
    first = stored.select("_metadata.file_path").first()
    reader = spark.readStream.schema(stored.schema)
    folder, _, name = path.rstrip("/").rpartition("/")
    if first is not None and first.file_path.endswith(f"/{name}"):
        events = reader.option("pathGlobFilter", name).parquet(folder)
    else:
        events = reader.parquet(path)
    return events.select(
        F.col("user_id").cast("int").alias("PULocationID"),
        "event_type",
        F.col("value").alias("total_amount"),
        F.col("value").alias("tip_amount"),
        F.col("value").alias("trip_distance"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
    )


def _job(spark, sf_dir, label: str, transform, delay: str = "5 seconds"):
    """Run one append-mode job over the whole event table and return what it stored."""
    side = streaming_session(spark)
    root = run_dir(spark, label)
    events = with_event_time(event_stream(side, f"{sf_dir}/events.parquet"), delay=delay)
    drain(transform(events), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


CLOSED = "(SELECT date_trunc('milliseconds', MAX(ts)) - INTERVAL 5 SECOND FROM events)"
REVENUE = "COUNT(*) AS num_trips, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue"
LOCATION = 'user_id AS "PULocationID"'


def _tumble_sql(width: str, measures: str, key: str = LOCATION, closed: bool = True) -> str:
    keys = f"{key}, " if key else ""
    rule = f"WHERE window_start + INTERVAL {width} <= {CLOSED}" if closed else ""
    return (
        f"SELECT * FROM (SELECT time_bucket(INTERVAL {width}, ts) AS window_start, {keys}{measures} "
        f"FROM events GROUP BY ALL) {rule}"
    )


@query(
    "stream_pass_through",
    """SELECT user_id AS "PULocationID", user_id + 1 AS "DOLocationID", value AS trip_distance, value AS total_amount,
    date_trunc('milliseconds', ts) AS pickup_datetime FROM events""",
)
def stream_pass_through(spark, sf_dir):
    side, root = streaming_session(spark), run_dir(spark, "pass_through")
    ride_messages(spark, sf_dir).write.text(f"{root}/in")
    rides = messages.decode_rides(messages.text_stream(side, f"{root}/in"))
    drain(jobs.pass_through(rides), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


def _hourly_upserts(spark, sf_dir):
    side, root = streaming_session(spark), run_dir(spark, "hourly")
    stored = UpsertTable(f"{root}/out", ("window_start", "PULocationID"))
    events = with_event_time(event_stream(side, f"{sf_dir}/events.parquet"))
    drain_upsert(jobs.location_revenue(events), stored, f"{root}/checkpoint")
    return stored.read(spark)


@query("tumble_1h_revenue", _tumble_sql("1 HOUR", REVENUE, closed=False))
def tumble_1h_revenue(spark, sf_dir):
    return _hourly_upserts(spark, sf_dir)


@query("tumble_10s", _tumble_sql("10 SECOND", REVENUE))
def tumble_10s(spark, sf_dir):
    return _job(spark, sf_dir, "ten_seconds", lambda e: jobs.location_revenue(e, "10 seconds"))


@query("tumble_5m_trips", _tumble_sql("5 MINUTE", "COUNT(*) AS num_trips"))
def tumble_5m_trips(spark, sf_dir):
    return _job(spark, sf_dir, "five_minutes", jobs.location_trips)


@query("tumble_1h_tips", _tumble_sql("1 HOUR", "CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_tip", key=""))
def tumble_1h_tips(spark, sf_dir):
    return _job(spark, sf_dir, "tips", jobs.tips)


def _session_sql(gap: str, key: str | None, closed: bool) -> str:
    part = f"PARTITION BY {key} " if key else ""
    column = f"{key}, " if key else ""
    shown = f"{LOCATION}, " if key else ""
    rule = f"WHERE window_end <= {CLOSED}" if closed else ""
    return f"""WITH g AS (SELECT *, LAG(ts) OVER ({part}ORDER BY ts, event_id) AS prev FROM events),
    n AS (SELECT *, SUM(CASE WHEN prev IS NULL OR ts - prev > INTERVAL {gap} THEN 1 ELSE 0 END) OVER ({part}ORDER BY ts, event_id) AS sid FROM g),
    s AS (SELECT MIN(ts) AS window_start, MAX(ts) + INTERVAL {gap} AS window_end, {shown}COUNT(*) AS num_trips FROM n GROUP BY {column}sid)
    SELECT * FROM s {rule}"""


@query("session_per_key", _session_sql("5 MINUTE", "user_id", closed=True))
def session_per_key(spark, sf_dir):
    return _job(spark, sf_dir, "sessions", jobs.location_sessions)


@query("session_global", _session_sql("5 MINUTE", None, closed=False))
def session_global(spark, sf_dir):
    return batch_sessions(ride_events(spark, sf_dir), 300, [])


HOP_SQL = f"""WITH e AS (SELECT ts, user_id, value, unnest(range(4)) AS i FROM events)
SELECT time_bucket(INTERVAL 15 MINUTE, ts) - i * INTERVAL 15 MINUTE AS window_start,
       time_bucket(INTERVAL 15 MINUTE, ts) - i * INTERVAL 15 MINUTE + INTERVAL 1 HOUR AS window_end, {LOCATION}, {REVENUE}
FROM e GROUP BY ALL"""


@query("hop_1h_15m", HOP_SQL)
def hop_1h_15m(spark, sf_dir):
    sums = {"num_trips": F.lit(1), "total_revenue": F.col("total_amount").cast("decimal(18,2)")}
    return batch_hop(ride_events(spark, sf_dir), 3600, 900, ["PULocationID"], sums)


@query("stream_hop", f"SELECT * FROM ({HOP_SQL}) WHERE window_end <= {CLOSED}")
def stream_hop(spark, sf_dir):
    return _job(spark, sf_dir, "hop", jobs.sliding_revenue)


@query("stream_filter_count", "SELECT COUNT(*) AS trip_count FROM events WHERE value > 5.0")
def stream_filter_count(spark, sf_dir):
    side, root = streaming_session(spark), run_dir(spark, "longer")
    drain_complete(
        jobs.count_longer(event_stream(side, f"{sf_dir}/events.parquet")), f"{root}/out", f"{root}/checkpoint"
    )
    return spark.read.parquet(f"{root}/out")


def _in_two_steps(spark, sf_dir, label: str, run_step):
    """Land all events but the errors, run the job, land the errors, run it again from its checkpoint."""
    side, root = streaming_session(spark), run_dir(spark, label)
    events = side.read.parquet(f"{sf_dir}/events.parquet")
    late = F.col("event_type") == "error"
    for step in (events.where(~late), events.where(late)):
        step.write.mode("append").parquet(f"{root}/in")
        run_step(event_stream(side, f"{root}/in"), root)
    return root


FIRST_MARK = "(SELECT date_trunc('milliseconds', MAX(ts)) - INTERVAL 5 SECOND FROM events WHERE event_type <> 'error')"


@query(
    "stream_late_drop",
    f"""SELECT * FROM (SELECT time_bucket(INTERVAL 10 SECOND, ts) AS window_start, {LOCATION}, {REVENUE} FROM events
    WHERE event_type <> 'error' OR time_bucket(INTERVAL 10 SECOND, ts) + INTERVAL 10 SECOND > {FIRST_MARK} GROUP BY ALL)
    WHERE window_start + INTERVAL 10 SECOND <= {CLOSED}""",
)
def stream_late_drop(spark, sf_dir):
    def run_step(stream, root):
        windows = jobs.location_revenue(with_event_time(stream), "10 seconds")
        drain(windows, f"{root}/out", f"{root}/checkpoint")

    return spark.read.parquet(f"{_in_two_steps(spark, sf_dir, 'late', run_step)}/out")


@query("stream_upsert", _tumble_sql("1 HOUR", REVENUE, closed=False))
def stream_upsert(spark, sf_dir):
    """The errors come a month late. With that much lateness allowed they correct stored windows."""
    keys = ("window_start", "PULocationID")

    def run_step(stream, root):
        windows = jobs.location_revenue(with_event_time(stream, delay="60 days"))
        drain_upsert(windows, UpsertTable(f"{root}/out", keys), f"{root}/checkpoint")

    return UpsertTable(f"{_in_two_steps(spark, sf_dir, 'upserts', run_step)}/out", keys).read(spark)


@query("stream_upsert_buckets", _tumble_sql("1 HOUR", REVENUE, closed=False))
def stream_upsert_buckets(spark, sf_dir):
    """The same corrections in a table by day: the late events rewrite the days they belong to."""
    keys = ("window_start", "PULocationID")

    def run_step(stream, root):
        windows = jobs.location_revenue(with_event_time(stream, delay="60 days"))
        drain_upsert(windows, BucketTable(f"{root}/out", keys, DAY_OF_WINDOW), f"{root}/checkpoint")

    return BucketTable(f"{_in_two_steps(spark, sf_dir, 'buckets', run_step)}/out", keys, DAY_OF_WINDOW).read(spark)


@query("session_corrections", _session_sql("5 MINUTE", "user_id", closed=False))
def session_corrections(spark, sf_dir):
    """The errors come a month late and extend, bridge or add to the sessions stored before."""
    keys, month = ("PULocationID",), 60 * 86_400

    def run_step(stream, root):
        drain_upsert(stream, SessionTable(f"{root}/out", keys, 300, month), f"{root}/checkpoint")

    return SessionTable(f"{_in_two_steps(spark, sf_dir, 'corrected', run_step)}/out", keys, 300, month).read(spark)


@query(
    "stream_batch_parity",
    f"""SELECT window_start, "PULocationID", num_trips AS stream_trips, num_trips AS batch_trips, TRUE AS is_match
    FROM ({_tumble_sql("1 HOUR", REVENUE, closed=False)})""",
)
def stream_batch_parity(spark, sf_dir):
    keys = ["window_start", "PULocationID"]

    def side(df, name):
        return df.select(*keys, F.col("num_trips").alias(f"{name}_trips"), F.col("total_revenue").alias(f"{name}_revenue"))

    batch = side(jobs.location_revenue(ride_events(spark, sf_dir)), "batch")
    both = side(_hourly_upserts(spark, sf_dir), "stream").join(batch, keys, "full")
    same = F.col("stream_trips").eqNullSafe(F.col("batch_trips")) & F.col("stream_revenue").eqNullSafe(
        F.col("batch_revenue")
    )
    return both.select(*keys, "stream_trips", "batch_trips", same.alias("is_match"))


@query(
    "window_rollup",
    f"""SELECT window_start, COUNT(*) AS locations, CAST(SUM(num_trips) AS BIGINT) AS num_trips,
    CAST(SUM(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
    FROM ({_tumble_sql("1 HOUR", REVENUE, closed=False)}) GROUP BY window_start""",
)
def window_rollup(spark, sf_dir):
    """From the table that the stream has stored."""
    return jobs.rollup(_hourly_upserts(spark, sf_dir))


@query(
    "window_top3",
    f"""SELECT * FROM ({_tumble_sql("5 MINUTE", "COUNT(*) AS num_trips", closed=False)})
    ORDER BY num_trips DESC, window_start, "PULocationID" LIMIT 3""",
)
def window_top3(spark, sf_dir):
    return top_n(jobs.location_trips(ride_events(spark, sf_dir)), "num_trips", 3, ["window_start", "PULocationID"])
