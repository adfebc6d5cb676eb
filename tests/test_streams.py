import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import rows
from meterline.jobs import stream_run
from meterline.session import streaming_session
from meterline.sources import messages
from meterline.streaming import jobs
from meterline.streaming.run import UpsertTable, drain, drain_complete, drain_upsert, with_event_time

DAY = "2025-10-01 "


def put(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def ride(time, location=79, amount=1.0):
    millis = int(datetime.fromisoformat(f"2025-10-01T{time}+00:00").timestamp() * 1000)
    return json.dumps(
        {
            "PULocationID": location,
            "DOLocationID": 1,
            "trip_distance": 6.0,
            "total_amount": amount,
            "tpep_pickup_datetime": millis,
        }
    )


STEPS = [["14:00:07"], ["14:00:12", "14:00:04"], ["14:00:15"], ["14:00:16"], ["14:00:05"], ["14:00:30"]]


def rides(side, path):
    return with_event_time(messages.decode_rides(messages.text_stream(side, path)))


def at(time):
    return datetime.fromisoformat(f"{DAY}{time}")


def test_late_rows_in_append_mode(spark, tmp_path):
    side, source, out = streaming_session(spark), str(tmp_path / "in"), str(tmp_path / "out")
    stored = []
    for step in STEPS:
        put(spark, source, [ride(t) for t in step])
        drain(jobs.location_revenue(rides(side, source), "10 seconds"), out, str(tmp_path / "cp"))
        stored.append(rows(spark.read.parquet(out), "window_start", "num_trips"))
    first, second = (at("14:00:00"), 2), (at("14:00:10"), 3)
    assert stored == [[], [], [first], [first], [first], [first, second]]


def test_late_rows_in_update_mode(spark, tmp_path):
    side, source = streaming_session(spark), str(tmp_path / "in")
    table = UpsertTable(str(tmp_path / "out"), ("window_start", "PULocationID"))
    for step in STEPS:
        put(spark, source, [ride(t) for t in step])
        drain_upsert(jobs.location_revenue(rides(side, source), "10 seconds"), table, str(tmp_path / "cp"))
    expected = [(at("14:00:00"), 79, 2, 2.0), (at("14:00:10"), 79, 3, 3.0), (at("14:00:30"), 79, 1, 1.0)]
    columns = ["window_start", "PULocationID", "num_trips", "total_revenue"]
    assert rows(table.read(spark), *columns) == expected
    small = table.compact(spark, str(tmp_path / "compact"))
    assert rows(small.read(spark), *columns) == expected


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = UpsertTable(str(tmp_path / "t"), ("k",))
    table.put(spark.createDataFrame([(1, 10), (2, 20)], "k int, v int"), 0)
    newer = spark.createDataFrame([(2, 21), (3, 30)], "k int, v int")
    for _ in range(2):
        table.put(newer, 1)
    assert rows(table.read(spark), "k", "v") == [(1, 10), (2, 21), (3, 30)]


def test_sessions_are_split_by_key(spark, tmp_path):
    side, source, out = streaming_session(spark), str(tmp_path / "in"), str(tmp_path / "out")
    times = [("00:00:00", 1), ("00:05:00", 1), ("00:10:01", 1), ("00:02:00", 2), ("12:00:00", 9)]
    put(spark, source, [ride(t, k) for t, k in times])
    drain(jobs.location_sessions(rides(side, source)), out, str(tmp_path / "cp"))
    assert rows(spark.read.parquet(out), "PULocationID", "window_start", "window_end", "num_trips") == [
        (1, at("00:00:00"), at("00:10:00"), 2),
        (1, at("00:10:01"), at("00:15:01"), 1),
        (2, at("00:02:00"), at("00:07:00"), 1),
    ]


def green(**changed):
    base = {
        "PULocationID": 74,
        "DOLocationID": 1,
        "passenger_count": 1.0,
        "trip_distance": 2.0,
        "tip_amount": 0.5,
        "total_amount": 9.0,
        "lpep_pickup_datetime": "2025-10-01 00:00:00",
        "lpep_dropoff_datetime": "2025-10-01 00:05:00",
    }
    return json.dumps({**base, **changed})


def test_bad_messages_are_skipped(spark):
    lines = [
        green(PULocationID=1),
        green(PULocationID=2, passenger_count=None),
        green(PULocationID=3, passenger_count=float("nan")),
        green(PULocationID=4)[:-9],
        green(PULocationID=5, lpep_pickup_datetime="later"),
        "",
        "null",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert rows(messages.decode_green_events(df), "PULocationID", "passenger_count") == [(1, 1.0), (2, None)]


def test_replay_round_trip(spark):
    df = spark.createDataFrame(
        [(1, 2.5, datetime(2025, 10, 1, 3, 4, 5)), (2, float("nan"), None)], "id int, x double, t timestamp"
    )
    got = [json.loads(r.value) for r in jobs.replay_messages(df).collect()]
    assert got == [{"id": 1, "x": 2.5, "t": "2025-10-01 03:04:05"}, {"id": 2, "x": None, "t": None}]


def test_running_count(spark, tmp_path):
    side, source, out = streaming_session(spark), str(tmp_path / "in"), str(tmp_path / "out")
    for _ in range(2):
        put(spark, source, [ride("01:00:00"), ride("02:00:00").replace("6.0", "5.0")])
        counted = jobs.count_longer(messages.decode_rides(messages.text_stream(side, source)))
        drain_complete(counted, out, str(tmp_path / "cp"))
    assert rows(spark.read.parquet(out)) == [(2,)]


@pytest.mark.parametrize("name", sorted(stream_run.JOBS))
def test_every_job_drains(spark, tmp_path, name):
    side, source, out = streaming_session(spark), str(tmp_path / "in"), str(tmp_path / "out")
    if stream_run.JOBS[name].decode is messages.decode_rides:
        lines = [ride("01:00:00"), ride("01:00:01"), ride("09:00:00")]
    else:
        lines = [green(), green(), green(lpep_pickup_datetime="2025-10-01 09:00:00")]
    put(spark, source, lines)
    stream_run.run(side, messages.text_stream(side, source), name, out, str(tmp_path / "cp"), once=True)
    sink = stream_run.JOBS[name].sink(out)
    stored = spark.read.parquet(out) if sink is None else sink.read(spark)
    assert stored.count() >= 1


def test_same_rows_from_batch_and_stream(spark, tmp_path):
    side, source = streaming_session(spark), str(tmp_path / "in")
    put(spark, source, [ride(f"{h:02d}:{m:02d}:00", h % 3, h + m / 100) for h in range(20) for m in (5, 25, 45)])
    table = UpsertTable(str(tmp_path / "out"), ("window_start", "PULocationID"))
    drain_upsert(jobs.location_revenue(rides(side, source)), table, str(tmp_path / "cp"))
    batch = jobs.location_revenue(messages.decode_rides(spark.read.text(source)))
    columns = ["window_start", "PULocationID", "num_trips", "total_revenue"]
    assert rows(table.read(spark), *columns) == rows(batch, *columns)
    assert rows(jobs.rollup(batch).agg(F.sum("num_trips"))) == [(60,)]
