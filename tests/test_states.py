"""Monthly states, bitmaps, keyed tables in buckets and corrected sessions."""

import random
import re
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from meterline.jobs.lanes import run_in_order
from meterline.jobs.refresh_models import KEPT, Store, chosen, in_months, months_to_rewrite, refresh
from meterline.operators.bitmaps import bitmap_distinct, id_bitmaps, merged_bitmaps
from meterline.operators.windows import batch_sessions, merge_sessions
from meterline.plans import analytics
from meterline.schemas import FHV_RAW, GREEN_RAW, YELLOW_RAW, ZONES
from meterline.sinks.folders import delete_folder, names_below
from meterline.sinks.tables import drop_table, replace_partitions, write_bucketed
from meterline.streaming.keyed import DAY_OF_WINDOW, BucketTable, SessionTable
from test_models import ZONE_ROWS, raw, trip


def store(spark, target, green, yellow=(trip("2020-01-02"), trip("2020-02-02"))):
    frames = {
        "green": raw(spark, "lpep", GREEN_RAW, *green),
        "yellow": raw(spark, "tpep", YELLOW_RAW, *yellow),
        "zones": spark.createDataFrame([z for z in ZONE_ROWS if z[2]], ZONES),
        "fhv": spark.createDataFrame([], FHV_RAW),
    }
    return Store(spark, frames.__getitem__, str(target))


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


BEFORE = [trip("2019-12-05", total=100.0), trip("2020-01-05", total=150.0), trip("2020-01-06", 56, 30.0), trip("2020-02-05", 56, 70.0), trip("2020-03-07", 56, 50.0), trip("2020-04-07", 74, 5.0), trip("2020-05-07", 74, 6.0)]
# January comes again without zone 56, with another amount and with one trip more.
AFTER = [t for t in BEFORE if not t[0].startswith("2020-01")] + [trip("2020-01-05", total=90.0), trip("2020-01-15", 57, 5.0)]


def test_one_month_equals_a_full_build(spark, tmp_path):
    kept, fresh = str(tmp_path / "kept"), str(tmp_path / "fresh")
    refresh(store(spark, kept, BEFORE))
    before = {name: files_of(f"{kept}/{name}") for name in KEPT}
    written = refresh(store(spark, kept, AFTER), [(2020, 1)])
    refresh(store(spark, fresh, AFTER))
    for name in KEPT:
        columns = sorted(spark.read.parquet(f"{fresh}/{name}").columns)
        assert rows(spark.read.parquet(f"{kept}/{name}"), *columns) == rows(spark.read.parquet(f"{fresh}/{name}"), *columns), name
    assert written["fct_trips"] == written["monthly_zone_revenue"] == written["kpi_ids"] == [(2020, 1)]
    # Zone 56 is first seen in February now, zone 74 is compared again in April, the sums of the month in February.
    assert written["revenue_growth"] == [(2020, 1), (2020, 2), (2020, 4)]
    assert written["monthly_kpis"] == [(2020, 1), (2020, 2)]
    for name in ("fct_trips", "zone_state", "monthly_zone_revenue", "fare_percentiles", "fact_trips", "kpi_pairs"):
        after = files_of(f"{kept}/{name}")
        same = {f for f in after if before[name].get(f) == after[f]}
        assert {f for f in after if "month=1/" not in f and "month_number=1/" not in f} <= same, name
        assert not any("=2020/pickup_month=1/" in f or "=2020/month_number=1/" in f for f in same), name


def test_a_month_that_loses_its_valid_trips(spark, tmp_path):
    """The facts keep the month, the marts lose it."""
    refresh(store(spark, tmp_path, BEFORE), names=["revenue_growth", "monthly_zone_revenue"])
    gone = [t for t in BEFORE if not t[0].startswith("2020-05")] + [trip("2020-05-07", fare=0.0)]
    refresh(store(spark, tmp_path, gone), [(2020, 5)], ["revenue_growth", "monthly_zone_revenue"])
    assert rows(spark.read.parquet(f"{tmp_path}/fct_trips").where("pickup_month = 5"), "is_invalid_trip") == [(True,)]
    for name, month in (("monthly_zone_revenue", "pickup_month"), ("revenue_growth", "month_number")):
        assert 5 not in {r[0] for r in spark.read.parquet(f"{tmp_path}/{name}").select(month).collect()}


def test_a_new_month_and_one_without_trips(spark, tmp_path):
    target = store(spark, tmp_path, BEFORE)
    refresh(target, names=["zone_state"])
    with pytest.raises(ValueError, match="2021, 1"):
        refresh(target, [(2020, 1), (2021, 1)], ["zone_state"])
    later = store(spark, tmp_path, [*BEFORE, trip("2021-01-01"), trip("2021-01-02")])
    assert refresh(later, [(2021, 1), (2021, 1)], ["zone_state"]) == {"fct_trips": [(2021, 1)], "zone_state": [(2021, 1)]}
    assert rows(spark.read.parquet(f"{tmp_path}/zone_state").where("pickup_year = 2021"), "trips") == [(2,)]


def test_selection_takes_what_is_needed():
    assert chosen(["yearly_kpis"]) == ["fact_trips", "kpi_pairs", "kpi_ids", "yearly_kpis"]
    assert chosen() == list(KEPT)
    with pytest.raises(ValueError):
        chosen(["nope"])


def test_month_ranges(spark):
    days = ["2019-11-30", "2019-12-01", "2020-01-31", "2020-02-01", "2020-05-01", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("timestamp").alias("t"))
    condition = in_months("t", [(2020, 1), (2019, 12), (2020, 5)])
    assert str(condition).count(">=") == 2
    assert [str(r[0])[:10] for r in df.where(condition).collect()] == ["2019-12-01", "2020-01-31", "2020-05-01"]
    assert df.where(in_months("t", None)).count() == 6
    assert df.where(in_months("t", [])).count() == 0


def test_months_behind_a_reloaded_one(spark):
    df = spark.createDataFrame([("a", 2020, 1), ("a", 2020, 3), ("a", 2020, 4), ("b", 2019, 5), ("b", 2021, 6), (None, 2020, 7)], "k string, y int, m int")
    assert months_to_rewrite(df, ("y", "m"), ("k",), [(2020, 2)]) == [(2020, 2), (2020, 3), (2020, 7), (2021, 6)]
    assert months_to_rewrite(df, ("y", "m"), ("k",), [(2021, 6)]) == [(2021, 6)]
    assert months_to_rewrite(df.limit(0), ("y", "m"), ("k",), [(2020, 1)]) == [(2020, 1)]


def test_replaced_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(12).select("id", (F.col("id") % 4).cast("int").alias("p"))
    df.write.partitionBy("p").parquet(path)
    kept = files_of(path)
    new = spark.createDataFrame([(100, 1), (101, 1), (102, 3)], "id long, p int")
    assert replace_partitions(new, path, ["p"], [(1,), (2,), (9,)]) == [(1,)]
    assert rows(spark.read.parquet(path).where("p > 0"), "p", "id") == [(1, 100), (1, 101), (3, 11), (3, 3), (3, 7)]
    assert names_below(spark, path) == ["_SUCCESS", "p=0", "p=1", "p=3"]
    assert {f: m for f, m in files_of(path).items() if "p=1" not in f} == {f: m for f, m in kept.items() if f[:3] in ("p=0", "p=3")}
    assert replace_partitions(new, path, ["p"], []) == []
    assert replace_partitions(new.limit(0), path, ["p"], [(3,)]) == []
    assert names_below(spark, path) == ["_SUCCESS", "p=0", "p=1"]
    assert not delete_folder(spark, f"{path}/p=7")
    assert names_below(spark, str(tmp_path / "absent")) == []


def test_bitmaps_count_like_distinct(spark):
    random.seed(5)
    ids = [None, 0, -1, -40_000, 32_767, 32_768, 32_769, 70_000, 2**40]
    given = [(random.choice([1, 2, 3]), random.choice("xyz"), random.choice(ids), random.choice([*ids, 5])) for _ in range(400)] + [(9, "x", None, None)]
    df = spark.createDataFrame(given, "g int, h string, a long, b long")
    states = id_bitmaps(df, ["g", "h"], ["a", "b"])
    for keys in (["g", "h"], ["g"], []):
        expected = df.where("a IS NOT NULL OR b IS NOT NULL").groupBy(*keys).agg(F.count_distinct("a"), F.count_distinct("b"))
        assert rows(bitmap_distinct(states, keys, {"a": "n_a", "b": "n_b"})) == rows(expected)
    assert merged_bitmaps(states, ["g"]).where("g = 9").count() == 0
    assert rows(bitmap_distinct(states.limit(0), [], {"a": "n"})) == [(0,)]
    assert rows(bitmap_distinct(states.limit(0), ["g"], {"a": "n"})) == []


def put_all(spark, table, *batches, schema="k int, v int"):
    for i, batch in enumerate(batches):
        table.put(spark.createDataFrame(batch, schema), i)


def test_bucket_table(spark, tmp_path):
    table = BucketTable(str(tmp_path / "t"), ("k",), buckets=4)
    put_all(spark, table, [(i, i) for i in range(20)] + [(None, 1)], [(3, 33), (50, 50), (None, 2)], [])
    expected = sorted([(i, 33 if i == 3 else i) for i in range(20)] + [(50, 50)]) + [(None, 2)]

    def current():
        return sorted(((r.k, r.v) for r in table.read(spark).collect()), key=lambda t: (t[0] is None, t[0]))

    assert current() == expected
    assert table.versions(spark) == [0, 1, 2]
    table.put(spark.createDataFrame([(3, 34)], "k int, v int"), 3)
    for _ in range(2):  # tried again, with rows that differ
        table.put(spark.createDataFrame([(3, 35)], "k int, v int"), 3)
        assert [v for k, v in current() if k == 3] == [35]
    assert table.vacuum(spark, keep=1) > 0
    assert [t for t in current() if t[0] != 3] == [t for t in expected if t[0] != 3]
    assert table.versions(spark) == [2, 3]
    assert table.vacuum(spark, keep=1) == 0
    assert names_below(spark, f"{tmp_path}/t/landed") == []


def test_reads_do_not_grow_with_the_batches(spark, tmp_path):
    table = BucketTable(str(tmp_path / "t"), ("k",), buckets=2)
    for i in range(6):
        table.put(spark.createDataFrame([(k, i) for k in range(10)], "k int, v int"), i)
    assert len(table.read(spark).inputFiles()) <= 2
    assert {r.v for r in table.read(spark).collect()} == {5}


def test_batches_rewrite_their_days_only(spark, tmp_path):
    table = BucketTable(str(tmp_path / "t"), ("window_start", "k"), DAY_OF_WINDOW)

    def put(batch_id, *given):
        df = spark.createDataFrame([(datetime.fromisoformat(t), k, v) for t, k, v in given], "window_start timestamp, k int, v int")
        table.put(df, batch_id)

    put(0, ("2024-01-01 05:00:00", 1, 1), ("2024-01-02 05:00:00", 1, 1))
    old = files_of(tmp_path / "t/data/batch=0")
    put(1, ("2024-01-02 05:00:00", 1, 2), ("2024-01-02 06:00:00", 1, 3))
    assert files_of(tmp_path / "t/data/batch=0") == old
    assert len(names_below(spark, f"{tmp_path}/t/data/batch=1")) == 2  # one day and the mark of success
    assert sorted(r.v for r in table.read(spark).collect()) == [1, 2, 3]


def test_an_incomplete_batch_is_invisible(spark, tmp_path):
    table = BucketTable(str(tmp_path / "t"), ("k",), buckets=1)
    with pytest.raises(ValueError):
        table.read(spark)
    assert table.vacuum(spark) == 0
    put_all(spark, table, [(1, 1)], [(1, 2)])
    Path(tmp_path / "t/versions/batch=1/_SUCCESS").unlink()
    assert rows(table.read(spark)) == [(1, 1)]
    table.put(spark.createDataFrame([(1, 2)], "k int, v int"), 1)
    assert rows(table.read(spark)) == [(1, 2)]


START = datetime(2024, 1, 1)


def events(spark, *given):
    return spark.createDataFrame([(k, None if s is None else START + timedelta(seconds=s)) for k, s in given], "k int, event_timestamp timestamp")


def spans(df):
    def seconds(t):
        return (t - START).total_seconds()

    return sorted(((r.k, seconds(r.window_start), seconds(r.window_end), r.num_trips) for r in df.collect()), key=lambda t: (t[0] is None, t))


def test_merged_sessions_of_parts(spark):
    parts = [(1, 0, 110, 3), (1, 20, 40, 1), (1, 60, 70, 1), (1, 110, 130, 2), (1, 141, 151, 1), (None, 0, 10, 1), (None, 5, 15, 1)]
    df = spark.createDataFrame([(k, START + timedelta(seconds=a), START + timedelta(seconds=b), n) for k, a, b, n in parts], "k int, window_start timestamp, window_end timestamp, num_trips long")
    assert spans(merge_sessions(df, 10, ["k"])) == [(1, 0, 130, 7), (1, 141, 151, 1), (None, 0, 15, 2)]


def test_a_late_event_bridges_two_sessions(spark, tmp_path):
    table = SessionTable(str(tmp_path / "s"), ("k",), 10, 1000, buckets=2)
    table.put(events(spark, (1, 0), (1, 18), (2, 5), (None, 3), (1, None)), 0)
    assert spans(table.read(spark)) == [(1, 0, 10, 1), (1, 18, 28, 1), (2, 5, 15, 1), (None, 3, 13, 1)]
    for _ in range(2):
        table.put(events(spark, (1, 9)), 1)
        assert spans(table.read(spark)) == [(1, 0, 28, 3), (2, 5, 15, 1), (None, 3, 13, 1)]
    table.put(events(spark), 2)
    assert len(spans(table.read(spark))) == 3


def test_closed_sessions_and_too_late_events(spark, tmp_path):
    table = SessionTable(str(tmp_path / "s"), ("k",), 10, 50, buckets=1)
    table.put(events(spark, (1, 0), (1, 5)), 0)
    table.put(events(spark, (1, 200)), 1)  # closes the first session: nothing before 150 is taken any more
    assert spark.read.parquet(f"{tmp_path}/s/closed/batch=1").count() == 1
    assert table.open_sessions.read(spark).count() == 1
    table.put(events(spark, (1, 12), (1, 149), (1, 150), (2, 160)), 2)
    expected = [(1, 0, 15, 2), (1, 150, 160, 1), (1, 200, 210, 1), (2, 160, 170, 1)]
    assert spans(table.read(spark)) == expected
    table.put(events(spark, (1, 12), (1, 149), (1, 150), (2, 160)), 2)  # the batch tried again
    assert spans(table.read(spark)) == expected


def test_any_order_gives_the_sessions_of_the_batch(spark, tmp_path):
    random.seed(11)
    given = [(random.choice([1, 1, 1, 2, 3, None]), random.randrange(3000)) for _ in range(300)]
    table = SessionTable(str(tmp_path / "s"), ("k",), 10, 10_000, buckets=3)
    for i in range(4):
        table.put(events(spark, *given[i::4]), i)
    assert spans(table.read(spark)) == spans(batch_sessions(events(spark, *given), 10, ["k"]))


def test_stored_years_meet_without_a_shuffle(spark, tmp_path):
    annual = spark.createDataFrame([(z, "Green", y, 20000.0 + y + i) for i, z in enumerate("abcdef") for y in (1998, 1999)], "pickup_zone string, service_type string, year int, _annual double")
    expected = rows(analytics.compare_years(annual, 1998, 1999))
    write_bucketed(annual, "annual_test", str(tmp_path / "a"), ["pickup_zone", "service_type"], 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" in plan_of(analytics.compare_years(annual, 1998, 1999))
        stored = analytics.compare_years(spark.table("annual_test"), 1998, 1999)
        assert not re.search(r"\bExchange\b", plan_of(stored))
        drop_table(spark, "annual_test")
        assert rows(stored) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_steps_follow_what_they_use():
    made, uses = [], {"a": (), "b": ("a",), "c": ("b", "x"), "d": (), "e": ("d",)}

    def make(name):
        if name == "b":
            raise RuntimeError("b")
        made.append(name)

    with pytest.raises(RuntimeError, match="b"):
        run_in_order(list(uses), uses.__getitem__, make, 2)
    assert "c" not in made and sorted(made) == ["a", "d", "e"] and made.index("d") < made.index("e")
