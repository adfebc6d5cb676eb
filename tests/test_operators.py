from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import plan_of, rows
from meterline.operators import percentiles, profile, windows
from meterline.operators.joins import join_null_safe, unmatched_keys
from meterline.operators.percentiles import exact_percentiles
from meterline.operators.ranking import extreme_days, share_of_total, top_n
from meterline.operators.windows import batch_hop, batch_sessions, hop, sessions

SHARES = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p97": 0.97, "p100": 1.0}


def check_percentiles(df, data):
    got = {r["g"]: r for r in exact_percentiles(df, ["g"], "v", SHARES).collect()}
    assert set(got) == set(data)
    for g, values in data.items():
        for name, share in SHARES.items():
            assert got[g][name] == pytest.approx(np.quantile(values, share), rel=1e-12, abs=1e-12)
        assert got[g]["value_count"] == len(values)
        assert (got[g]["value_min"], got[g]["value_max"]) == (min(values), max(values))


def test_percentiles_of_a_hot_group(spark):
    rng = np.random.default_rng(3)
    data = {
        "hot": np.round(rng.lognormal(2, 1.5, 20000), 2).tolist(),
        "one": [7.5],
        "same": [3.0] * 500,
        "few": [1.0, 2.0, 4.0],
        None: [5.0, 6.0],
    }
    pairs = [(g, float(v)) for g, values in data.items() for v in values] + [("few", None), ("void", None)]
    check_percentiles(spark.createDataFrame(pairs, "g string, v double").repartition(7), data)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-50, 50)), min_size=1, max_size=200))
def test_percentiles_of_any_list(spark, pairs):
    data = {}
    for g, v in pairs:
        data.setdefault(g, []).append(float(v))
    check_percentiles(spark.createDataFrame([(g, float(v)) for g, v in pairs], "g string, v double"), data)


def test_percentiles_without_groups(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    row = exact_percentiles(df, [], "v", {"p50": 0.5, "p95": 0.95}, {"total": F.col("v")}).first()
    assert (row.p50, row.p95, row.total, row.value_count) == (500.0, 950.0, 500500.0, 1001)
    assert exact_percentiles(df.where("v < 0"), [], "v", {"p50": 0.5}).count() == 0


def test_percentile_scan_is_shared(spark, tmp_path):
    path = str(tmp_path / "v")
    spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 0.5).alias("v")).write.parquet(path)
    df = exact_percentiles(spark.read.parquet(path), ["g"], "v", {"p50": 0.5}, {"s": F.col("v")})
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1


def test_join_null_safe(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, r string")
    assert rows(join_null_safe(left, right, ["k"])) == [(1, "a", "x"), (None, "b", "y")]


def test_unmatched_keys(spark):
    facts = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "k int")
    parents = spark.createDataFrame([(1,), (3,)], "id int")
    assert rows(unmatched_keys(facts, "k", parents, "id")) == [(2, 2)]


def test_top_n_breaks_ties(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1), ("d", None)], "k string, n int")
    assert [r.k for r in top_n(df, "n", 2, ["k"]).collect()] == ["a", "b"]
    assert [r.k for r in top_n(df, "n", 2, ["k"], ascending=True).collect()] == ["c", "a"]


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n int")
    assert rows(share_of_total(df, "n", "pct"), "k", "pct") == [("a", 25.0), ("b", 75.0)]


def test_extreme_days_take_the_earliest(spark):
    df = spark.createDataFrame([("d2", 5), ("d1", 5), ("d3", 1), ("d4", 1)], "day string, n int")
    assert tuple(extreme_days(df, "day", "n").first()) == ("d1", 5, "d3", 1)


def test_missing_values(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (None, 7), (4, 8)], "col1 int, col2 int").withColumn("full", F.lit(1))
    assert rows(profile.missing_values(df)) == [("col1", 1, 25.0), ("col2", 1, 25.0)]


def test_duplicate_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k int, s string")
    assert profile.duplicate_rows(df).first()[0] == 3
    assert profile.duplicate_rows(df.limit(0)).first()[0] == 0


def test_describe(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, None), (3.0, 30.0), (10.0, 20.0)], "x double, y double")
    got = {r.column_name: r for r in profile.describe(df, ["x", "y"]).collect()}
    values = np.array([1.0, 2.0, 3.0, 10.0])
    assert got["x"].value_count == 4 and got["y"].value_count == 3
    assert got["x"].std_value == pytest.approx(values.std(ddof=1))
    assert [got["x"].q25_value, got["x"].q50_value, got["x"].q75_value] == np.quantile(values, [0.25, 0.5, 0.75]).tolist()


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(1)
    values = rng.uniform(0, 99, 3000).tolist() + [150.0, 300.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    counts, edges = np.histogram([v for v in values if v < 100], bins=50)
    got = {r.bin: r for r in profile.histogram(df, "v", 50, 100.0).collect()}
    assert [got[i].value_count if i in got else 0 for i in range(50)] == counts.tolist()
    assert got[0].bin_start == pytest.approx(edges[0]) and got[49].bin_end == pytest.approx(edges[-1])


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert rows(profile.histogram(df, "v", 50), "bin", "value_count") == [(25, 2)]


def events(spark, points):
    begin = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(k, begin + timedelta(seconds=s), float(v)) for k, s, v in points],
        "PULocationID int, event_timestamp timestamp, total_amount double",
    )


def test_session_boundary(spark):
    df = events(spark, [(1, 0, 1), (1, 300, 1), (1, 601, 1)])
    begin = datetime(2024, 1, 1)
    expected = [
        (begin, begin + timedelta(seconds=600), 1, 2),
        (begin + timedelta(seconds=601), begin + timedelta(seconds=901), 1, 1),
    ]
    count = {"num_trips": F.count(F.lit(1))}
    assert rows(batch_sessions(df, 300, ["PULocationID"])) == expected
    assert rows(sessions(df, "5 minutes", ["PULocationID"], count)) == expected


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 9000)), min_size=1, max_size=80))
def test_batch_windows_equal_the_built_in_ones(spark, points):
    df = events(spark, [(k, s, s % 7) for k, s in points])
    count = {"num_trips": F.count(F.lit(1))}
    keys = ["PULocationID"]
    assert rows(batch_sessions(df, 300, keys)) == rows(sessions(df, "5 minutes", keys, count))
    sums = {"num_trips": F.lit(1), "total": F.col("total_amount")}
    slow = {"num_trips": F.count(F.lit(1)), "total": F.sum("total_amount")}
    assert rows(batch_hop(df, 3600, 900, keys, sums)) == rows(hop(df, "1 hour", "15 minutes", keys, slow))


def test_global_session_spans_keys(spark):
    df = events(spark, [(1, 0, 1), (2, 200, 1), (1, 400, 1), (2, 2000, 1)])
    assert rows(batch_sessions(df, 300, []), "num_trips") == [(1,), (3,)]


def test_batch_hop_needs_whole_steps(spark):
    with pytest.raises(ValueError):
        batch_hop(events(spark, [(1, 0, 1)]), 1000, 300, [], {"n": F.lit(1)})


def test_percentiles_are_narrowed_until_ranges_are_small(spark, monkeypatch):
    """Many groups and shares in one loop; a range of one value that fills half a group can't be cut and needn't be."""
    monkeypatch.setattr(percentiles, "RANGE_ROWS", 3)
    rounds, narrower = [], percentiles._narrower

    def counted(values, keys, shares):
        rounds.append(values.count())
        return narrower(values, keys, shares)

    monkeypatch.setattr(percentiles, "_narrower", counted)
    rng = np.random.default_rng(8)
    data = {"a": rng.normal(0, 9, 6000).tolist(), "b": [5.0] * 900 + rng.uniform(0, 10, 900).tolist(), None: rng.uniform(-1, 1, 2500).tolist(), "one": [1.5]}
    pairs = [(g, float(v)) for g, values in data.items() for v in values]
    check_percentiles(spark.createDataFrame(pairs, "g string, v double").repartition(5), data)
    assert rounds and rounds == sorted(rounds, reverse=True) and rounds[0] < sum(map(len, data.values()))


@pytest.mark.parametrize("rows_at_most", [2, 100_000])
def test_describe_from_the_wide_table(spark, monkeypatch, rows_at_most):
    monkeypatch.setattr(percentiles, "RANGE_ROWS", rows_at_most)
    rng = np.random.default_rng(2)
    n = 5000
    columns = {
        "smooth": rng.normal(0, 1, n), "heavy": np.where(rng.random(n) < 0.6, 7.0, rng.random(n)), "steps": rng.integers(0, 4, n).astype(float),
        "same": np.full(n, 2.5), "holes": np.where(rng.random(n) < 0.9, np.nan, rng.random(n)),
    }
    cells = zip(*[[None if np.isnan(x) else float(x) for x in v] for v in columns.values()])
    df = spark.createDataFrame([(*c, None) for c in cells], ", ".join(f"{c} double" for c in columns) + ", void double").repartition(6)
    got = {r.column_name: r for r in profile.describe(df, df.columns).collect()}
    assert got.keys() == {*columns, "void"}
    for name, values in columns.items():
        kept = values[~np.isnan(values)]
        quartiles = [got[name].q25_value, got[name].q50_value, got[name].q75_value]
        assert quartiles == pytest.approx(np.quantile(kept, [0.25, 0.5, 0.75]).tolist(), rel=1e-12)
        assert (got[name].value_count, got[name].min_value, got[name].max_value) == (kept.size, kept.min(), kept.max())
    assert got["void"].value_count == 0 and got["void"].q50_value is None


def test_bounds_that_miss_are_moved_out(spark):
    df = spark.range(1, 1002).select(F.col("id").cast("double").alias("v"))
    facts = percentiles.column_facts(df, ["v"], {"m": 0.5})
    for bounds in ((600.0, 700.0), (1.0, 2.0), (501.0, 501.0)):
        facts["v"]["bounds"] = [bounds]
        assert percentiles.column_percentiles(df, ["v"], {"m": 0.5}, facts).first().m == 501.0


def test_describe_shuffles_only_values_near_the_ranks(spark):
    df = spark.range(100_000).select(*[(F.hash("id", F.lit(i)) * 1.0).alias(f"c{i}") for i in range(6)])
    facts = percentiles.column_facts(df, df.columns, profile.QUARTILES)
    inside = sum(df.where(F.col(c).between(*map(F.lit, b))).count() for c in df.columns for b in facts[c]["bounds"])
    assert inside < 0.02 * 600_000
    assert profile.describe(df, df.columns).count() == 6


@pytest.mark.parametrize("block", [1, 2, 7, 4096])
def test_sessions_over_blocks(spark, monkeypatch, block):
    """Chains over many blocks, blocks with one session, empty blocks, times before 1970."""
    monkeypatch.setattr(windows, "BLOCK_PANES", block)
    rng = np.random.default_rng(block)
    seconds = np.concatenate([np.arange(0, 9000, 290), 20_000 + np.cumsum(rng.integers(1, 700, 200)), -np.cumsum(rng.integers(1, 900, 60)) - 60 * 86400 * 365 * 9])
    df = events(spark, [(int(k), int(s), 1) for k, s in zip(rng.integers(1, 3, seconds.size), seconds)])
    count = {"num_trips": F.count(F.lit(1))}
    assert rows(batch_sessions(df, 300, ["PULocationID"])) == rows(sessions(df, "5 minutes", ["PULocationID"], count))
    everything = df.withColumn("all", F.lit(1))
    want = rows(sessions(everything, "5 minutes", ["all"], count).drop("all"))
    assert rows(batch_sessions(df, 300, [])) == want


def test_only_block_summaries_meet_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(windows, "BLOCK_PANES", 16)
    df = events(spark, [(1, 600 * i, 1) for i in range(4000)])
    found = batch_sessions(df, 300, [])
    assert found.count() == 4000
    plan = plan_of(found)
    assert "SinglePartition" not in plan
    windows_of = [line for line in plan.splitlines() if line.startswith("Arguments: [") and "windowspecdefinition" in line]
    assert windows_of and all("_block" in line.split("windowspecdefinition(")[1] for line in windows_of)
