"""Statistics kept in the catalog, and what the planner makes of them."""

import uuid

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from meterline.plans.lanes import lane_revenue
from meterline.queries.statistics import LANE_COLUMNS, cataloged, lanes_planned
from meterline.session import planning_session
from meterline.sinks.tables import drop_table
from meterline.sources import catalog, files

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"  # the planner keeps the written order of the smaller tables


def relations(df) -> list[str]:
    """The tables of the optimized plan from the first joined to the last."""
    tree = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    found = [(line.index("Relation"), line.split("spark_catalog.default.")[1].split("_")[0]) for line in tree if "Relation spark" in line]
    return [name for _, name in sorted(found, key=lambda f: -f[0])]


def lanes(session, names):
    frames = (session.table(names[t]) for t in ("lineitem", "orders", "customer", "supplier"))
    return lane_revenue(*frames, "BUILDING", "1997-01-01", "1997-07-01")


def test_statistics_change_the_join_order(spark):
    planning = planning_session(spark)
    with cataloged(planning, LARGER, LANE_COLUMNS) as names:
        written = lanes(planning, names)
        assert relations(written)[:2] == ["lineitem", "supplier"]
        before = rows(written)
        for t, columns in LANE_COLUMNS.items():
            catalog.analyze(planning, names[t], columns)
        planned = lanes(planning, names)
        assert set(relations(planned)[:2]) == {"orders", "customer"}
        assert rows(planned) == before and before


def test_planned_joins_have_no_cross_join_and_leave_the_session_alone(spark):
    plan = plan_of(lanes_planned(spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert spark.conf.get("spark.sql.cbo.enabled") == "false"
    assert not [t for t in catalog.list_tables(spark) if t.startswith("lineitem_")]


def test_figures_agree_with_the_files(spark):
    with cataloged(spark, SF, ["orders", "supplier", "region"]) as names:
        unknown = rows(catalog.table_statistics(spark, names), "row_count")
        assert unknown == [(None,)] * 3
        for name in names.values():
            catalog.analyze(spark, name)
        stated = rows(catalog.table_statistics(spark, names), "table_name", "row_count", "column_count", "size_bytes")
    sizes = catalog.table_sizes({t: spark.read.parquet(f"{SF}/{t}.parquet") for t in names})
    assert stated == rows(sizes, "table_name", "row_count", "column_count", "size_bytes")


def test_column_figures(spark):
    with cataloged(spark, SF, ["lineitem"]) as names:
        name = names["lineitem"]
        assert rows(catalog.column_statistics(spark, name, ["l_partkey"])) == [("l_partkey", None, None, None, None)]
        catalog.analyze(spark, name, [])
        stated = {r.column_name: r for r in catalog.column_statistics(spark, name, ["l_partkey", "l_returnflag", "l_quantity"]).collect()}
        facts = spark.table(name).agg(
            F.min("l_partkey"), F.max("l_partkey"), F.count_distinct("l_partkey"), F.count_distinct("l_returnflag"), F.max("l_quantity")
        ).first()
    assert (int(stated["l_partkey"].min_value), int(stated["l_partkey"].max_value)) == (facts[0], facts[1])
    assert stated["l_partkey"].distinct_count == pytest.approx(facts[2], rel=0.1)
    assert stated["l_returnflag"].distinct_count == facts[3] and stated["l_returnflag"].min_value is None
    assert float(stated["l_quantity"].max_value) == facts[4]
    assert {r.null_count for r in stated.values()} == {0}


def test_nulls_odd_names_and_empty_tables(spark, tmp_path):
    given = {
        "some": spark.createDataFrame([(1, None), (None, "x"), (None, "y")], "`a b` int, c string"),
        "none": spark.createDataFrame([], "`a b` int, c string"),
    }
    names = {}
    for label, df in given.items():
        df.write.parquet(str(tmp_path / label))
        names[label] = f"{label}_{uuid.uuid4().hex}"
        files.external_table(spark, names[label], str(tmp_path / label))
        catalog.analyze(spark, names[label], ["a b", "c"])
    counts = rows(catalog.table_statistics(spark, names), "table_name", "row_count")
    assert counts == [("none", 0), ("some", 3)]
    assert rows(catalog.column_statistics(spark, names["some"], ["a b", "c"]), "column_name", "min_value", "null_count") == [("a b", "1", 2), ("c", None, 1)]
    assert rows(catalog.column_statistics(spark, names["none"], ["a b"]), "min_value", "null_count") == [(None, 0)]
    for name in names.values():
        drop_table(spark, name)
