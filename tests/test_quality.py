from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import rows
from meterline.jobs.quality_run import monthly_suite
from meterline.operators import quality as dq

TRIPS = [
    (1, "2025-11-01 10:00:00", "2025-11-01 10:15:00", 1, 2.5, 74, 42, 15.50),
    (2, "2025-11-01 11:00:00", "2025-11-01 11:20:00", 2, 5.0, 123, 56, 25.00),
    (1, "2025-11-01 12:00:00", "2025-11-01 12:30:00", 1, 1.0, 88, 99, 10.00),
]
COLUMNS = (
    "vendorid int, lpep_pickup_datetime string, lpep_dropoff_datetime string, passenger_count int, "
    "trip_distance double, PULocationID int, DOLocationID int, total_amount double"
)


@pytest.fixture
def trips(spark):
    return spark.createDataFrame(TRIPS, COLUMNS)


@pytest.mark.parametrize(
    "name, verdicts",
    [
        ("gt", (True, False, False)),
        ("lt", (False, True, False)),
        ("eq", (False, False, True)),
        ("gte", (True, False, True)),
        ("lte", (False, True, True)),
    ],
)
def test_comparisons(name, verdicts):
    assert tuple(dq.compare(v, 100, name) for v in (150, 50, 100)) == verdicts


def test_arguments_are_validated():
    with pytest.raises(ValueError):
        dq.Check("n", "null_check")
    with pytest.raises(ValueError):
        dq.Check("r", "range_check")
    with pytest.raises(ValueError):
        dq.Check("c", "custom")
    with pytest.raises(ValueError):
        dq.Check("x", "something")
    with pytest.raises(ValueError):
        dq.Check("x", "row_count", comparison="near")


@pytest.mark.parametrize("count, passed", [(1000, True), (50, False)])
def test_row_count(spark, count, passed):
    report = dq.run_checks(spark.range(count), [dq.Check("rows", "row_count", threshold=100)])
    assert rows(report, "value", "passed") == [(float(count), passed)]


def test_null_and_range_checks(spark):
    df = spark.createDataFrame([(1, 5.0), (None, 250.0), (3, -1.0)], "a int, b double")
    report = dq.run_checks(
        df,
        [
            dq.Check("a", "null_check", column="a"),
            dq.Check("b", "null_check", column="b"),
            dq.Check("max", "range_check", column="b", threshold=200, comparison="lte"),
            dq.Check("max_where", "range_check", column="b", threshold=200, comparison="lte", where="a IS NOT NULL"),
            dq.Check("zero", "range_check", column="b", threshold=0, comparison="lte"),
            dq.Check("min", "range_check", column="b", minimum=0),
            dq.Check("free", "range_check", column="b"),
        ],
    )
    assert {r.check_name: r.passed for r in report.collect()} == {
        "a": False,
        "b": True,
        "max": False,
        "max_where": True,
        "zero": False,
        "min": False,
        "free": True,
    }


def test_custom_checks(spark):
    df = spark.range(10)
    report = dq.run_checks(
        df,
        [
            dq.Check("flag", "custom", expression="max(id) < 10", is_boolean=True),
            dq.Check("number", "custom", expression="sum(id)", threshold=45, comparison="eq"),
            dq.Check("ratio", "custom", expression=dq.bad_ratio("id < 1"), threshold=0.05, comparison="lt"),
        ],
    )
    assert {r.check_name: r.passed for r in report.collect()} == {"flag": True, "number": True, "ratio": False}


def test_ratio_of_an_empty_table_fails(spark):
    report = dq.run_checks(
        spark.range(0), [dq.Check("r", "custom", expression=dq.bad_ratio("id < 1"), threshold=0.5, comparison="lt")]
    )
    assert rows(report, "value", "passed") == [(None, False)]


def test_gate(spark, trips):
    suite = monthly_suite("lpep_pickup_datetime", "lpep_dropoff_datetime")
    assert len(suite) == 7
    assert len(dq.gate(dq.run_checks(trips, suite))) == 7
    bad = trips.withColumn("total_amount", F.lit(-1.0))
    with pytest.raises(dq.QualityError, match="fare_amounts"):
        dq.gate(dq.run_checks(bad, suite))
    warned = dq.run_checks(bad, [dq.Check("w", "range_check", column="total_amount", minimum=0, severity="warn")])
    assert not dq.gate(warned)[0]["passed"]


def test_rules(spark):
    df = spark.createDataFrame(
        [(1, "Green", 5.0, 1), (2, "Blue", -200.0, 0), (None, None, None, 1)], "v int, s string, g double, n int"
    )
    report = dq.run_rules(
        df,
        [
            dq.not_null("v"),
            dq.accepted_values("s", ["Green", "Yellow"]),
            dq.accepted_values("v", [1, 2]),
            dq.expression_is_true("g", ">= -100", severity="warn"),
            dq.expression_is_true("g", "> 0", where="n > 0"),
        ],
    )
    assert [r.failures for r in report.collect()] == [1, 1, 0, 1, 0]
    with pytest.raises(dq.QualityError, match="not_null"):
        dq.rule_gate(report)


def test_unique_and_relationships(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    zones = spark.createDataFrame([(1,), (2,)], "location_id int")
    assert rows(dq.unique(df, "k"), "failures", "passed") == [(1, False)]
    assert rows(dq.unique(zones, "location_id"), "failures", "passed") == [(0, True)]
    assert rows(dq.relationships(df, "k", zones, "location_id"), "failures") == [(1,)]


@pytest.mark.parametrize(
    "as_of, status",
    [(datetime(2025, 11, 2, 9), "pass"), (datetime(2025, 11, 2, 13), "warn"), (datetime(2025, 11, 4), "error")],
)
def test_freshness(trips, as_of, status):
    df = trips.withColumn("t", F.col("lpep_pickup_datetime").cast("timestamp"))
    assert dq.freshness(df, "t", as_of).first().status == status


def test_freshness_of_nothing(trips):
    df = trips.withColumn("t", F.col("lpep_pickup_datetime").cast("timestamp")).limit(0)
    assert dq.freshness(df, "t", datetime(2025, 11, 2)).first().status == "error"


def test_valid_split(spark):
    distances = spark.createDataFrame([(1.5,), (-1.0,), (150.0,), (5.0,)], "d double")
    assert rows(dq.split_valid(distances, "d >= 0 AND d < 100").groupBy("is_valid").count()) == [(False, 2), (True, 2)]
    amounts = spark.createDataFrame([(15.50,), (-5.00,), (500.00,), (25.00,), (None,)], "a double")
    assert dq.split_valid(amounts, "a > 0 AND a < 500").where("is_valid").count() == 2


def test_row_rules_of_the_sample(trips):
    broken = trips.selectExpr(
        "count_if(total_amount <= 0)",
        "count_if(NOT trip_distance BETWEEN 0 AND 100)",
        "count_if(NOT passenger_count BETWEEN 1 AND 6)",
        "count_if(lpep_dropoff_datetime <= lpep_pickup_datetime)",
        "count_if(PULocationID < 1 OR DOLocationID < 1)",
    )
    assert tuple(broken.first()) == (0, 0, 0, 0, 0)


def test_partition_validation(trips):
    df = trips.withColumn("t", F.col("lpep_pickup_datetime").cast("timestamp"))
    row = dq.partition_validation(df, "t", "2025-11-01 11:00:00", "2025-12-01").first()
    assert (row.row_count, row.earliest_pickup, row.stray_rows) == (3, datetime(2025, 11, 1, 10), 1)


def test_reconcile(spark):
    source = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    target = spark.createDataFrame([("a",), ("c",)], "k string")
    assert rows(dq.reconcile(source, target, ["k"])) == [
        ("a", 2, 1, False, 50.0),
        ("b", 1, 0, False, 100.0),
        ("c", 0, 1, False, None),
    ]
