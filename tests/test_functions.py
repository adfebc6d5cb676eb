import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterline.functions.keys import NULL_MARK, surrogate_key
from meterline.functions.labels import month_label, payment_label, rate_label
from meterline.functions.names import lower_columns, normalize_columns, snake_columns, snake_name
from meterline.functions.numbers import nan_to_null, pct_change, rounded, safe_ratio, to_int, to_money
from meterline.functions.timeparts import (
    boundary_minutes,
    elapsed_hours,
    elapsed_minutes,
    month_range,
    on_day,
    parse_stamp,
    seconds_between,
    weekday_from_one,
    weekday_from_zero,
)
from meterline.schemas import GREEN_RAW, INT, TEXT, YELLOW_RAW, get_schema, struct
from meterline.sources import messages


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def stamp(text):
    return F.lit(text).cast("timestamp")


def test_column_names(spark):
    df = spark.createDataFrame([(1, 4, 1.5)], "PULocationID int, DOLocationID int, Trip_Distance double")
    assert lower_columns(df).columns == ["pulocationid", "dolocationid", "trip_distance"]
    spaced = spark.createDataFrame([(1, 3)], ["Column Name", "Another Col"])
    assert normalize_columns(spaced).columns == ["column_name", "another_col"]
    camel = spark.createDataFrame([(1, 2)], ["Trip_Pickup_DateTime", "Tip_Amt"])
    assert snake_columns(camel).columns == ["trip_pickup_date_time", "tip_amt"]


def test_clashing_names_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], ["A b", "a_b"])
    with pytest.raises(ValueError, match="clash"):
        normalize_columns(df)


@pytest.mark.parametrize(
    "name, expected",
    [("PULocationID", "pu_location_id"), ("firstPublishYear", "first_publish_year"), ("vendor id", "vendor_id"), ("a__b", "a_b")],
)
def test_snake_name(name, expected):
    assert snake_name(name) == expected


def test_to_int_rounds_half_even(spark):
    values = [F.lit(v) for v in (1.5, 2.5, 0.5, -1.5, 2.4)]
    assert one(spark, *[to_int(v) for v in values]) == (2, 2, 0, -2, 2)
    assert one(spark, to_int(F.lit(None).cast("double"))) == (None,)


def test_rounded(spark):
    values = [2.675, 1.005, -0.125, 0.125, 1e17, 0.0, 0.0049999999999999994, -0.005]
    got = one(spark, *[rounded(F.lit(v), 2) for v in values])

    def half_away(x):
        y = x * 100
        whole = math.floor(abs(y)) + (abs(y) - math.floor(abs(y)) >= 0.5)
        return x if abs(y) >= 2**52 else math.copysign(whole, y) / 100

    assert got == tuple(half_away(v) for v in values)
    assert math.isnan(one(spark, rounded(F.lit(float("nan")), 2))[0])
    assert one(spark, rounded(F.lit(None).cast("double"), 2)) == (None,)


def test_money_ties_go_away_from_zero(spark):
    values = (0.0005, 0.0025, 1.0005, 10.0625, -0.0005, -10.0625, 0.00049999)
    got = [str(v) for v in one(spark, *[to_money(F.lit(v)) for v in values])]
    assert got == ["0.001", "0.003", "1.001", "10.063", "-0.001", "-10.063", "0.000"]


def test_a_bad_field_is_null_and_its_record_stays(spark):
    lines = ['{"a":1,"b":"x"}', '{"a":"abc","b":"y"}', '{"a":2', '{"a":NaN,"b":"z"}', "[1]", "7", "", None, ' {"b":null}']
    got = messages.decode(spark.createDataFrame([(x,) for x in lines], "value string"), struct(a=INT, b=TEXT)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "x"), (None, "y"), (None, None)], key=str)


def test_to_money(spark):
    got = one(spark, *[to_money(F.lit(v)) for v in (12.345, -0.1, 0.0, 99999.999)])
    assert [str(v) for v in got] == ["12.345", "-0.100", "0.000", "99999.999"]
    assert spark.range(1).select(to_money(F.lit(1.0)).alias("m")).dtypes == [("m", "decimal(18,3)")]


def test_guarded_ratios(spark):
    assert one(spark, safe_ratio(F.lit(1.0), F.lit(0.0)), safe_ratio(F.lit(1.0), F.lit(3.0), 2)) == (None, 0.33)
    assert one(spark, pct_change(F.lit(150), F.lit(100)), pct_change(F.lit(1), F.lit(0))) == (50.0, None)


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c")], "x double, s string")
    assert [r.x for r in nan_to_null(df).collect()] == [1.0, None, None]


def test_minutes_differ_by_meaning(spark):
    a, b = stamp("2024-01-01 10:00:59"), stamp("2024-01-01 10:01:01")
    assert one(spark, boundary_minutes(a, b), elapsed_minutes(a, b), seconds_between(a, b)) == (1, 0, 2.0)
    assert one(spark, boundary_minutes(b, a), elapsed_minutes(b, a)) == (-1, 0)
    assert one(spark, elapsed_hours(a, stamp("2024-01-01 11:30:59"))) == (1.5,)


def test_fractional_seconds(spark):
    assert one(spark, seconds_between(stamp("2024-01-01 00:00:00"), stamp("2024-01-01 00:00:01.25"))) == (1.25,)


def test_weekdays(spark):
    sunday = stamp("2024-01-07 12:00:00")
    assert one(spark, weekday_from_zero(sunday), weekday_from_one(sunday)) == (0, 1)


def test_month_range():
    assert month_range(2020, 12) == ("2020-12-01", "2021-01-01")
    assert month_range(2021, 3) == ("2021-03-01", "2021-04-01")


def test_on_day_includes_the_whole_day(spark):
    day = "2025-11-15"
    inside = one(spark, on_day(stamp("2025-11-15 00:00:00"), day), on_day(stamp("2025-11-15 23:59:59.999"), day))
    assert inside == (True, True)
    assert one(spark, on_day(stamp("2025-11-16 00:00:00"), day)) == (False,)


def test_parse_stamp(spark):
    assert one(spark, parse_stamp(F.lit("2025-10-01 00:05:00")), parse_stamp(F.lit("soon"))) == (
        datetime(2025, 10, 1, 0, 5),
        None,
    )


def test_labels(spark):
    assert one(spark, payment_label(F.lit(1)), payment_label(F.lit(6)), payment_label(F.lit(9))) == (
        "Credit card",
        "Voided trip",
        "Unknown",
    )
    assert one(spark, rate_label(F.lit(2)), rate_label(F.lit(None).cast("int"))) == ("JFK", "Unknown")
    assert one(spark, month_label(F.lit(1)), month_label(F.lit(12))) == ("January", "December")


def test_surrogate_key(spark):
    import hashlib

    got = one(spark, surrogate_key(F.lit(1), F.lit(None).cast("string"), F.lit("x")))[0]
    assert got == hashlib.md5(f"1-{NULL_MARK}-x".encode()).hexdigest()


def test_schemas():
    assert (len(GREEN_RAW.fields), len(YELLOW_RAW.fields)) == (20, 18)
    assert get_schema(" Green ") is GREEN_RAW
    assert all(f.nullable for f in GREEN_RAW.fields)
    with pytest.raises(ValueError):
        get_schema("blue")
