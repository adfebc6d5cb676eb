from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import rows
from meterline.jobs.build_layers import MODELS, Context, build, run_tests, selection
from meterline.operators.quality import QualityError
from meterline.plans import analytics, marts, platform, staging
from meterline.schemas import FHV_RAW, GREEN_RAW, YELLOW_RAW, ZONES
from meterline.sources.files import conform

ZONE_ROWS = [
    (56, "Queens", "Corona", "Boro Zone"),
    (57, "Queens", "Corona", "Boro Zone"),
    (74, "Manhattan", "East Harlem North", "Boro Zone"),
    (264, "Unknown", None, None),
]


def raw(spark, prefix, schema, *entries):
    """Rows of (pickup, dropoff, location, distance, fare, total, passengers)."""
    names = "pickup string, dropoff string, loc int, dist double, fare double, total double, pax double"
    df = spark.createDataFrame(list(entries), names)
    given = df.select(
        F.lit(1).alias("VendorID"),
        F.col("pickup").cast("timestamp").alias(f"{prefix}_pickup_datetime"),
        F.col("dropoff").cast("timestamp").alias(f"{prefix}_dropoff_datetime"),
        F.lit(1).alias("RatecodeID"),
        F.col("loc").alias("PULocationID"),
        F.lit(74).alias("DOLocationID"),
        F.col("pax").alias("passenger_count"),
        F.col("dist").alias("trip_distance"),
        F.col("fare").alias("fare_amount"),
        F.col("total").alias("total_amount"),
        F.lit(1).alias("payment_type"),
    )
    return conform(given, schema)


def trip(day, loc=74, total=10.0, dist=1.0, fare=8.0, pax=1.0, dropoff=None):
    return (f"{day} 10:00:00", dropoff or f"{day} 10:20:00", loc, dist, fare, total, pax)


GREEN = [
    trip("2019-12-05", total=100.0),
    trip("2020-01-05", total=150.0),
    trip("2020-01-06", 56, 30.0),
    trip("2020-01-07", 57, 70.0),
    trip("2020-03-07", 56, 50.0),
    trip("2020-01-08", 264, 5.0),
    trip("2020-01-08", 999, 5.0),
    trip("2020-01-09", dist=0.0),
    trip("2020-01-09", fare=0.0),
    trip("2020-01-09", dropoff="2020-01-09 10:00:00"),
    (None, "2020-01-09 10:00:00", 74, 1.0, 1.0, 1.0, 1.0),
]


@pytest.fixture
def green(spark):
    return raw(spark, "lpep", GREEN_RAW, *GREEN)


@pytest.fixture
def zones(spark):
    return marts.dim_zones(spark.createDataFrame(ZONE_ROWS, ZONES))


def test_staging(spark, green):
    staged = staging.stage_green(green)
    assert len(staged.columns) == 19
    assert staged.count() == len(GREEN) - 1
    assert dict(staged.dtypes)["total_amount"] == "decimal(18,3)"
    yellow = staging.stage_yellow(raw(spark, "tpep", YELLOW_RAW, trip("2020-01-01", pax=2.5)))
    assert yellow.columns == staged.columns
    assert rows(yellow, "passenger_count", "service_type") == [(2, "Yellow")]
    assert marts.union_trips(staged, yellow).count() == len(GREEN)


def test_staging_some_columns(green):
    staged = staging.stage_trips(green, "lpep", "Green", ["total_amount"])
    assert staged.columns == ["total_amount", "service_type"]


def test_fhv(spark):
    df = spark.createDataFrame(
        [("B1", datetime(2019, 1, 1), None, 1, 2, 1), (None, datetime(2019, 1, 1), None, 1, 2, None), ("B2", None, None, 1, 2, None)],
        FHV_RAW,
    )
    assert staging.stage_fhv(df).count() == 2
    assert staging.stage_fhv(df, require_base_num=True).count() == 1


def test_flags(spark):
    entries = [
        trip("2024-01-07"),
        trip("2024-01-07", dist=0.0),
        trip("2024-01-07", fare=None),
        ("2024-01-07 10:00:59", "2024-01-07 10:01:01", 74, 1.0, 1.0, 1.0, None),
    ]
    fct = marts.fct_trips(staging.stage_green(raw(spark, "lpep", GREEN_RAW, *entries)))
    assert len(fct.columns) == 27
    got = fct.orderBy("trip_duration_seconds", "trip_distance", "fare_amount").collect()
    assert [(r.trip_duration_minutes, r.is_invalid_trip) for r in got] == [(1, False), (20, True), (20, False), (20, False)]
    assert (got[0].pickup_dayofweek, got[0].pickup_hour, got[0].pickup_year) == (0, 10, 2024)


def test_keyed_staging(spark):
    entries = [
        trip("2024-01-07"),
        trip("2024-01-07", pax=0.5),
        trip("2024-01-07", pax=None),
        trip("2024-01-07", total=0.0),
        trip("2024-01-07", dist=0.0),
        ("2024-01-07 10:00:59", "2024-01-07 10:01:01", 74, 1.0, 1.0, 1.0, 1.0),
    ]
    keyed = staging.stage_keyed_trips(raw(spark, "lpep", GREEN_RAW, *entries))
    assert len(keyed.columns) == 17
    assert rows(keyed, "passenger_count", "trip_duration_minutes", "is_suspicious") == [
        (0, 20, True),
        (1, 0, False),
        (1, 20, False),
        (1, 20, True),
        (None, 20, False),
    ]
    fact = platform.fact_trips(keyed)
    assert rows(fact.where("trip_duration_minutes = 0"), "avg_speed_mph", "revenue_per_mile") == [(None, 1.0)]
    assert "created_at" in platform.fact_trips(keyed, stamped=True).columns


def test_zone_revenue_keeps_unknown_locations(green, zones):
    revenue = marts.monthly_zone_revenue(marts.fct_trips(staging.stage_green(green)), zones)
    january = revenue.where("pickup_month = 1")
    assert rows(january, "pickup_location_id", "pickup_zone", "total_monthly_trips", "revenue_monthly_total_amount") == [
        (264, None, 1, 5),
        (56, "Corona", 1, 30),
        (57, "Corona", 1, 70),
        (74, "East Harlem North", 1, 150),
        (999, None, 1, 5),
    ]


def test_growth_merges_zones_of_one_name(green, zones):
    growth = analytics.revenue_growth(marts.fct_trips(staging.stage_green(green)), zones)
    got = rows(growth, "pickup_zone", "year", "month_number", "revenue", "prev_month_revenue", "mom_growth_pct", "mom_trip_growth_pct")
    # February has no trips in Corona: March is compared with January.
    assert got == [
        ("Corona", 2020, 1, 100, None, None, None),
        ("Corona", 2020, 3, 50, 100, -50.0, -50.0),
        ("East Harlem North", 2019, 12, 100, None, None, None),
        ("East Harlem North", 2020, 1, 150, 100, 50.0, 0.0),
    ]
    assert rows(analytics.growth_extremes(growth, 2020, 1), "pickup_zone", "mom_growth_pct") == [("East Harlem North", 50.0)]
    assert rows(analytics.yoy_growth(growth, 2019, 2020, 50), "pickup_zone", "yoy_growth") == [("East Harlem North", 50.0)]
    assert analytics.declining_zones(growth, 0).count() == 1


def test_kpis_compare_with_the_previous_row(spark):
    entries = [trip("2020-01-05", total=100.0), trip("2020-01-06", 56, 50.0), trip("2020-03-05", total=300.0)]
    fact = platform.fact_trips(staging.stage_keyed_trips(raw(spark, "lpep", GREEN_RAW, *entries)))
    got = rows(
        platform.monthly_kpis(fact),
        "pickup_month",
        "total_trips",
        "unique_pickup_locations",
        "total_revenue",
        "avg_revenue_per_trip",
        "prev_month_revenue",
        "revenue_growth_pct",
    )
    assert got == [(1, 2, 2, 150, 75.0, None, None), (3, 1, 1, 300, 300.0, 150, 100.0)]


def test_payment_window_and_environment(green, monkeypatch):
    fct = marts.fct_trips(staging.stage_green(green))
    assert rows(analytics.payment_analysis(fct, "2020-03-08", 30), "payment_method", "trip_count") == [("Credit card", 1)]
    monkeypatch.setenv("DAYS_BACK", "90")
    assert analytics.payment_analysis(fct, "2020-03-08").agg(F.sum("trip_count")).first()[0] == 9
    assert (analytics.days_back(5), analytics.days_back()) == (5, 90)


def context(spark, green, target):
    frames = {
        "green": green,
        "yellow": raw(spark, "tpep", YELLOW_RAW, trip("2020-01-02"), trip("2020-02-02")),
        "zones": spark.createDataFrame([z for z in ZONE_ROWS if z[2]], ZONES),
        "fhv": spark.createDataFrame([("B1", datetime(2019, 1, 1), None, 1, 2, 1)], FHV_RAW),
    }
    return Context(spark, frames.__getitem__, target, days_back=3650, as_of="2020-04-01")


def test_build_all_layers(spark, tmp_path):
    clean = raw(spark, "lpep", GREEN_RAW, *[t for t in GREEN if t[2] not in (264, 999) and t[0]])
    ctx = context(spark, clean, str(tmp_path))
    assert build(ctx) == list(MODELS)
    assert spark.read.parquet(f"{tmp_path}/fct_trips").count() == 10
    assert spark.read.parquet(f"{tmp_path}/monthly_kpis").count() == 3
    assert spark.table("trips_unioned").count() == 10


def test_build_stops_at_a_failing_test(spark, green, tmp_path):
    ctx = context(spark, green, str(tmp_path))
    with pytest.raises(QualityError, match="relationships"):
        build(ctx, ["revenue_growth"], upstream=True)
    assert not (tmp_path / "revenue_growth").exists()
    report = run_tests(ctx, "fct_trips")
    assert report.where("test = 'relationships' AND failures = 2").count() == 1


def test_selection():
    assert selection(["trips_unioned"]) == ["trips_unioned"]
    assert selection(["trips_unioned"], upstream=True) == ["stg_green", "stg_yellow", "trips_unioned"]
    assert selection() == list(MODELS)
    with pytest.raises(ValueError):
        selection(["nope"])
