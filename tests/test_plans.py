"""The plans the library promises: pruned scans, pushed filters, no cross joins, no forced broadcasts."""

import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from meterline.queries import REGISTRY
from meterline.sinks.tables import time_slice, write_clustered
from meterline.sources.sample import raw_trips

SF = "/root/testdata/sf0.001"


def test_scan_reads_only_what_is_asked(spark):
    plan = plan_of(REGISTRY["scan_pruned"].run(spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    assert "orders" not in plan_of(raw_trips(spark, SF, None, ["VendorID", "trip_distance"]))


def test_filters_reach_the_scan(spark):
    plan = plan_of(REGISTRY["long_trips"].run(spark, SF))
    assert "GreaterThan(l_quantity,5.0)" in plan
    assert "EqualTo(l_linestatus,F)" in plan_of(raw_trips(spark, SF, "green", ["VendorID"]))


def test_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(200).select(F.timestamp_seconds(F.col("id") * 86400).alias("t"), (F.col("id") % 2).alias("v"))
    write_clustered(df.withColumn("d", F.to_date("t")), path, ["d"], ["v"], bloom_on=["v"])
    chosen = time_slice(spark.read.parquet(path), "t", "1970-03-01", "1970-03-15 23:59:59", "d")
    assert chosen.count() == 15
    plan = plan_of(chosen)
    assert "PartitionFilters: [isnotnull(d" in plan
    assert "PushedFilters: [IsNotNull(t)" in plan


def test_closed_range_misses_the_sub_second_tail(spark):
    df = spark.createDataFrame([("2024-03-15 23:59:59",), ("2024-03-15 23:59:59.5",)], "t string")
    stamped = df.select(F.col("t").cast("timestamp").alias("t"))
    assert time_slice(stamped, "t", "2024-03-01", "2024-03-15 23:59:59").count() == 1


@pytest.mark.parametrize("name", ["revenue_growth", "monthly_zone_revenue", "fare_percentiles", "dq_relationships", "anomaly_rate"])
def test_no_cross_join(spark, name):
    plan = plan_of(REGISTRY[name].run(spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_zone_lookup_meets_grouped_rows(spark):
    """The zone join sits above the aggregation, the trip joins below it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = REGISTRY["monthly_zone_revenue"].run(spark, SF)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = tree.splitlines()
    joins = [i for i, line in enumerate(lines) if "MergeJoin" in line]
    aggregates = [i for i, line in enumerate(lines) if "HashAggregate" in line]
    assert "pickup_location_id" in lines[joins[0]] and joins[0] < min(aggregates)
    assert "o_custkey" in lines[joins[-1]] or "o_orderkey" in "".join(lines[i] for i in joins if i > max(aggregates))
