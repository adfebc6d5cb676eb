"""Statistics kept in the catalog, and joins planned by them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import functions as F

from meterline.plans.lanes import lane_revenue
from meterline.queries.base import REGISTRY, query
from meterline.queries.scans import TABLES
from meterline.session import planning_session
from meterline.sinks.tables import drop_table
from meterline.sources import catalog, files


@contextmanager
def cataloged(spark, sf_dir, tables) -> Iterator[dict[str, str]]:
    """Catalog tables over the given files, by a name of this run; they are gone afterwards, the files stay."""
    names = {t: f"{t}_{uuid.uuid4().hex}" for t in tables}
    try:
        for t, name in names.items():
            files.external_table(spark, name, f"{sf_dir}/{t}.parquet")
        yield names
    finally:
        for name in names.values():
            drop_table(spark, name)


@query("catalog_sizes", REGISTRY["table_sizes"].sql)
def catalog_sizes(spark, sf_dir):
    """The sizes of all tables from the catalog, after an analysis."""
    with cataloged(spark, sf_dir, TABLES) as names:
        for name in names.values():
            catalog.analyze(spark, name)
        sizes = catalog.table_statistics(spark, names)
    return sizes.select("table_name", "row_count", "column_count", (F.col("size_bytes") > 0).alias("has_bytes"))


WHOLE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query(
    "catalog_columns",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(MIN({c}) AS BIGINT) AS least, CAST(MAX({c}) AS BIGINT) AS greatest,
        COUNT(*) - COUNT({c}) AS null_count FROM lineitem"""
        for c in WHOLE
    ),
)
def catalog_columns(spark, sf_dir):
    """Extent and nulls of the key columns from the catalog."""
    with cataloged(spark, sf_dir, ["lineitem"]) as names:
        catalog.analyze(spark, names["lineitem"], list(WHOLE))
        stated = catalog.column_statistics(spark, names["lineitem"], list(WHOLE))
    return stated.select(
        "column_name", F.col("min_value").cast("bigint").alias("least"), F.col("max_value").cast("bigint").alias("greatest"), "null_count"
    )


# What the joins and filters of the lanes look at.
LANE_COLUMNS = {
    "lineitem": ["l_orderkey", "l_suppkey"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate"],
    "customer": ["c_custkey", "c_mktsegment"],
    "supplier": ["s_suppkey"],
}


@query(
    "lanes_planned",
    """SELECT CAST(c_nationkey AS BIGINT) AS pickup_zone, CAST(s_nationkey AS BIGINT) AS dropoff_zone, COUNT(*) AS trip_count,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS fare_amount
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-07-01' AND c_mktsegment = 'BUILDING' GROUP BY ALL""",
)
def lanes_planned(spark, sf_dir):
    """Lane revenue, its joins ordered by the statistics of the tables."""
    planning = planning_session(spark)
    with cataloged(planning, sf_dir, LANE_COLUMNS) as names:
        for t, columns in LANE_COLUMNS.items():
            catalog.analyze(planning, names[t], columns)
        trips, bookings, riders, drivers = (planning.table(names[t]) for t in ("lineitem", "orders", "customer", "supplier"))
        lanes = lane_revenue(trips, bookings, riders, drivers, "BUILDING", "1997-01-01", "1997-07-01")
        lanes.schema  # noqa: B018  resolved while the tables are there; the files of external tables stay
    return lanes
