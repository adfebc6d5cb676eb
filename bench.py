"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   folder of the tables   (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores            (default 8)
    BENCH_REPEATS  runs per query, the best counts (default 2)

Every query is drained into a no-op sink, so all of its rows are computed and none is collected.
``build_layers`` is the whole model build, written to tables. ``against_baseline``
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterline.jobs.build_layers import Context, build
from meterline.queries import REGISTRY
from meterline.session import build_session, pin_settings, run_dir
from meterline.sources.sample import raw_fhv, raw_trips, raw_zones

HEADLINE = [
    "count_all",
    "top_zone_revenue",
    "distinct_counts",
    "distinct_between",
    "project_columns",
    "longest_duration",
    "rare_pickup_zones",
    "max_tip_by_dropoff",
    "trips_unioned",
    "fct_trips",
    "monthly_zone_revenue",
    "revenue_growth",
    "fare_percentiles",
    "payment_analysis",
    "revenue_volatility",
    "yoy_growth",
    "seasonality",
    "answers_union",
    "stg_trips_keyed",
    "monthly_kpis",
    "describe_numeric",
    "missing_profile",
    "duplicate_count",
    "histogram",
    "dq_report",
    "dq_expression",
    "dq_relationships",
    "build_layers",
    "partition_reload",
    "ctas_partitioned",
    "scan_csv_gz",
    "paged_scan",
    "replay_to_json",
    "session_global",
    "hop_1h_15m",
    "tumble_1h_revenue",
    "session_per_key",
]


PUBLISHED = {
    "partition_reload": 26_382_550 / 9_000,
    "build_layers": 117_000_000 / 120,
    "replay_to_json": 49_416 / 7,
}


def build_layers(spark, sf_dir: str) -> None:
    """Build every model from the sample tables."""
    raw = {
        "green": lambda: raw_trips(spark, sf_dir, "green"),
        "yellow": lambda: raw_trips(spark, sf_dir, "yellow"),
        "fhv": lambda: raw_fhv(spark, sf_dir),
        "zones": lambda: raw_zones(spark, sf_dir),
    }
    # The sample's payment code 7 is meant to fail its test: all tests run, failures are logged.
    build(Context(pin_settings(spark), lambda name: raw[name](), run_dir(spark, "layers"), 30, "2001-08-01"), stop=False)


def run_once(spark, name: str, sf_dir: str) -> float:
    begun = time.perf_counter()
    if name == "build_layers":
        build_layers(spark, sf_dir)
    else:
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    handled = {"partition_reload": rows // 2, "build_layers": rows, "replay_to_json": events}
    seconds: dict[str, float] = {}
    for name in names:
        seconds[name] = round(min(run_once(spark, name, sf_dir) for _ in range(repeats)), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "trip_rows": rows,
                "against_baseline": {
                    n: {"rows_per_sec": round(handled[n] / seconds[n]), "published": round(PUBLISHED[n])}
                    for n in PUBLISHED
                    if n in seconds
                },
            }
        )
    )


if __name__ == "__main__":
    main()
