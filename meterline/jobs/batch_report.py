"""The batch analysis of one month of trips: file sizes, a day's trips, longest trip, rare zones.

    python -m meterline.jobs.batch_report --trips FILE --zones FILE --out DIR --day 2025-11-15
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from meterline.plans import reports
from meterline.plans.marts import dim_zones
from meterline.session import build_session
from meterline.sinks.tables import write_files
from meterline.sources.catalog import file_stats
from meterline.sources.files import read_csv

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"


def batch_report(
    spark: SparkSession, trips: DataFrame, zones: DataFrame, out: str, day: str, files: int = 4
) -> dict[str, DataFrame]:
    """Write the trips as evenly sized files, then answer the questions from those files."""
    write_files(trips, out, files)
    stored = spark.read.parquet(out)
    return {
        "files": file_stats(stored),
        "trips_on_day": reports.trips_on_day(stored, PICKUP, day),
        "longest_trip": reports.longest_duration(stored, PICKUP, DROPOFF),
        "rare_zones": reports.rare_pickup_zones(stored, zones),
    }


def main() -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--trips", required=True)
    parser.add_argument("--zones", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--day", required=True)
    parser.add_argument("--files", type=int, default=4, help="number of files to write, and of tasks that write them")
    args = parser.parse_args()
    spark = build_session("batch_report")
    answers = batch_report(
        spark, spark.read.parquet(args.trips), dim_zones(read_csv(spark, args.zones)), args.out, args.day, args.files
    )
    print(f"Spark {spark.version}")
    for name, df in answers.items():
        print(name)
        df.show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
