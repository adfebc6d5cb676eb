"""Monthly loads with idempotent partitions, one month or a backfill.

    python -m meterline.jobs.monthly_etl --source DIR --target DIR --service yellow --year 2020 [--month 1]
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, Observation, SparkSession

from meterline.functions.timeparts import month_range
from meterline.operators.quality import partition_validation
from meterline.schemas import PICKUP_PREFIX, get_schema
from meterline.session import build_session
from meterline.sinks.tables import append_evolving, reload_partitions
from meterline.sources.files import drop_missing_pickup, read_month_csv, read_monthly

log = logging.getLogger(__name__)


def load_months(
    spark: SparkSession, source: str, target: str, service: str, months: list[tuple[int, int]]
) -> dict[tuple[int, int], int]:
    """Load monthly files and replace exactly their partitions; returns rows per month.

    A backfill is the same call with more months: one Spark job over all files, not a loop.
    Rows carry the month of their file, so a stray pickup stays in the partition of its file.
    """
    seen = Observation()
    trips = drop_missing_pickup(read_month_csv(spark, source, service, months), service, seen)
    counts = reload_partitions(trips, target, months)
    dropped = seen.get["dropped"]
    if dropped:
        log.warning("%s: dropped %s rows without a pickup time", service, dropped)
    log.info("%s: %s rows in %s months", service, sum(counts.values()), len(counts))
    return counts


def validate_month(spark: SparkSession, target: str, service: str, year: int, month: int) -> DataFrame:
    """Rows, time extent and strays of one loaded partition."""
    part = spark.read.parquet(target).where(f"year = {int(year)} AND month = {int(month)}")
    return partition_validation(part, f"{PICKUP_PREFIX[service]}_pickup_datetime", *month_range(year, month))


def backfill(
    spark: SparkSession, source: str, targets: dict[str, str], year: int, months: int = 12
) -> dict[str, dict[tuple[int, int], int]]:
    """Load the first months of a year for several services."""
    wanted = [(year, m) for m in range(1, months + 1)]
    return {service: load_months(spark, source, target, service, wanted) for service, target in targets.items()}


def append_months(spark: SparkSession, source: str, target: str, service: str, months: list[tuple[int, int]] | None = None) -> None:
    """Append the Parquet files of a service, of all months or of some, in its fixed schema, whatever types they have."""
    trips = read_monthly(spark, source, service, months)
    time = f"{PICKUP_PREFIX[service]}_pickup_datetime"
    append_evolving(trips, target, get_schema(service), time, ["PULocationID", "DOLocationID"])


def main() -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--source", required=True)
    parser.add_argument("--target", required=True)
    parser.add_argument("--service", required=True, choices=sorted(PICKUP_PREFIX))
    parser.add_argument("--year", type=int, required=True)
    parser.add_argument("--month", type=int, help="one month; the whole year without it")
    args = parser.parse_args()
    months = [(args.year, args.month)] if args.month else [(args.year, m) for m in range(1, 13)]
    load_months(build_session("monthly_etl"), args.source, args.target, args.service, months)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
