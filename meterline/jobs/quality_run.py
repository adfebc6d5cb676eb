"""Run the monthly quality suite on one partition and fail when a check fails.

    python -m meterline.jobs.quality_run --table DIR --service green --year 2020 --month 1
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from meterline.operators.quality import Check, bad_ratio, gate, run_checks
from meterline.schemas import PICKUP_PREFIX
from meterline.session import build_session
from meterline.sources.files import month_slice

log = logging.getLogger(__name__)

# Name of the ratio check: (what counts as bad, share that must not be reached).
RATIO_RULES = {
    "passenger_count": ("passenger_count < 1", 0.01),
    "fare_amounts": ("total_amount <= 0 OR total_amount > 1000", 0.01),
    "location_ids": ("PULocationID IS NULL OR DOLocationID IS NULL", 0.05),
}


def monthly_suite(pickup: str, dropoff: str) -> list[Check]:
    """The seven checks of the monthly run."""
    return [
        Check("data_freshness", "row_count", threshold=0, comparison="gt"),
        Check("pickup_not_null", "null_check", column=pickup),
        Check("dropoff_not_null", "null_check", column=dropoff),
        Check("trip_distances", "range_check", column="trip_distance", threshold=200, comparison="lte"),
        *[
            Check(name, "custom", expression=bad_ratio(bad), threshold=limit, comparison="lt")
            for name, (bad, limit) in RATIO_RULES.items()
        ],
    ]


def run(spark: SparkSession, table: str, service: str, year: int, month: int) -> list:
    """Report rows of the month; raises when a check failed."""
    prefix = PICKUP_PREFIX[service]
    pickup = f"{prefix}_pickup_datetime"
    trips = month_slice(spark.read.parquet(table), pickup, year, month)
    rows = gate(run_checks(trips, monthly_suite(pickup, f"{prefix}_dropoff_datetime")))
    for row in rows:
        log.info("%s: %s", row["check_name"], row["value"])
    return rows


def main() -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--table", required=True)
    parser.add_argument("--service", required=True, choices=sorted(PICKUP_PREFIX))
    parser.add_argument("--year", type=int, required=True)
    parser.add_argument("--month", type=int, required=True)
    args = parser.parse_args()
    run(build_session("quality_run"), args.table, args.service, args.year, args.month)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
