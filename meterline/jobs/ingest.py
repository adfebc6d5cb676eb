"""Load the trips and the zone lookup into catalog tables and verify them.

    python -m meterline.jobs.ingest --trips FILE --zones FILE [--skip-trips] [--skip-zones]
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from meterline.functions.names import normalize_columns
from meterline.schemas import ZONES
from meterline.session import build_session
from meterline.sinks.tables import load_table, verify_table
from meterline.sources.files import read_csv, read_parquet

log = logging.getLogger(__name__)


def ingest(
    spark: SparkSession,
    trips_path: str | None,
    zones_path: str | None,
    trips_table: str = "green_taxi_trips",
    zones_table: str = "taxi_zones",
    if_exists: str = "replace",
) -> int:
    """Load what is given; 0 when every table holds rows afterwards, else 1."""
    try:
        loaded = []
        if trips_path:
            load_table(read_parquet(spark, trips_path), trips_table, if_exists)
            loaded.append(trips_table)
        if zones_path:
            zones = normalize_columns(read_csv(spark, zones_path, ZONES, null_value="N/A"))
            load_table(zones, zones_table, if_exists)
            loaded.append(zones_table)
        for name in loaded:
            facts = verify_table(spark, name)
            log.info("table %s: %s rows, %s columns", name, facts["row_count"], facts["column_count"])
            if facts["row_count"] == 0:
                return 1
        return 0
    except Exception:
        log.exception("ingest failed")
        return 1


def main() -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--trips")
    parser.add_argument("--zones")
    parser.add_argument("--skip-trips", action="store_true")
    parser.add_argument("--skip-zones", action="store_true")
    parser.add_argument("--if-exists", default="replace", choices=["replace", "append", "fail"])
    args = parser.parse_args()
    spark = build_session("ingest")
    return ingest(
        spark,
        None if args.skip_trips else args.trips,
        None if args.skip_zones else args.zones,
        if_exists=args.if_exists,
    )


if __name__ == "__main__":
    raise SystemExit(main())
