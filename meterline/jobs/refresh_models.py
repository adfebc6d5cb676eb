"""Keep the monthly models up to date month by month.

The facts and the sums, counts and bitmaps behind each mart are stored by month. When months are loaded anew, their facts
and states are made again, and of the marts only the months that can differ: these months and, where a row is compared with
an earlier one, the months whose earlier row may have changed. The rest of the tables is neither read as trips nor written.

    python -m meterline.jobs.refresh_models --raw DIR --target DIR [--month 2024-03 ...] [--select MODEL ...]

Without ``--month`` everything is built. The target is a folder of its own: its tables are partitioned by month
numbers, unlike those of ``build_layers``.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.timeparts import month_range
from meterline.jobs.build_layers import Context, raw_reader
from meterline.jobs.lanes import run_in_order
from meterline.operators.bitmaps import id_bitmaps
from meterline.plans import analytics, marts, platform
from meterline.session import build_session
from meterline.sinks.tables import in_partitions, replace_partitions, write_clustered

log = logging.getLogger(__name__)

Months = list[tuple[int, int]]
LOCATIONS = ("pickup_location_id", "dropoff_location_id")


@dataclass
class Store(Context):
    """The staged views of a context and the stored tables of this job."""

    def stored(self, name: str, months: Months | None = None) -> DataFrame:
        """A stored model, of all months or of some."""
        table = self.spark.read.parquet(f"{self.target}/{name}")
        return table if months is None else table.where(in_partitions(list(KEPT[name].by), months))

    def zones(self) -> DataFrame:
        return marts.dim_zones(self.raw("zones"))


@dataclass(frozen=True)
class Kept:
    """A model stored by month. ``build`` gets the months wanted, None for all; more rows than those do no harm.

    ``compares`` names the keys within which a row is compared with the one of an earlier month. Without ``by`` the
    model is small and is written whole.
    """

    build: Callable[[Store, Months | None], DataFrame]
    uses: tuple[str, ...] = ()
    by: tuple[str, ...] = ("pickup_year", "pickup_month")
    cluster_by: tuple[str, ...] = field(default=())
    compares: tuple[str, ...] | None = None


def in_months(time: str, months: Months | None) -> Column:
    """Half-open time ranges that cover the months; neighbours share one, so that the scan gets few filters."""
    if months is None:
        return F.lit(True)
    ranges: list[list[str]] = []
    for year, month in sorted(set(months)):
        first, later = month_range(year, month)
        if ranges and ranges[-1][1] == first:
            ranges[-1][1] = later
        else:
            ranges.append([first, later])
    t = F.col(time)
    each = [(t >= F.lit(a).cast("timestamp")) & (t < F.lit(b).cast("timestamp")) for a, b in ranges]
    return reduce(Column.__or__, each, F.lit(False))


KEPT: dict[str, Kept] = {
    "fct_trips": Kept(
        lambda s, m: marts.fct_trips(s.get("trips_unioned").where(in_months("pickup_datetime", m))), cluster_by=LOCATIONS
    ),
    "zone_state": Kept(lambda s, m: marts.zone_state(s.stored("fct_trips", m)), uses=("fct_trips",)),
    "monthly_zone_revenue": Kept(
        lambda s, m: marts.zone_revenue_of(s.stored("zone_state", m), s.zones()), uses=("zone_state",)
    ),
    "fare_percentiles": Kept(
        lambda s, m: analytics.fare_percentiles(s.stored("fct_trips", m)), uses=("fct_trips",), by=("year", "month_number")
    ),
    "revenue_growth": Kept(
        lambda s, m: analytics.growth_of(s.stored("zone_state"), s.zones()),
        uses=("zone_state",),
        by=("year", "month_number"),
        compares=("service_type", "pickup_zone"),
    ),
    "fact_trips": Kept(
        lambda s, m: platform.fact_trips(s.get("stg_keyed").where(in_months("pickup_datetime", m))), cluster_by=LOCATIONS
    ),
    "kpi_pairs": Kept(lambda s, m: platform.kpi_pairs(s.stored("fact_trips", m)), uses=("fact_trips",)),
    "kpi_ids": Kept(
        lambda s, m: id_bitmaps(s.stored("kpi_pairs", m), platform.MONTH, list(platform.UNIQUE)), uses=("kpi_pairs",)
    ),
    "monthly_kpis": Kept(
        lambda s, m: platform.monthly_kpis_of(s.stored("kpi_pairs"), s.stored("kpi_ids")),
        uses=("kpi_pairs", "kpi_ids"),
        compares=(),
    ),
    "yearly_kpis": Kept(
        lambda s, m: platform.yearly_kpis_of(s.stored("kpi_pairs"), s.stored("kpi_ids")),
        uses=("kpi_pairs", "kpi_ids"),
        by=(),
    ),
}


def chosen(names: list[str] | None = None) -> list[str]:
    """The named models, all without names, and what they are made from, in order."""
    if names is None:
        return list(KEPT)
    if unknown := sorted(set(names) - set(KEPT)):
        raise ValueError(f"unknown models {unknown}")
    wanted, stack = set(names), list(names)
    while stack:
        new = set(KEPT[stack.pop()].uses) - wanted
        wanted |= new
        stack += new
    return [name for name in KEPT if name in wanted]


def months_to_rewrite(rows: DataFrame, by: tuple[str, str], keys: tuple[str, ...], reloaded: Months) -> Months:
    """Months whose rows can differ once some were reloaded, for rows compared with the row before of their key.

    These are the reloaded months and, for each key, the month of the first row behind a reloaded one, whether or not
    the key has a row in the reloaded month itself.
    """
    year, month = by
    at = (F.col(year) * 12 + F.col(month)).cast("int")
    before = F.lag("_at").over(Window.partitionBy(*keys).orderBy("_at"))
    placed = rows.select(*keys, year, month, at.alias("_at")).withColumn("_before", before)
    since = F.array(*[F.lit(y * 12 + m) for y, m in reloaded])
    first_behind = F.exists(since, lambda t: (t < F.col("_at")) & (F.col("_before").isNull() | (F.col("_before") <= t)))
    found = placed.where(first_behind).select(year, month).distinct().collect()  # months, not rows
    return sorted({*reloaded, *[(r[year], r[month]) for r in found]})


def _make(store: Store, name: str, months: Months | None) -> Months | None:
    model, path = KEPT[name], f"{store.target}/{name}"
    df, by = model.build(store, months), list(model.by)
    if months is None or not by:
        write_clustered(df, path, by, list(model.cluster_by))
        return None
    wanted = months if model.compares is None else months_to_rewrite(df, model.by, model.compares, months)
    replace_partitions(df, path, by, wanted, list(model.cluster_by))
    return wanted


def refresh(
    store: Store, months: Months | None = None, names: list[str] | None = None, lanes: int = 4
) -> dict[str, Months | None]:
    """Make the models anew, of all months or of those reloaded; returns the months written per model, None for all.

    A reloaded month in which no trip begins is an error before anything is written. Models that don't use each other
    are made at the same time. Doing it again gives the same tables; a run that failed half way is done again.
    """
    order, written = chosen(names), {}
    if months is not None:
        months = sorted(set(months))
        begun = store.get("trips_unioned").where(in_months("pickup_datetime", months))
        found = begun.select(F.year("pickup_datetime"), F.month("pickup_datetime")).distinct().collect()
        if missing := sorted(set(months) - {tuple(r) for r in found}):
            raise ValueError(f"no trips in {missing}")

    def make(name: str) -> None:
        written[name] = _make(store, name, months)
        log.info("%s: %s", name, "all months" if written[name] is None else written[name])

    run_in_order(order, lambda name: KEPT[name].uses, make, lanes)
    return {name: written[name] for name in order}


def main() -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--raw", required=True)
    parser.add_argument("--target", required=True)
    parser.add_argument("--month", nargs="*", help="months loaded anew, as 2024-03; all without it")
    parser.add_argument("--select", nargs="*")
    args = parser.parse_args()
    months = [(int(m[:4]), int(m[5:])) for m in args.month] if args.month else None
    spark = build_session("refresh_models")
    refresh(Store(spark, raw_reader(spark, args.raw), args.target), months, args.select)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
