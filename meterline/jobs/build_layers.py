"""Build the model layers, with their tests in between.

Views are lazy DataFrames; tables are written once and read by everything downstream, so the wide
trip facts are computed a single time.

    python -m meterline.jobs.build_layers --raw DIR --target DIR [--select MODEL] [--upstream]
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from meterline.functions.names import lower_columns
from meterline.jobs.lanes import run_in_order
from meterline.operators import quality as dq
from meterline.plans import analytics, marts, platform, staging
from meterline.schemas import ZONES
from meterline.session import build_session
from meterline.sinks.tables import write_clustered
from meterline.sources.files import read_csv, read_monthly

log = logging.getLogger(__name__)


@dataclass
class Context:
    """Where the raw data is, where tables go and what has been built so far."""

    spark: SparkSession
    raw: Callable[[str], DataFrame]
    target: str
    days_back: int | None = None
    as_of: str | None = None
    built: dict[str, DataFrame] = field(default_factory=dict)

    def get(self, name: str) -> DataFrame:
        """A model built in this run, else its stored table, else the model as a view."""
        if name not in self.built:
            model = MODELS[name]
            if model.table:
                self.built[name] = self.spark.read.parquet(f"{self.target}/{name}")
            else:
                self.built[name] = model.build(self)
        return self.built[name]


@dataclass(frozen=True)
class Model:
    build: Callable[[Context], DataFrame]
    uses: tuple[str, ...] = ()
    table: bool = False
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    rules: tuple[dq.Rule, ...] = ()
    # (column, parent model, parent column)
    parents: tuple[tuple[str, str, str], ...] = ()
    unique: tuple[str, ...] = ()


SERVICES = ["Green", "Yellow"]
PAYMENTS = ["Credit card", "Cash", "No charge", "Dispute", "Unknown", "Voided trip"]


def _staged_rules(service: str) -> tuple[dq.Rule, ...]:
    return (
        dq.not_null("vendor_id"),
        dq.accepted_values("vendor_id", [1, 2]),
        dq.not_null("pickup_datetime"),
        dq.not_null("dropoff_datetime"),
        dq.not_null("passenger_count", severity="warn"),
        dq.accepted_values("payment_type", [1, 2, 3, 4, 5, 6]),
        dq.accepted_values("service_type", [service]),
    )


MODELS: dict[str, Model] = {
    "stg_green": Model(lambda c: staging.stage_green(c.raw("green")), rules=_staged_rules("Green")),
    "stg_yellow": Model(lambda c: staging.stage_yellow(c.raw("yellow")), rules=_staged_rules("Yellow")),
    "stg_fhv": Model(
        lambda c: staging.stage_fhv(c.raw("fhv")),
        rules=(dq.not_null("pickup_datetime"), dq.not_null("dispatching_base_num", severity="warn")),
    ),
    "trips_unioned": Model(
        lambda c: marts.union_trips(c.get("stg_green"), c.get("stg_yellow")), uses=("stg_green", "stg_yellow")
    ),
    "dim_zones": Model(
        lambda c: marts.dim_zones(c.raw("zones")),
        table=True,
        rules=(dq.not_null("location_id"), dq.not_null("zone")),
        unique=("location_id",),
    ),
    "fct_trips": Model(
        lambda c: marts.fct_trips(c.get("trips_unioned")),
        uses=("trips_unioned", "dim_zones"),
        table=True,
        partition_by=("pickup_year", "pickup_month"),
        cluster_by=("pickup_location_id", "dropoff_location_id"),
        rules=(
            dq.not_null("pickup_datetime"),
            dq.not_null("pickup_location_id"),
            dq.not_null("service_type"),
            dq.accepted_values("service_type", SERVICES),
            dq.not_null("is_invalid_trip"),
        ),
        parents=(
            ("pickup_location_id", "dim_zones", "location_id"),
            ("dropoff_location_id", "dim_zones", "location_id"),
        ),
    ),
    "monthly_zone_revenue": Model(
        lambda c: marts.monthly_zone_revenue(c.get("fct_trips"), c.get("dim_zones")),
        uses=("fct_trips", "dim_zones"),
        table=True,
        rules=tuple(
            dq.not_null(n)
            for n in ("service_type", "pickup_year", "pickup_month", "pickup_location_id", "total_monthly_trips")
        ),
    ),
    "fare_percentiles": Model(
        lambda c: analytics.fare_percentiles(c.get("fct_trips")),
        uses=("fct_trips",),
        table=True,
        rules=(
            dq.accepted_values("service_type", SERVICES),
            dq.not_null("p90_fare"),
            dq.expression_is_true("p90_fare", ">= 0"),
            dq.expression_is_true("p95_fare", ">= p90_fare", severity="warn"),
            dq.expression_is_true("p97_fare", ">= p95_fare", severity="warn"),
            dq.expression_is_true("trip_count", "> 0"),
        ),
    ),
    "revenue_growth": Model(
        lambda c: analytics.revenue_growth(c.get("fct_trips"), c.get("dim_zones")),
        uses=("fct_trips", "dim_zones"),
        table=True,
        rules=(
            dq.not_null("pickup_zone"),
            dq.not_null("revenue"),
            dq.expression_is_true("revenue", ">= 0"),
            dq.expression_is_true("mom_growth_pct", ">= -100", severity="warn"),
            dq.expression_is_true("revenue_per_trip", "> 0", where="trip_count > 0"),
        ),
    ),
    "payment_analysis": Model(
        lambda c: analytics.payment_analysis(c.get("fct_trips"), c.as_of, c.days_back),
        uses=("fct_trips",),
        rules=(dq.accepted_values("payment_method", PAYMENTS), dq.not_null("rate_type")),
    ),
    "stg_keyed": Model(lambda c: staging.stage_keyed_trips(c.raw("green"))),
    "fact_trips": Model(
        lambda c: platform.with_month_partition(platform.fact_trips(c.get("stg_keyed"), stamped=True)),
        uses=("stg_keyed",),
        table=True,
        partition_by=("pickup_month_start",),
        cluster_by=("pickup_location_id", "dropoff_location_id"),
        rules=(dq.expression_is_true("fare_amount", "> 0"),),
    ),
    "monthly_kpis": Model(lambda c: platform.monthly_kpis(c.get("fact_trips")), uses=("fact_trips",), table=True),
}


def selection(names: list[str] | None = None, upstream: bool = False) -> list[str]:
    """Models to build in order: all, the named ones, or the named ones with what they use."""
    if names is None:
        return list(MODELS)
    unknown = sorted(set(names) - set(MODELS))
    if unknown:
        raise ValueError(f"unknown models {unknown}")
    wanted = set(names)
    if upstream:
        stack = list(names)
        while stack:
            for used in MODELS[stack.pop()].uses:
                if used not in wanted:
                    wanted.add(used)
                    stack.append(used)
    return [name for name in MODELS if name in wanted]


def run_tests(ctx: Context, name: str) -> DataFrame | None:
    """Report of a model's tests: its row rules in one pass, then keys and parents."""
    model, df = MODELS[name], ctx.get(name)
    reports = [dq.run_rules(df, list(model.rules))] if model.rules else []
    reports += [dq.unique(df, column) for column in model.unique]
    reports += [dq.relationships(df, column, ctx.get(parent), key) for column, parent, key in model.parents]
    return dq.combine(*reports) if reports else None


def build(
    ctx: Context, names: list[str] | None = None, upstream: bool = False, test: bool = True, stop: bool = True, lanes: int = 4
) -> list[str]:
    """Build the selected models, each with its tests; models that don't use each other are built at the same time.

    A failing test of severity ``error`` stops the build of all that uses the model, or is logged where ``stop`` is False.
    """
    chosen = selection(names, upstream)

    def make(name: str) -> None:
        model = MODELS[name]
        df = model.build(ctx)
        if model.table:
            path = f"{ctx.target}/{name}"
            write_clustered(df, path, list(model.partition_by), list(model.cluster_by))
            df = ctx.spark.read.parquet(path)
        else:
            df.createOrReplaceTempView(name)
        ctx.built[name] = df
        if test:
            report = run_tests(ctx, name)
            try:
                if report is not None:
                    dq.rule_gate(report)
            except dq.QualityError as failure:
                if stop:
                    raise
                log.warning("%s: %s", name, failure)
        log.info("built %s", name)

    run_in_order(chosen, lambda name: MODELS[name].uses, make, lanes)
    return chosen


def raw_reader(spark: SparkSession, root: str) -> Callable[[str], DataFrame]:
    """Raw data as monthly Parquet files and a zone lookup in CSV."""

    def read(name: str) -> DataFrame:
        if name == "zones":
            return read_csv(spark, f"{root}/taxi_zone_lookup.csv", ZONES)
        frame = read_monthly(spark, root, name)
        return lower_columns(frame) if name == "fhv" else frame

    return read


def main() -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--raw", required=True)
    parser.add_argument("--target", required=True)
    parser.add_argument("--select", nargs="*")
    parser.add_argument("--upstream", action="store_true")
    parser.add_argument("--days-back", type=int)
    parser.add_argument("--no-tests", action="store_true")
    args = parser.parse_args()
    spark = build_session("build_layers")
    ctx = Context(spark, raw_reader(spark, args.raw), args.target, args.days_back)
    build(ctx, args.select, args.upstream, not args.no_tests)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
