"""Exact continuous percentiles that never gather a group in one task.

The built-in exact percentile keeps all distinct values of a group in one task's memory, which a
group holding a third of the rows would break. Here the work goes in steps:

1. count equal values per group (map-side combined, spread over group and value);
2. cut each group's distinct values into ranges of similar size with a mergeable sketch;
3. add up the ranges to learn which of them hold the wanted ranks, and keep the values of those;
4. cut what is kept again, and again, until no range has more than ``RANGE_ROWS`` values;
5. sort only those ranges, each on its own, and read the values off.

The sketch only balances the ranges. The ranks are exact whatever it returns. All groups and shares are narrowed in
one loop; each round keeps about a sixty-fourth of its rows per wanted rank, so rounds after the first are cheap. What a
round keeps is written to the shared folder: the loop looks at one number per round, and no step is computed twice.

Many columns of a wide table have their own way, ``column_percentiles``: sketches of all columns in one aggregate, the ranks
of their bounds in a second one, and only values between the bounds leave the scan, counted before the shuffle.

Steps 2 and 3 start from the counts of step 1. Measures travel in arrays so that column pruning
leaves every use of the counts alike and Spark runs the scan and its shuffle once.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.operators.joins import join_null_safe
from meterline.session import run_dir

RANGE_ROWS = 100_000
RANGES = 64
POINTS = [i / RANGES for i in range(1, RANGES)]
EXACT = "decimal(38,6)"


def _rank(share: float, upper: bool) -> Column:
    position = F.lit(share) * (F.col("value_count") - 1)
    return (F.ceil(position) if upper else F.floor(position)).cast("bigint")


def _inside(rank: Column, start: str, size: str) -> Column:
    return (rank >= F.col(start)) & (rank < F.col(start) + F.col(size))


def _kept(df: DataFrame) -> DataFrame:
    """Write a step to the shared folder and read it back."""
    path = run_dir(df.sparkSession, "ranks")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _number_ranges(df: DataFrame) -> DataFrame:
    """Number of cuts below the value, by quartering the cut list."""
    df = df.withColumn("_range", F.lit(0))
    step = RANGES // 4
    while step:
        jump = F.lit(0)
        for quarter in (1, 2, 3):
            cut = F.get("_facts", F.col("_range") + (quarter * step - 1))
            jump = F.when(cut < F.col("_value"), quarter * step).otherwise(jump)
        df = df.withColumn("_range", F.col("_range") + jump)
        step //= 4
    return df


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, shares: dict[str, float], sums: dict[str, Column] | None = None
) -> DataFrame:
    """One row per group with one column per entry of ``shares`` (output name to share in 0..1).

    Values between two ranks are interpolated linearly. NULL values are left out, as are groups
    without any value. The result also has ``value_count``, ``value_min``, ``value_max`` and the
    totals named in ``sums``, which cost no further pass.
    """
    extra = sums or {}
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_value"))
        .agg(F.array(F.count(F.lit(1)).cast(EXACT), *[F.sum(c).cast(EXACT) for c in extra.values()]).alias("_m"))
    )
    facts = {
        "value_count": F.sum(F.get("_m", F.lit(0))).cast("double"),
        "value_min": F.min("_value"),
        "value_max": F.max("_value"),
        **{name: F.sum(F.get("_m", F.lit(i))).cast("double") for i, name in enumerate(extra, 1)},
    }
    summary = F.concat(F.percentile_approx("_value", POINTS, 1000), F.array(*facts.values())).alias("_facts")
    if keys:
        placed = join_null_safe(counted, counted.groupBy(*keys).agg(summary), keys)
    else:
        placed = counted.withColumn("_facts", counted.agg(summary).scalar())
    placed = _number_ranges(placed).withColumn("_n", F.get("_m", F.lit(0)).cast("bigint"))

    # At most RANGES rows per group from here, so a window over the group is small.
    sizes = placed.groupBy(*keys, "_range").agg(
        F.sum("_n").alias("_size"),
        *[F.max(F.get("_facts", F.lit(i))).alias(name) for i, name in enumerate(facts, RANGES - 1)],
    )
    upto = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = sizes.withColumns(
        {"_before": F.sum("_size").over(upto) - F.col("_size"), "value_count": F.col("value_count").cast("bigint")}
    )
    hits = sizes.where(_wanted(shares)).drop("_size")
    narrowed = _kept(join_null_safe(placed.select(*keys, "_range", "_value", "_n"), hits, [*keys, "_range"]))
    return _read_off(narrow(narrowed, keys, shares), keys, shares, list(facts))


def _ranks(shares: dict[str, float]) -> list[tuple[float, bool]]:
    return sorted({(share, upper) for share in shares.values() for upper in (False, True)})


def _wanted(shares: dict[str, float]) -> Column:
    """Whether the range of ``_size`` rows after the first ``_before`` ones holds a wanted rank."""
    return reduce(lambda a, b: a | b, [_inside(_rank(*r), "_before", "_size") for r in _ranks(shares)])


def narrow(values: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """Cut the ranges that hold wanted ranks until none has more than ``RANGE_ROWS`` values.

    ``values`` has one row per group, ``_range`` and ``_value`` with ``_n`` (times it occurs), ``_before`` (rows of the
    group below the range) and ``value_count``; other columns are facts of the group. A range may be any stretch of the group's order.
    """
    while True:
        sizes = values.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_rows"))
        largest = sizes.agg(F.max("_rows")).first()[0]  # one number
        if largest is None or largest <= RANGE_ROWS:
            return values
        values = _kept(_narrower(values, keys, shares))


def _narrower(values: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """One round: every range cut into ``RANGES`` of similar size, of which those with a wanted rank stay."""
    old = [*keys, "_range"]
    facts = [c for c in values.columns if c not in {*old, "_value", "_n", "_before"}]
    cuts = values.groupBy(*old).agg(F.percentile_approx("_value", POINTS, 1000).alias("_facts"))
    placed = join_null_safe(values.withColumnRenamed("_range", "_old"), cuts.withColumnRenamed("_range", "_old"), [*keys, "_old"])
    placed = _number_ranges(placed)
    sizes = placed.groupBy(*keys, "_old", "_range").agg(
        F.sum("_n").alias("_size"), F.max("_before").alias("_before"), *[F.max(f).alias(f) for f in facts]
    )
    upto = Window.partitionBy(*keys, "_old").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = sizes.withColumn("_before", F.col("_before") + F.sum("_size").over(upto) - F.col("_size"))
    hits = sizes.where(_wanted(shares)).drop("_size", *facts).withColumnRenamed("_before", "_below")
    kept = join_null_safe(placed.drop("_before", "_facts"), hits, [*keys, "_old", "_range"])
    # Ranges of a group are told apart by the rows below them.
    return kept.select(*keys, F.col("_below").alias("_range"), "_value", "_n", F.col("_below").alias("_before"), *facts)


def _read_off(narrowed: DataFrame, keys: list[str], shares: dict[str, float], facts: list[str]) -> DataFrame:
    """The percentiles from the ranges that hold their ranks, each sorted on its own."""
    ranks = _ranks(shares)
    in_range = (
        Window.partitionBy(*keys, "_range")
        .orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = narrowed.withColumn("_start", F.col("_before") + F.sum("_n").over(in_range) - F.col("_n"))
    slots = {rank: f"_at{i}" for i, rank in enumerate(ranks)}
    found = ranked.groupBy(*keys).agg(
        *[F.max(name).alias(name) for name in facts],
        *[F.max(F.when(_inside(_rank(*r), "_start", "_n"), F.col("_value"))).alias(slot) for r, slot in slots.items()],
    )

    def at(share: float) -> Column:
        low, high = F.col(slots[(share, False)]), F.col(slots[(share, True)])
        return low + (high - low) * (F.lit(share) * (F.col("value_count") - 1) - _rank(share, False))

    out = found.where(F.col("value_count").isNotNull())
    return out.select(*keys, *[at(share).alias(name) for name, share in shares.items()], *facts)


# Distance of the bounds from a wanted share, and the accuracy of the sketch that sets them.
REACH, ACCURACY = 0.002, 1000


def column_percentiles(df: DataFrame, columns: list[str], shares: dict[str, float], facts: dict[str, dict]) -> DataFrame:
    """One row per column with a value: ``column_name`` and the percentiles, exactly, in three scans of the wide table.

    ``facts`` has ``value_count``, ``min_value`` and ``max_value`` of every column and, per share, ``bounds``: a value below and one above the
    percentile (``column_facts`` makes them). Where bounds miss a rank, the whole column is looked at, so they only cost time.
    Nothing is multiplied by the number of columns but the few values between bounds.
    """
    value = lambda c: F.col(c).cast("double")
    stretches = {c: _apart(facts[c]["bounds"]) for c in columns if facts[c]["value_count"]}
    if not stretches:
        return df.sparkSession.createDataFrame([], ", ".join(["column_name string", *(f"`{n}` double" for n in shares)]))
    # Two numbers per column and stretch: the values below it, and those up to its end.
    edges = [e for c, spans in stretches.items() for lo, hi in spans for e in (value(c) < F.lit(lo), value(c) <= F.lit(hi))]
    counts = iter(df.agg(*[F.count_if(e).alias(f"_{i}") for i, e in enumerate(edges)]).first())
    below = {}
    for c, spans in stretches.items():
        n = facts[c]["value_count"]
        held = [(lo, hi, next(counts), next(counts)) for lo, hi in spans]
        wanted = {r for share in shares.values() for r in (math.floor(share * (n - 1)), math.ceil(share * (n - 1)))}
        if not all(any(b <= r < u for _, _, b, u in held) for r in wanted):
            held = [(facts[c]["min_value"], facts[c]["max_value"], 0, n)]
        stretches[c], below[c] = [h[:2] for h in held], [h[2] for h in held]
    numbers = {c: i for i, c in enumerate(stretches)}

    def hit(c: str) -> Column:
        v = value(c)
        place = reduce(lambda w, s: w.when(v.between(F.lit(s[1][0]), F.lit(s[1][1])), s[0]), enumerate(stretches[c]), F.when(v.isNull(), None))
        return F.when(place.isNotNull(), F.struct(F.lit(numbers[c]).alias("_column"), place.alias("_range"), v.alias("_value")))

    hits = df.select(F.explode(F.array_compact(F.array(*map(hit, stretches)))).alias("h")).select("h.*")
    counted = hits.groupBy("_column", "_range", "_value").agg(F.count(F.lit(1)).alias("_n"))
    # What is known of a column is looked up after the counting.
    about = lambda of: F.get(F.array(*[F.lit(of[c]) for c in stretches]), F.col("_column"))
    before = F.get(F.get(F.array(*[F.array(*[F.lit(b).cast("bigint") for b in below[c]]) for c in stretches]), F.col("_column")), F.col("_range"))
    counted = counted.select(
        about({c: c for c in stretches}).alias("column_name"), "_range", "_value", "_n", before.alias("_before"),
        about({c: facts[c]["value_count"] for c in stretches}).cast("bigint").alias("value_count"),
    )
    found = _read_off(narrow(_kept(counted), ["column_name"], shares), ["column_name"], shares, ["value_count"])
    return found.select("column_name", *shares)


def _apart(bounds: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The stretches between bounds, those that overlap as one."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(bounds):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def column_facts(df: DataFrame, columns: list[str], shares: dict[str, float]) -> dict[str, dict]:
    """Count, mean, deviation, ends and bounds of the percentiles of every column: one scan, one row, one entry per column."""
    points = [p for share in shares.values() for p in (max(share - REACH, 0.0), min(share + REACH, 1.0))]

    def of(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.struct(
            F.count(v).alias("value_count"),
            F.avg(v).alias("mean_value"),
            F.stddev(v).alias("std_value"),
            F.min(v).alias("min_value"),
            F.max(v).alias("max_value"),
            F.percentile_approx(v, points, ACCURACY).alias("points"),
        ).alias(c)

    row = df.agg(*[of(c) for c in columns]).first()
    out = {}
    for i, c in enumerate(columns):
        facts = row[i].asDict()
        points = facts.pop("points")
        out[c] = facts | {"bounds": list(zip(points[::2], points[1::2])) if points else []}
    return out
