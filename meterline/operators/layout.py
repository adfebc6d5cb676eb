"""Clustering keys over several columns: one number per row whose order keeps rows near that are near in every column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quantile_cuts(df: DataFrame, columns: list[str], bits: int) -> dict[str, list]:
    """Values that cut each column into ``2 ** bits`` parts of similar size; one scan, one row of figures."""
    points = [i / 2**bits for i in range(1, 2**bits)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), points, 10_000).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    return {c: sorted(set(row[i] or [])) for i, c in enumerate(columns)}


def z_value(cuts: dict[str, list], bits: int) -> Column:
    """The bits of the columns' quantile ranks, interleaved: the highest bit of each column first. NULL ranks lowest.

    Ranks, not values, so that a skewed column is split as finely as an even one.
    """
    width = len(cuts)
    terms = []
    for place, (column, values) in enumerate(cuts.items()):
        above = [F.coalesce(F.col(column).cast("double") > F.lit(v), F.lit(False)).cast("int") for v in values]
        rank = reduce(Column.__add__, above, F.lit(0))
        terms += [F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * width + width - 1 - place) for bit in range(bits)]
    return reduce(Column.bitwiseOR, terms)
