"""Join helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on equally named keys where NULL matches NULL. Keys come from the left side.

    The right keys are renamed first, so both sides may stem from the same DataFrame.
    """
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, match, how).drop(*[f"_right_{k}" for k in keys])


def unmatched_keys(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values of a foreign key without a parent row, with the number of rows that hold them.

    Rows are counted per key before the anti-join, so a frequent key is one row in the join.
    """
    held = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    parents = parent.select(F.col(parent_column).alias("_parent"))
    return held.join(parents, held._key == parents._parent, "left_anti").select(
        F.col("_key").alias(column), "row_count"
    )
