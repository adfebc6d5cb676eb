"""Top-k, extremes and shares. Ties are broken by the columns given, so results are stable."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.numbers import rounded


def top_n(df: DataFrame, by: str, n: int, ties: list[str], ascending: bool = False) -> DataFrame:
    first = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(first, *[F.col(t).asc_nulls_last() for t in ties]).limit(n)


def share_of_total(grouped: DataFrame, measure: str, name: str, digits: int = 2) -> DataFrame:
    """Percentage of the overall sum. For grouped input, which is small."""
    total = F.sum(measure).over(Window.partitionBy()).cast("double")
    return grouped.withColumn(name, rounded(F.lit(100.0) * F.col(measure) / F.nullif(total, F.lit(0.0)), digits))


def extreme_days(per_day: DataFrame, day: str, measure: str) -> DataFrame:
    """Day of the largest and of the smallest measure, the earliest day on a tie."""
    def pair(best):
        return F.struct(best, F.col(day).alias("day"))

    least = F.min(pair(F.col(measure).alias("m")))
    most = F.min(pair((-F.col(measure)).alias("m")))
    return per_day.agg(most.alias("_most"), least.alias("_least")).select(
        F.col("_most.day").alias("busiest_day"),
        (-F.col("_most.m")).alias("busiest_value"),
        F.col("_least.day").alias("quietest_day"),
        F.col("_least.m").alias("quietest_value"),
    )
