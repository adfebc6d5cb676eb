"""Table profiles: describe, missing values, duplicates, anomalies, histogram, box plot numbers.

Each is one pass over the table, or two where the second needs a result of the first. No result
goes through the driver in between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.numbers import rounded
from meterline.operators.percentiles import column_facts, column_percentiles, exact_percentiles


QUARTILES = {"q25_value": 0.25, "q50_value": 0.5, "q75_value": 0.75}


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column, NULL quartiles where there is no value.

    The table is read wide: no row is repeated per column. What reaches the driver is one row of figures per column.
    """
    facts = column_facts(df, columns, QUARTILES)
    names = ["value_count", "mean_value", "std_value", "min_value", "max_value"]
    rows = [(c, *(facts[c][n] for n in names)) for c in columns]
    schema = "column_name string, value_count long, mean_value double, std_value double, min_value double, max_value double"
    moments = df.sparkSession.createDataFrame(rows, schema)
    return moments.join(column_percentiles(df, columns, QUARTILES, facts), "column_name", "left")


def missing_values(df: DataFrame) -> DataFrame:
    """Missing count and percentage of the columns that have any. NaN counts as missing."""
    def missing(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return c.isNull() | F.isnan(c)
        return c.isNull()

    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(missing(f)).alias(f.name) for f in df.schema.fields]
    )
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing_count")) for c in df.columns])
    return (
        counts.select("_rows", F.explode(rows).alias("r"))
        .where(F.col("r.missing_count") > 0)
        .select(
            "r.column_name",
            "r.missing_count",
            rounded(F.lit(100.0) * F.col("r.missing_count") / F.col("_rows"), 2).alias("missing_pct"),
        )
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier one."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def count_matching(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row, one count per rule, in one pass."""
    return df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])


def match_share(df: DataFrame, rule: Column) -> DataFrame:
    return df.agg(
        F.count_if(rule).alias("matching"),
        F.count(F.lit(1)).alias("total"),
        rounded(
            F.lit(100.0) * F.count_if(rule) / F.nullif(F.count(F.lit(1)), F.lit(0)), 2
        ).alias("matching_pct"),
    )


def histogram(df: DataFrame, value: str, bins: int = 50, below: float | None = None) -> DataFrame:
    """Equal-width bins between the smallest and largest value; the last bin is closed."""
    v = F.col(value).cast("double")
    kept = df.where(v.isNotNull() if below is None else v < F.lit(below)).select(v.alias("_v"))
    # A single distinct value gets a range of width one around it.
    pad = F.when(F.min("_v") == F.max("_v"), 0.5).otherwise(0.0)
    bounds = kept.agg(F.struct((F.min("_v") - pad).alias("lo"), (F.max("_v") + pad).alias("hi"))).scalar()
    numbered = kept.withColumn("_b", bounds)
    width = F.col("_b.hi") - F.col("_b.lo")
    position = F.floor((F.col("_v") - F.col("_b.lo")) / width * bins)
    bin_no = F.least(position, F.lit(bins - 1)).cast("bigint")
    return (
        numbered.groupBy(bin_no.alias("bin"), F.col("_b.lo").alias("_lo"), width.alias("_width"))
        .agg(F.count(F.lit(1)).alias("value_count"))
        .select(
            "bin",
            (F.col("_lo") + F.col("bin") * F.col("_width") / bins).alias("bin_start"),
            (F.col("_lo") + (F.col("bin") + 1) * F.col("_width") / bins).alias("bin_end"),
            "value_count",
        )
    )


def box_stats(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Quartiles per group with the fences at 1.5 times the quartile distance."""
    q = exact_percentiles(df, keys, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    q = q.select(*keys, "q1", "median", "q3")
    return q.withColumns({"lower_fence": F.col("q1") - 1.5 * spread, "upper_fence": F.col("q3") + 1.5 * spread})


def median_and_mean(df: DataFrame, value: str) -> DataFrame:
    mean = df.agg(F.avg(F.col(value).cast("double")).alias("m")).scalar()
    return exact_percentiles(df, [], value, {"median_value": 0.5}).select("median_value", mean.alias("mean_value"))
