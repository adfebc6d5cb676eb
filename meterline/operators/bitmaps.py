"""Distinct counts kept as bitmaps, which add up: months to years, parts to a whole, without the rows behind them.

An id is a whole number. One bitmap covers 32,768 neighbouring ids in 4 KB, so the state of a group grows with the range of
its ids and not with its rows. As in COUNT(DISTINCT) a NULL id counts nowhere; a group whose ids are all NULL has no bitmap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, keys: list[str], ids: list[str]) -> DataFrame:
    """One row per group, id column (``id_name``) and block of ids (``bucket``) with the ids present as ``bits``.

    The ids are made distinct first, also on the map side: the bitmap aggregate sorts its input, which then
    holds an id once per group and not once per row.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("id_name"), F.col(n).cast("bigint").alias("id")) for n in ids])
    distinct = df.select(*keys, F.inline(pairs)).where(F.col("id").isNotNull()).distinct()
    return distinct.groupBy(*keys, "id_name", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")
    )


def merged_bitmaps(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of coarser groups: ``keys`` are some of the keys, or none for the whole table."""
    return bitmaps.groupBy(*keys, "id_name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_distinct(bitmaps: DataFrame, keys: list[str], counts: dict[str, str]) -> DataFrame:
    """Distinct ids per group of ``keys``. ``counts`` maps id columns to the names of their counts."""
    held = F.bitmap_count("bits")
    named = {out: F.sum(F.when(F.col("id_name") == name, held).otherwise(0)) for name, out in counts.items()}
    return merged_bitmaps(bitmaps, keys).groupBy(*keys).agg(*[F.coalesce(c, F.lit(0)).alias(n) for n, c in named.items()])
