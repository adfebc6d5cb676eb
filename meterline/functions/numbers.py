"""Numeric helpers."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,3)"
MILL = Decimal("0.001")


def to_int(c: Column | str) -> Column:
    """Number to INT, rounding half to even. A plain cast would truncate."""
    return F.bround(c).cast("int")


def to_long(c: Column | str) -> Column:
    return F.bround(c).cast("bigint")


def rounded(c: Column | str, digits: int) -> Column:
    """Round a double half away from zero, on its scaled binary value.

    ``F.round`` prints the double and rounds the text. That is slow, and for 1.005 and its like it
    differs from what SQL engines return. Decimals need no such care; use ``F.round`` for them.
    """
    value = (F.col(c) if isinstance(c, str) else c).cast("double")
    scaled = value * F.lit(10.0**digits)
    size = F.abs(scaled)
    # Adding a half before the floor would carry 0.49999999999999994 up to one; the rest is exact.
    whole = F.floor(size) + F.when(size - F.floor(size) >= 0.5, 1).otherwise(0)
    return F.when(size < F.lit(2.0**52), F.signum(scaled) * whole / F.lit(10.0**digits)).otherwise(value)


def to_money(c: Column | str) -> Column:
    """Number to DECIMAL(18,3) by way of thousandths, ties away from zero; a plain cast prints and parses each double."""
    scaled = (F.col(c) if isinstance(c, str) else c).cast("double") * 1000
    # The double right below one half: added to it, 0.49999999999999994 stays below one, and an exact half reaches it.
    mills = F.floor(F.abs(scaled) + F.lit(0.49999999999999994))
    sign = F.lit(1).cast("bigint") - 2 * (scaled < 0).cast("bigint")
    return ((sign * mills).cast("decimal(18,0)") * F.lit(MILL)).cast(MONEY)


def safe_ratio(top: Column, bottom: Column, digits: int | None = None) -> Column:
    """Quotient, NULL where the divisor is zero."""
    quotient = top / F.nullif(bottom, F.lit(0))
    return quotient if digits is None else rounded(quotient, digits)


def pct_change(now: Column, before: Column, digits: int = 2) -> Column:
    """Growth in percent, computed as double."""
    now, before = now.cast("double"), before.cast("double")
    return rounded(F.lit(100.0) * (now - before) / F.nullif(before, F.lit(0.0)), digits)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every float column; other columns pass through."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[F.when(~F.isnan(n), F.col(n)).alias(n) if n in floats else F.col(n) for n in df.columns]
    )
