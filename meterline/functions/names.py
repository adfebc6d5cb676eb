"""Column-name normalisation."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def _renamed(df: DataFrame, rule) -> DataFrame:
    names = [rule(name) for name in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names clash after renaming: {clashes}")
    return df.toDF(*names)


def lower_columns(df: DataFrame) -> DataFrame:
    return _renamed(df, str.lower)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case names with blanks as underscores."""
    return _renamed(df, lambda name: name.lower().replace(" ", "_"))


def snake_name(name: str) -> str:
    """``Trip_Pickup_DateTime`` becomes ``trip_pickup_date_time``."""
    name = re.sub(r"[^0-9A-Za-z]+", "_", name.strip())
    name = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"_+", "_", name).strip("_").lower()


def snake_columns(df: DataFrame) -> DataFrame:
    return _renamed(df, snake_name)
