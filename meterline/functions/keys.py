"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the marker the public key recipe puts in place of NULL.
NULL_MARK = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: Column | str) -> Column:
    """MD5 over the text form of the columns joined with ``-``."""
    parts = []
    for c in columns:
        c = F.col(c) if isinstance(c, str) else c
        parts.append(F.coalesce(c.cast("string"), F.lit(NULL_MARK)))
    return F.md5(F.concat_ws("-", *parts))
