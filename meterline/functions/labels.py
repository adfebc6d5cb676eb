"""Code-to-label lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The public code lists of the trip records.
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
RATE_LABELS = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}
UNKNOWN = "Unknown"


def label(code: Column | str, names: dict[int, str], other: str | None = UNKNOWN) -> Column:
    """Name of a code; ``other`` for codes not listed and for NULL."""
    code = F.col(code) if isinstance(code, str) else code
    out = F.lit(other)
    for key, name in names.items():
        out = F.when(code == key, F.lit(name)).otherwise(out)
    return out


def payment_label(code: Column | str) -> Column:
    return label(code, PAYMENT_LABELS)


def rate_label(code: Column | str) -> Column:
    return label(code, RATE_LABELS)


def month_label(month: Column) -> Column:
    """English month name of a month number."""
    return F.date_format(F.make_date(F.lit(2000), month.cast("int"), F.lit(1)), "MMMM")
