"""Named queries over the sample tables, each with the SQL that must give the same rows."""

from meterline.queries import facts, loads, models, profiles, quality, scans, states, statistics, streams  # noqa: F401
from meterline.queries.base import REGISTRY

__all__ = ["REGISTRY"]
