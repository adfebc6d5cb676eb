"""Time windows over event tables, in batch and in streaming.

The functions built on ``F.window`` and ``F.session_window`` take a batch or a streaming
DataFrame. The ones named ``batch_*`` give the same rows from far fewer shuffled ones: they first
fold the events into panes, whose number depends on the time covered and not on the event count,
so a key holding a third of all events stays cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIME = "event_timestamp"


def _flat(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *measures
    )


def tumble(df: DataFrame, width: str, keys: list[str], measures: dict[str, Column], time: str = TIME) -> DataFrame:
    grouped = df.groupBy(F.window(time, width).alias("window"), *keys)
    return _flat(grouped.agg(*[c.alias(n) for n, c in measures.items()]), keys, list(measures))


def hop(df: DataFrame, width: str, step: str, keys: list[str], measures: dict[str, Column], time: str = TIME) -> DataFrame:
    """Sliding windows. Every event lands in width/step of them."""
    grouped = df.groupBy(F.window(time, width, step).alias("window"), *keys)
    return _flat(grouped.agg(*[c.alias(n) for n, c in measures.items()]), keys, list(measures))


def sessions(df: DataFrame, gap: str, keys: list[str], measures: dict[str, Column], time: str = TIME) -> DataFrame:
    """Sessions per key. In streaming at least one key is required."""
    grouped = df.groupBy(F.session_window(time, gap).alias("window"), *keys)
    return _flat(grouped.agg(*[c.alias(n) for n, c in measures.items()]), keys, list(measures))


def batch_hop(
    df: DataFrame, width_seconds: int, step_seconds: int, keys: list[str], sums: dict[str, Column], time: str = TIME
) -> DataFrame:
    """Sliding counts and sums by way of panes one step wide.

    ``sums`` maps output names to row expressions that may be added up; use ``F.lit(1)`` to count.
    """
    if width_seconds % step_seconds:
        raise ValueError("the width must be a multiple of the step")
    step = step_seconds * 1_000_000
    pane = F.floor(F.unix_micros(time) / F.lit(step)).cast("bigint")
    panes = df.groupBy(pane.alias("_pane"), *keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    reach = width_seconds // step_seconds
    spread = panes.withColumn("_first", F.explode(F.sequence(F.col("_pane") - (reach - 1), F.col("_pane"))))
    rolled = spread.groupBy("_first", *keys).agg(*[F.sum(n).alias(n) for n in sums])
    start = F.col("_first") * step
    return rolled.select(
        F.timestamp_micros(start).alias("window_start"),
        F.timestamp_micros(start + width_seconds * 1_000_000).alias("window_end"),
        *keys,
        *sums,
    )


# Panes that one task sessionizes: a key's history is cut into blocks of so many.
BLOCK_PANES = 4096


def batch_sessions(df: DataFrame, gap_seconds: int, keys: list[str], time: str = TIME) -> DataFrame:
    """Sessions with their event count; a pause of exactly the gap does not end one.

    Events closer than the gap always share a session, so events are first folded into panes one
    gap wide. A session can only break between panes. Time is cut into blocks of ``BLOCK_PANES`` panes, and every block of a
    key is sessionized alone. Only its first and last session can go on in another block, so two rows per block and key at
    most meet to be stitched, in order, into chains; a chain is one session however many blocks it covers. All other sessions are done.
    """
    gap = gap_seconds * 1_000_000
    micros = F.unix_micros(time)
    panes = df.groupBy(F.floor(micros / F.lit(gap)).cast("bigint").alias("_pane"), *keys).agg(
        F.min(micros).alias("_first"), F.max(micros).alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    local = _numbered(panes.withColumn("_block", F.floor(F.col("_pane") / F.lit(BLOCK_PANES))), [*keys, "_block"], gap)
    of_block = Window.partitionBy(*keys, "_block")
    local = local.withColumn("_last_session", F.max("_session").over(of_block))
    parts = _merged(local, [*keys, "_block", "_last_session"])
    # Edge sessions of all blocks of a key share one partition, the others stay with their block, where nothing joins them.
    edge = F.col("_session").isin(1) | (F.col("_session") == F.col("_last_session"))
    parts = parts.withColumn("_block", F.when(~edge, F.col("_block"))).drop("_session", "_last_session")
    return _as_sessions(_merged(_numbered(parts, [*keys, "_block"], gap), [*keys, "_block"]), gap, keys)


def _as_sessions(stretches: DataFrame, gap: int, keys: list[str]) -> DataFrame:
    return stretches.select(
        F.timestamp_micros("_first").alias("window_start"),
        F.timestamp_micros(F.col("_last") + gap).alias("window_end"),
        *keys,
        F.col("_n").alias("num_trips"),
    )


def _numbered(stretches: DataFrame, keys: list[str], gap: int) -> DataFrame:
    """Add ``_session``: stretches of time (``_first``, ``_last``) no further apart than the gap get one number per key.

    They may overlap or hold each other, so the distance is that to the latest end so far.
    """
    order = Window.partitionBy(*keys).orderBy("_first")
    reached = F.max("_last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    breaks = F.coalesce(F.col("_first") - reached > gap, F.lit(True))
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return stretches.withColumn("_new", breaks.cast("int")).withColumn("_session", F.sum("_new").over(running)).drop("_new")


def _merged(stretches: DataFrame, keys: list[str]) -> DataFrame:
    return stretches.groupBy(*keys, "_session").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("_n"))


def merge_sessions(parts: DataFrame, gap_seconds: int, keys: list[str]) -> DataFrame:
    """One row per session from sessions of parts of the events, which may overlap, touch or hold each other.

    All parts of a key meet in one window: give it those of a bounded time.
    """
    gap = gap_seconds * 1_000_000
    stretches = parts.select(
        *keys,
        F.unix_micros("window_start").alias("_first"),
        (F.unix_micros("window_end") - gap).alias("_last"),
        F.col("num_trips").alias("_n"),
    )
    return _as_sessions(_merged(_numbered(stretches, keys, gap), keys), gap, keys)
