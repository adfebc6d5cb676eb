"""Periodic runs of words: recursive frequency splitting, then a lag scan of the segments that survive.

A run is a stretch of consecutive words with smallest period q and at least ``max(LEAST, 2 q)`` words that no neighbouring word
extends keeping period q. Every word of a run stands in it at least ``max(LEAST, 2 q) // q`` times, so at least twice.

Splitting. A word that its segment has only once can't belong to a run inside the segment, so it splits it; pieces of fewer than
``LEAST`` words are dropped, and the pieces are split again, to stability. A word is alone in a segment if its previous and its
next occurrence in the text lie outside, so no piece is counted anew. A segment is searched from both ends at once, a block at
a time, and split where the first lonely words show: the work is that of the smaller side, so ``n log n`` for a text in the worst case.

Lag scan. What survives of a text is put together with a separator of its own between segments (no run can hold one). For each lag
q a run shows as at least ``max(q, LEAST - q)`` consecutive words that equal the word q further on, so testing every word
at that distance finds all of them: ``n log n`` tests for all lags. Each hit is extended to both sides by ranks of stretches of 1, 2, 4, ...
words, which tell exactly whether two stretches are equal. The same stretch found at several lags is a run of the least one.

Defined cases. Null text has no words and no runs; so has an empty one. Texts are judged row by row, whatever doc_ids repeat or are
null. Very long texts are read in slices; a task holds the distinct words of one text and some numbers per word. Other columns
are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import in_slices, named
from meterline.llm.words import Numbering

LEAST = 12
BLOCK = 1 << 10
HITS = 1 << 20
MANY = 64

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


# --- splitting ------------------------------------------------------------------------------------


def neighbours(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the previous and next occurrence of every word (-1 and the length where there is none)."""
    n = words.size
    keys = np.sort(words << 32 | np.arange(n))
    place = keys & 0xFFFFFFFF
    same = keys[1:] >> 32 == keys[:-1] >> 32
    before, after = np.full(n, -1, dtype=np.int64), np.full(n, n, dtype=np.int64)
    before[place[1:][same]] = place[:-1][same]
    after[place[:-1][same]] = place[1:][same]
    return before, after


def _pieces(begin: int, end: int, cuts: np.ndarray) -> list[tuple[int, int]]:
    """The pieces between lonely words that are long enough for a run."""
    starts, ends = np.append(begin, cuts + 1), np.append(cuts, end)
    long = ends - starts >= LEAST
    return list(zip(starts[long].tolist(), ends[long].tolist()))


def segments(words: np.ndarray) -> list[tuple[int, int]]:
    """The stretches that no further lonely word splits, in order."""
    before, after = neighbours(words)
    open_ = _pieces(0, words.size, np.flatnonzero((before < 0) & (after >= words.size)))
    stable = []
    while open_:
        begin, end = open_.pop()
        low, high = begin, end
        cuts = np.zeros(0, np.int64)
        while low < high and not cuts.size:
            left = min(low + BLOCK, high)
            cuts = low + np.flatnonzero((before[low:left] < begin) & (after[low:left] >= end))
            low = left
            if not cuts.size and low < high:
                right = max(high - BLOCK, low)
                cuts = right + np.flatnonzero((before[right:high] < begin) & (after[right:high] >= end))
                high = right
        if cuts.size:
            open_ += _pieces(begin, end, cuts)
        else:
            stable.append((begin, end))
    return sorted(stable)


# --- lag scan -------------------------------------------------------------------------------------


class Stretches:
    """Ranks of all stretches of 1, 2, 4, ... words: equal ranks are equal words."""

    def __init__(self, words: np.ndarray):
        self.size = words.size
        self.levels = [np.unique(words, return_inverse=True)[1]]
        width = 1
        while 2 * width <= words.size:
            half = self.levels[-1]
            _, rank = np.unique(half[:-width].astype(np.int64) << 32 | half[width:], return_inverse=True)
            self.levels.append(rank)
            width *= 2

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on (i < j)."""
        i, j, total = i.copy(), j.copy(), np.zeros_like(i)
        for k in reversed(range(len(self.levels))):
            level = self.levels[k]
            fits = j < level.size
            hit = fits & (level[np.where(fits, i, 0)] == level[np.where(fits, j, 0)])
            step = np.where(hit, 1 << k, 0)
            i, j, total = i + step, j + step, total + step
        return total

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words right before i equal those right before j (i < j)."""
        i, j, total = i.copy(), j.copy(), np.zeros_like(i)
        for k in reversed(range(len(self.levels))):
            level, width = self.levels[k], 1 << k
            fits = i >= width
            hit = fits & (level[np.where(fits, i - width, 0)] == level[np.where(fits, j - width, 0)])
            step = np.where(hit, width, 0)
            i, j, total = i - step, j - step, total + step
        return total


    def firsts(self, at: np.ndarray, step: int, lag: int) -> np.ndarray:
        """The hits of a lag without those that the hit one step before reaches: both lie in one stretch."""
        k = step.bit_length() - 1
        level, low = self.levels[k], at[:-1]
        high = np.minimum(low + step - (1 << k), level.size - 1 - lag)  # only met where the next hit is one step off
        low_ok = np.minimum(low, level.size - 1 - lag)
        equal = (level[low_ok] == level[low_ok + lag]) & (level[high] == level[high + lag])
        return at[np.append(True, ~(equal & (np.diff(at) == step)))]


def _extended(stretches: Stretches, hits: list[np.ndarray], lags: list[int]) -> np.ndarray:
    """Rows ``start, end, lag`` of the distinct stretches around the hits that are long enough."""
    at = np.concatenate(hits)
    lag = np.repeat(np.array(lags, dtype=np.int64), [h.size for h in hits])
    back = stretches.behind(at, at + lag)
    equal = back + stretches.ahead(at, at + lag)
    long = equal >= np.maximum(lag, LEAST - lag)
    start, lag = (at - back)[long], lag[long]
    return np.unique(np.column_stack([start, start + equal[long] + lag, lag]), axis=0)


def scan(words: np.ndarray, longest: int) -> np.ndarray:
    """Rows ``start, end, period`` of all runs of ``words``; no run is longer than ``longest``."""
    stretches = Stretches(words)
    found, hits, lags, size = [], [], [], 0
    for lag in range(1, longest // 2 + 1):
        step = max(lag, LEAST - lag)
        at = np.arange(0, words.size - lag, step)
        at = at[words[at] == words[at + lag]]
        if at.size > MANY:
            at = stretches.firsts(at, step, lag)
        if at.size:
            hits.append(at)
            lags.append(lag)
            size += at.size
            if size > HITS:
                found.append(_extended(stretches, hits, lags))
                hits, lags, size = [], [], 0
    if hits:
        found.append(_extended(stretches, hits, lags))
    if not found:
        return np.zeros((0, 3), dtype=np.int64)
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), dtype=bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[first]


def runs(words: np.ndarray) -> Runs:
    """Start, length and period of every run, by start, then period."""
    none = np.zeros(0, dtype=np.int64)
    kept = segments(words)
    if not kept:
        return none, none, none
    # Each segment is followed by a number that no word and no other segment has.
    starts, ends = np.array(kept, dtype=np.int64).T
    sizes = ends - starts
    moved = np.cumsum(sizes + 1) - (sizes + 1)
    joined = np.empty(int((sizes + 1).sum()), dtype=np.int64)
    top = int(words.max()) + 1
    for i, (begin, end) in enumerate(kept):
        joined[moved[i] : moved[i] + end - begin] = words[begin:end]
        joined[moved[i] + end - begin] = top + i
    rows = scan(joined, int(sizes.max()))
    start, end, period = rows.T
    start = start + (starts - moved)[np.searchsorted(moved, start, side="right") - 1]
    length = end - rows[:, 0]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def kept_words(n: int, found: Runs) -> np.ndarray:
    """Which of n words stay when every run is cut down to its first period."""
    start, length, period = found
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    return np.cumsum(edges[:-1]) == 0


# --- the operator ---------------------------------------------------------------------------------


def periodic_runs(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """One row per document: doc_id, ``n_words``, ``runs`` (start, length, period by start, then period) and ``collapsed``.

    ``collapsed`` is the text's words joined by one blank, every run cut down to its first period. ``text`` is another
    expression for the text than the column of that name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            sizes, lists, left = [], [], []
            for text in batch.column(1).to_pylist():
                numbers = Numbering()
                words = numbers.of(text)
                found = runs(words)
                names = np.array(list(numbers), dtype=object)
                sizes.append(words.size)
                lists.append(found)
                left.append(" ".join(names[words[kept_words(words.size, found)] if found[0].size else words]))
            offsets = np.cumsum([0, *(f[0].size for f in lists)])
            fields = [np.concatenate([f[i] for f in lists]) if lists else np.zeros(0, np.int64) for i in range(3)]
            structs = pa.StructArray.from_arrays([pa.array(f) for f in fields], fields=list(RUN))
            spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), spans, pa.array(left, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"]
            )

    own = named("text").cast("string") if text is None else text
    rows = docs.select(named("doc_id").cast("bigint").alias("doc_id"), F.coalesce(own, F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
