"""Quality rules by tokeniser fertility: what public vocabularies make of a text, and rejection bands per language or script.

Each vocabulary encodes every word of a text as it stands after a blank (a word of more than ``LONGEST`` code points in
pieces of that length, each as a word), and gives three measures of the text:

- ``chars``: code points per token, in thousandths. Text that the vocabulary doesn't know falls to pieces.
- ``bytes``: byte-fallback share, the tokens that are no whole characters, in ten-thousandths.
- ``bits``: token entropy in thousandths of a bit, the mean over windows of ``WINDOW`` words. All windows have the same
  number of words, and the last one ends with the text, so every word counts and the length of a text doesn't.

Bands. A text belongs to its language or, without one, to the script of most of its letters. The band of a measure lies
around the quartiles of the group: ``FENCES`` times the distance of the quartiles outside of them, a distance of less than
``LEAST_WIDTHS`` of the measure counting as that much, so that many near copies don't make a band narrow. Quartiles are drawn
towards those of all texts by ``n / (n + PRIOR)``, one rule for groups of every size. They are exact: measures are whole
numbers, counted per value, each distinct text that the base rules keep counting once. A document outside a
band is rejected, as is one that the base rules fail: fewer than ``LEAST_WORDS`` words, or more than ``REPEATED`` percent of its
words inside three-word windows that the text has twice.

A task encodes each distinct word once as long as its table holds it. One row of numbers per document is stored; texts are
read once and never shuffled.

Defined cases. Null text has no words, fails and has no measures. Documents without a letter and a language form one group.
Repeated rows and doc_ids are judged each. Texts are read in slices; a very long one costs memory for its distinct words and eight
bytes a word. When no text passes the base rules there are no bands. Other columns are not looked at; an empty table gives an empty result.

The vocabulary files are a parameter, read by the driver and broadcast (about a megabyte each).
"""

from __future__ import annotations

import base64
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import in_slices, named, stored, whole_text
from meterline.llm.words import Numbering

LEAST_WORDS = 50
REPEATED = 50
WINDOW = 50
LONGEST = 64
PRIOR = 50
FENCES = {"chars": 8.0, "bytes": 4.0, "bits": 4.0}
LEAST_WIDTHS = {"chars": 0.025, "bytes": 0.5, "bits": 0.02}
# A share of a few bytes is nobody's fault: the least distance of quartiles of ``bytes`` in ten-thousandths.
LEAST_BYTES = 100

LOT_CHARS = 1 << 21
LOT_WINDOWS = 1 << 13
HELD_WORDS = 1 << 17
HELD_CHARS = 1 << 23

SYMBOLS = "#*$%&|<>"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = ["chars", "bytes", "bits"]


# --- vocabularies ---------------------------------------------------------------------------------


class Vocabulary:
    """Tokens of words, and which tokens are no whole characters. The kind of file is told by its ending."""

    def __init__(self, path: str, data: bytes):
        if path.endswith(".tiktoken"):
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}
            encoding = tiktoken.Encoding("words", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda words: [encoding.encode_ordinary(" " + w) for w in words]
            self.partial = np.zeros(max(ranks.values()) + 1, dtype=bool)
            for token, rank in ranks.items():
                try:
                    token.decode()
                except UnicodeDecodeError:
                    self.partial[rank] = True
        elif path.endswith(".model"):
            model = sentencepiece.SentencePieceProcessor(model_proto=data)
            self.encode = lambda words: model.encode(words, num_threads=1)
            self.partial = np.array([model.is_byte(i) or model.is_unknown(i) for i in range(model.vocab_size())])
        else:
            raise ValueError(f"no vocabulary of a known kind: {path}")


# The split pattern of the rank files.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Tokens:
    """The tokens of numbered words: those of word i are ``flat[start[i] : start[i] + n[i]]``."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.flat = np.zeros(0, np.int64)
        self.start, self.n, self.partial = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, words: list[str]) -> None:
        """Append the tokens of further words."""
        pieces = [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]
        found = self.vocabulary.encode(pieces)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        if len(pieces) != len(words):
            owner = np.repeat(np.arange(len(words)), [-(-len(w) // LONGEST) for w in words])
            sizes = np.bincount(owner, weights=sizes, minlength=len(words)).astype(np.int64)
        flat = np.fromiter((t for tokens in found for t in tokens), np.int64, int(sizes.sum()))
        start = np.cumsum(sizes) - sizes
        cut = np.concatenate([[0], np.cumsum(self.vocabulary.partial[flat])])
        self.partial = np.concatenate([self.partial, cut[start + sizes] - cut[start]])
        self.start = np.concatenate([self.start, start + self.flat.size])
        self.n = np.concatenate([self.n, sizes])
        self.flat = np.concatenate([self.flat, flat])

    def of(self, words: np.ndarray) -> np.ndarray:
        """The tokens of words, one after the other."""
        n = self.n[words]
        skipped = np.cumsum(n) - n
        return self.flat[np.arange(int(n.sum())) + np.repeat(self.start[words] - skipped, n)]


# --- measures of texts ----------------------------------------------------------------------------


def entropies(tokens: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """Entropy in bits of the tokens of each owner."""
    keys = np.sort(owner << 20 | tokens)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if keys.size else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, keys.size))
    of = keys[first] >> 20
    total = np.maximum(np.bincount(of, weights=counts, minlength=owners), 1)
    return np.log2(total) - np.bincount(of, weights=counts * np.log2(counts), minlength=owners) / total


def repeated(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which words stand in a three-word window that their text has twice or more."""
    marked = np.zeros(words.size, dtype=bool)
    first = np.flatnonzero(owner[:-2] == owner[2:]) if words.size > 2 else np.zeros(0, np.int64)
    at = first
    # Windows that repeat begin with pairs that repeat, so the second step looks at those only.
    key = owner[at] << 32 | words[at]
    for step in (1, 2):
        _, rank = np.unique(key, return_inverse=True)
        key = rank << 32 | words[at + step]
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(at.size, dtype=bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        at, key = at[again], key[again]
    for step in range(3):
        marked[at + step] = True
    return marked


def repeated_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def script(text: str) -> str | None:
    """The script of most letters, by the first word of their Unicode names; ties go to the first in the alphabet."""
    seen: Counter[str] = Counter()
    for char, n in Counter(text).items():
        if char.isalpha():
            seen[unicodedata.name(char, "UNKNOWN").split(" ")[0].split("-")[0]] += n
    return min(seen, key=lambda s: (-seen[s], s)) if seen else None


def measure(texts: list[str], numbers: Numbering, tables: list[Tokens]) -> list[np.ndarray]:
    """The base counts and, per vocabulary, the three measures of a lot of texts; -1 where there is none."""
    known = len(numbers)
    words = [numbers.of(t) for t in texts]
    fresh = list(islice(numbers, known, None))
    numbers.chars = np.concatenate([numbers.chars, np.fromiter(map(len, fresh), np.int64, len(fresh))])
    for table in tables:
        table.add(fresh)
    n = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.concatenate(words) if words else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(n.size), n)
    chars = np.bincount(owner, weights=numbers.chars[flat], minlength=n.size).astype(np.int64)
    symbols = [sum(map(t.count, SYMBOLS)) for t in texts]
    again = np.bincount(owner, weights=repeated(flat, owner), minlength=n.size).astype(np.int64)
    out = [n, chars, np.array(symbols, np.int64), np.fromiter(map(repeated_lines, texts), np.int64, n.size), again]

    begin = np.cumsum(n) - n
    windows = np.where(n >= WINDOW, -(-n // WINDOW), 0)
    of = np.repeat(np.arange(n.size), windows)
    place = np.arange(of.size) - np.repeat(np.cumsum(windows) - windows, windows)
    start = begin[of] + np.minimum(place * WINDOW, n[of] - WINDOW)
    for table in tables:
        tokens = np.bincount(owner, weights=table.n[flat], minlength=n.size).astype(np.int64)
        partial = np.bincount(owner, weights=table.partial[flat], minlength=n.size).astype(np.int64)
        bits = np.zeros(of.size)
        for lo in range(0, of.size, LOT_WINDOWS):
            part = start[lo : lo + LOT_WINDOWS]
            inside = flat[(part[:, None] + np.arange(WINDOW)).ravel()]
            window = np.repeat(np.repeat(np.arange(part.size), WINDOW), table.n[inside])
            bits[lo : lo + part.size] = entropies(table.of(inside), window, part.size)
        mean = np.bincount(of, weights=bits, minlength=n.size) / np.maximum(windows, 1)
        some = np.maximum(tokens, 1)
        out += [np.where(tokens > 0, 1000 * chars // some, -1), np.where(tokens > 0, 10_000 * partial // some, -1)]
        out.append(np.where(windows > 0, np.rint(1000 * mean), -1).astype(np.int64))
    return out


def measured(docs: DataFrame, paths: list[str]) -> DataFrame:
    """doc_id, ``band`` (the group), ``copy`` (equal for equal texts), the base counts and ``chars_i, bytes_i, bits_i``; stored."""
    spark = docs.sparkSession
    files = []
    for path in paths:
        with open(path, "rb") as f:
            files.append((path, f.read()))
    held = spark.sparkContext.broadcast(files)
    columns = [*BASE, *(f"{m}_{i}" for i in range(len(paths)) for m in MEASURES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [Tokens(Vocabulary(path, data)) for path, data in held.value]

        def forget() -> Numbering:
            fresh = Numbering()
            fresh.chars = np.zeros(0, np.int64)
            for table in tables:
                table.clear()
            return fresh

        numbers = forget()
        for batch in in_slices(batches):
            texts = batch.column(3).to_pylist()
            begun = 0
            while begun < len(texts):
                end, size = begun + 1, len(texts[begun])
                while end < len(texts) and size + len(texts[end]) <= LOT_CHARS:
                    size += len(texts[end])
                    end += 1
                lot = texts[begun:end]
                found = measure(lot, numbers, tables)
                langs = batch.column(1).slice(begun, end - begun).to_pylist()
                bands = [f"script {script(t)}" if lang is None else f"language {lang}" for lang, t in zip(langs, lot)]
                rest = [batch.column(i).slice(begun, end - begun) for i in (0, 2)]
                yield pa.RecordBatch.from_arrays([rest[0], pa.array(bands), rest[1], *map(pa.array, found)], names=["doc_id", "band", "copy", *columns])
                if len(numbers) > HELD_WORDS or numbers.chars.sum() > HELD_CHARS:
                    numbers = forget()
                begun = end

    rows = docs.select(
        named("doc_id").cast("bigint").alias("doc_id"),
        named("lang").cast("string").alias("lang"),
        F.xxhash64(whole_text()).alias("copy"),
        whole_text().alias("text"),
    )
    schema = ", ".join(["doc_id long", "band string", "copy long", *(f"{c} long" for c in columns)])
    return stored(rows.mapInArrow(run, schema), "measured")


# --- bands ----------------------------------------------------------------------------------------


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))


def _quartiles(counts: DataFrame, by: list[str]) -> DataFrame:
    """``n`` and the quartiles ``q`` of the counted values of each group: the least values that reach 1, 2 and 3 quarters."""
    so_far = Window.partitionBy(*by).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*by)
    summed = counts.withColumn("below", F.sum("n").over(so_far)).withColumn("all", F.sum("n").over(whole))
    cut = lambda k: F.min(F.when(4 * F.col("below") >= k * F.col("all"), F.col("value")))
    return summed.where("n > 0").groupBy(*by).agg(F.max("all").alias("n"), F.array(*[cut(k) for k in (1, 2, 3)]).alias("q"))


def bands(rows: DataFrame, vocabularies: int) -> DataFrame:
    """``band`` and ``limits`` (measure to low and high) of every group of the measured rows; stored."""
    names = [f"{m}_{i}" for i in range(vocabularies) for m in MEASURES]
    each = rows.groupBy("band", "copy").agg(F.max((~base_failed()).cast("bigint")).alias("n"), *[F.min(c).alias(c) for c in names])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("value")) for c in names])).alias("m")
    counts = each.select("band", "n", pairs).groupBy("band", "m.measure", "m.value").agg(F.sum("n").alias("n"))
    counts = stored(counts, "measure-counts")
    own = _quartiles(counts, ["band", "measure"])
    every = _quartiles(counts.groupBy("measure", "value").agg(F.sum("n").alias("n")), ["measure"])
    groups = counts.select("band", "measure").distinct().join(own, ["band", "measure"], "left")
    both = groups.join(every.select("measure", F.col("q").alias("every")), "measure", "left")
    n = F.coalesce("n", F.lit(0))
    drawn = lambda i: (n * F.coalesce(F.col("q")[i], F.col("every")[i]) + PRIOR * F.col("every")[i]) / (n + PRIOR)
    kind = F.split("measure", "_")[0]
    pick = lambda table: F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), kind)
    least = pick(LEAST_WIDTHS) * F.col("middle") + F.when(kind == "bytes", LEAST_BYTES).otherwise(0)
    wide = both.select("band", "measure", drawn(0).alias("low"), drawn(1).alias("middle"), drawn(2).alias("high"))
    wide = wide.withColumn("reach", pick(FENCES) * F.greatest(F.col("high") - F.col("low"), least))
    entry = F.struct("measure", F.struct((F.col("low") - F.col("reach")).alias("low"), (F.col("high") + F.col("reach")).alias("high")))
    # One entry per measure of a vocabulary.
    limits = wide.where(F.col("reach").isNotNull()).groupBy("band").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("limits"))
    return stored(limits, "bands")


def fertility_report(docs: DataFrame, paths: list[str]) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept, ``outside`` (measures beyond their bands), band and measures."""
    rows = measured(docs, paths)
    names = [f"{m}_{i}" for i in range(len(paths)) for m in MEASURES]
    found = rows.join(bands(rows, len(paths)), "band", "left").withColumn("base_failed", base_failed())
    beyond = lambda c: ~F.col(c).between(F.col("limits")[c]["low"], F.col("limits")[c]["high"])
    outside = F.concat_ws(",", *[F.when((F.col(c) >= 0) & beyond(c), F.lit(c)) for c in names])
    found = found.withColumn("outside", outside)
    own = [F.when(F.col(c) >= 0, F.col(c)).alias(c) for c in names]
    return found.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & (F.col("outside") == "")).alias("kept"), "outside", "band", *own)
