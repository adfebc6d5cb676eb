"""Language identification: multinomial naive Bayes over hashed character n-grams.

Fitting counts the n-grams of all learnable documents. Each task adds its texts up in one dense row of
``BUCKETS`` counts per language and hands on the filled cells; Spark sums them. The matrix of log probabilities
has ``languages x BUCKETS`` cells; its size is checked against ``MATRIX_CELLS`` before it is broadcast, and languages
beyond that are scored in further passes of as many rows as fit, the best one of all passes winning. Scoring
gathers the sparse rows of a whole batch in numpy.

An n-gram is 1 to 3 characters of the lower-cased text in which every run of other characters than letters
is one blank; its code points are hashed to a bucket. None crosses the end of a slice of ``SLICE`` characters, in
which texts are read whole: very long ones need bounded memory.

Defined cases. Null text, or text without a letter, is ``und`` with score 0; so is every text when nothing can be
learned. Ties go to the language first by code point. Learning leaves out rows with null lang, null text or a null doc_id,
whose remainder is unknown; such a doc_id counts as not held out. Repeated rows count as often as they come.
Other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import stored

BUCKETS = 1 << 15
ORDERS = 3
SMOOTHING = 0.5
SLICE = 1 << 20
MATRIX_CELLS = 1 << 22
UNKNOWN = "und"

_MADE: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """For every code point whether it is a letter; made once per task."""
    if "letters" not in _MADE:
        _MADE["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _MADE["letters"]


def _mixed(codes: np.ndarray) -> np.ndarray:
    """Bucket of each hashed n-gram."""
    return (codes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts, the place of the text of each, and whether each text has a letter."""
    plain = np.frombuffer(" ".join(["", *texts, ""]).lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if len(plain) != sum(map(len, texts)) + len(texts) + 1:  # lower case of some letters is longer
        texts = [t.lower() for t in texts]
        plain = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    owner = np.repeat(np.arange(len(texts) + 1), [len(t) + 1 for t in texts] + [1])
    letter = _letters()[plain]
    seen = np.bincount(owner[letter], minlength=len(texts) + 1)[:-1] > 0
    keep = letter | np.r_[False, letter[:-1]]  # of each run of other characters the first stays, as a blank
    keep |= np.r_[True, owner[1:] != owner[:-1]]
    codes = np.where(letter, plain, 32).astype(np.uint64)[keep]
    owner = owner[keep]
    buckets, owners = [], []
    hashed = np.zeros_like(codes)
    for order in range(ORDERS):
        n = max(codes.size - order, 0)
        hashed = hashed[:n] * np.uint64(0x110001) + codes[order:]
        inside = (owner[:n] == owner[order:]) & (owner[:n] < len(texts))
        if order == 0:
            inside &= codes != 32
        buckets.append(_mixed(hashed[inside] * np.uint64(4) + np.uint64(order)))
        owners.append(owner[:n][inside])
    return np.concatenate(buckets), np.concatenate(owners), seen


def _sliced(texts: list[str | None]) -> Iterator[tuple[list[str], list[int]]]:
    """Texts and their places in lots of about ``SLICE`` characters, longer texts in several slices."""
    lot, places, size = [], [], 0
    for place, text in enumerate(texts):
        for start in range(0, max(len(text or ""), 1), SLICE):
            part = (text or "")[start : start + SLICE]
            lot.append(part)
            places.append(place)
            size += len(part)
            if size >= SLICE:
                yield lot, places
                lot, places, size = [], [], 0
    if lot:
        yield lot, places


def _held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filled cells ``lang, bucket, n`` of one task; bucket -1 counts the documents."""
    held: dict[str, np.ndarray] = {}

    def cells() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            filled = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * filled.size), pa.array(filled - 1), pa.array(counts[filled])], names=["lang", "bucket", "n"]
            )

    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in langs:
            held.setdefault(lang, np.zeros(BUCKETS + 1, dtype=np.int64))[0] += 1
        names = list(dict.fromkeys(langs))
        code = np.array([names.index(x) for x in langs]) if len(names) < 64 else np.unique(langs, return_inverse=True)[1]
        names = names if len(names) < 64 else sorted(set(langs))
        for lot, places in _sliced(texts):
            buckets, owners, _ = grams(lot)
            of = code[np.array(places)][owners]
            for i in np.unique(of):
                held[names[i]][1:] += np.bincount(buckets[of == i], minlength=BUCKETS)
        if len(held) * BUCKETS > MATRIX_CELLS:
            yield from cells()
            held.clear()
    yield from cells()


def fit(docs: DataFrame) -> DataFrame:
    """Counts ``lang, bucket, n`` over every learnable document."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~_held_out())
    cells = known.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counted = cells.mapInArrow(_count, "lang string, bucket long, n long")
    return stored(counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")


def matrices(counts: DataFrame) -> Iterator[tuple[list[str], np.ndarray]]:
    """Languages in code point order with their log probabilities (last column: prior), a bounded number at a time."""
    total = counts.where("bucket = -1").agg(F.sum("n").alias("n")).first()["n"]
    langs = counts.where("bucket = -1").select("lang", "n").orderBy("lang")
    at_once = max(1, MATRIX_CELLS // BUCKETS)
    lot: list[tuple[str, int]] = []
    for row in langs.toLocalIterator():
        lot.append((row["lang"], row["n"]))
        if len(lot) == at_once:
            yield _matrix(counts, lot, total)
            lot = []
    if lot:
        yield _matrix(counts, lot, total)


def _matrix(counts: DataFrame, lot: list[tuple[str, int]], total: int) -> tuple[list[str], np.ndarray]:
    names = [name for name, _ in lot]
    place = {name: i for i, name in enumerate(names)}
    cells = np.full((len(names), BUCKETS), SMOOTHING)
    inside = counts.where((F.col("bucket") >= 0) & F.col("lang").between(names[0], names[-1])).toArrow()
    rows = np.array([place[x] for x in inside["lang"].to_pylist()], dtype=np.int64)
    np.add.at(cells, (rows, inside["bucket"].to_numpy()), inside["n"].to_numpy())
    logs = np.log(cells / cells.sum(axis=1, keepdims=True))
    priors = np.log(np.array([n for _, n in lot]) / total)
    return names, np.column_stack([logs, priors]).astype(np.float32)


def _scores(texts: list[str | None], matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood of each text in each language, and whether it has a letter."""
    found = np.tile(matrix[:, -1].astype(np.float64), (len(texts), 1))
    letters = np.zeros(len(texts), dtype=bool)
    for lot, places in _sliced(texts):
        buckets, owners, seen = grams(lot)
        at = np.array(places)
        letters[at[seen]] = True
        owner = at[owners]
        for lang, logs in enumerate(matrix):
            found[:, lang] += np.bincount(owner, weights=logs[buckets], minlength=len(texts))
    return found, letters


def identify(docs: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (probability of the predicted language)."""
    spark = docs.sparkSession
    counts = fit(docs) if counts is None else counts
    models = [(names, spark.sparkContext.broadcast(matrix)) for names, matrix in matrices(counts)]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            n = len(texts)
            best, top, mass = np.full(n, None, dtype=object), np.full(n, -np.inf), np.zeros(n)
            letters = np.zeros(n, dtype=bool)
            for names, held in models:
                found, letters = _scores(texts, held.value)
                winner = found.argmax(axis=1)
                highest = found[np.arange(n), winner]
                peak = np.maximum(top, highest)
                mass = mass * np.exp(top - peak) + np.exp(found - peak[:, None]).sum(axis=1)
                better = highest > top
                best[better] = np.array(names, dtype=object)[winner[better]]
                top = peak
            known = letters & (mass > 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([b if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                    pa.array(np.where(known, 1 / np.where(known, mass, 1), 0.0)),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")
