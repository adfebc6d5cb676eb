"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text, and perplexity thresholds.

The model is over characters, order ``ORDER``. A gram packs four code units of 16 bits in one long number (characters
beyond the basic plane share one symbol), so counts are exact and a context or a suffix is a bit mask away.

Training (all trusted documents, whole texts). Every task counts the grams of its texts; counts are added per gram. Lower
orders count in how many contexts a gram continues. Discounts D1, D2, D3+ of each order come from its counts of counts.
Probabilities are joins of count tables that are sharded by gram, context and suffix:
``p(w | c) = max(n - D(n), 0) / sum(c) + weight(c) * p(w | shorter c)``, down to the uniform distribution.

Scoring (all documents, whole texts). Log probabilities are needed for every gram of every document. The split is that of
heavy hitters: the ``FREQUENT`` most frequent grams, a bounded table, are broadcast, and settle nearly all occurrences in the
scan. Every other gram goes through the sharded joins: (document, gram, count) rows are resolved once per distinct gram
against the count tables, backing off where a gram or a context is unknown, and summed up per document. Nothing is
dropped or approximated: the result is the same for any ``FREQUENT``, also for 0.

Thresholds. Half of the trusted texts, by their hash, train the model; the other half, which it has not seen, sets the limits, each
text once however many copies there are. The log perplexity of n grams scatters around its language's level like ``sqrt(1 / n + 1 / SPREAD)``; a document's score
is its distance from the level in these units. One rule holds at every size: a figure of n texts is drawn towards the figure of a
wider set by ``n / (n + PRIOR)``. The level is the median of the language's limit-setting texts, drawn to the median of all its texts, and that to
the median of the limit-setting texts of all languages (``LEVEL_PRIOR``). The limits come from the ``QUANTILES`` of the language's scores, drawn to those of all
languages (``LIMIT_PRIOR``): ``FENCE`` times the distance of the two quantiles outside of them. A document beyond is rejected. The model learns each
text once, too. What it has learned it can't judge: these texts are trusted, and they and their copies are kept.

Trusted is what ``labels`` calls good and not toxic. Defined cases. A document without ``ORDER`` characters has no
perplexity and is kept, as is everything when nothing is trusted. Null text counts as empty; a null lang is a language of its
own. Rows that repeat a doc_id are scored each; a null doc_id is never trusted. A doc_id that ``labels`` repeats is trusted if
every label of it is good. Texts are read in slices of ``SLICE`` characters that overlap by a context, so none is lost. Other
columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import FILE, POS, ROW, in_slices, named, passes_columns, stored, whole_text, with_row_key, without_rows

ORDER = 4
FREQUENT = 1 << 17
SLICE = 1 << 20
HELD_GRAMS = 1 << 20
QUANTILES = (0.01, 0.99)
FENCE = 1.0
SPREAD = 5000.0
LEVEL_PRIOR = 30
LIMIT_PRIOR = 100
ACCURACY = 100_000
KEYS_BROADCAST = 1 << 21

OTHER = 0xFFFF


# --- grams of texts -------------------------------------------------------------------------------


def grams(text: str) -> Iterator[np.ndarray]:
    """The grams of a text, as signed 64-bit numbers in order, a slice at a time."""
    for start in range(0, max(len(text) - ORDER + 1, 0), SLICE):
        part = text[start : start + SLICE + ORDER - 1]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        codes = np.minimum(codes, OTHER).astype(np.uint64)
        packed = np.zeros(codes.size - ORDER + 1, dtype=np.uint64)
        for i in range(ORDER):
            packed = packed << np.uint64(16) | codes[i : codes.size - ORDER + 1 + i]
        yield packed.view(np.int64)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts per distinct gram of several (grams, counts)."""
    values, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return values, np.bincount(inverse, weights=np.concatenate([p[1] for p in parts]), minlength=values.size).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The gram counts of one task, in lots of bounded size."""

    def out(total: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total[0]), pa.array(total[1])], names=["gram", "n"])

    held: tuple[np.ndarray, np.ndarray] | None = None
    lot: list[np.ndarray] = []
    size = 0

    def folded(held):
        values, counts = np.unique(np.concatenate(lot), return_counts=True)
        return _added([held, (values, counts)]) if held else (values, counts)

    for batch in in_slices(batches):
        for text in batch.column(0).to_pylist():
            for part in grams(text):
                lot.append(part)
                size += part.size
                if size >= SLICE:
                    held, lot[:], size = folded(held), [], 0
                    if held[0].size > HELD_GRAMS:
                        yield out(held)
                        held = None
    if lot:
        held = folded(held)
    if held:
        yield out(held)


# --- the model ------------------------------------------------------------------------------------


def _suffix(order: int) -> Column:
    """The gram without its first symbol; of an ``order``-gram in the low bits."""
    return F.col("gram").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1))


def _context(order: int) -> Column:
    """The gram without its last symbol."""
    return F.shiftrightunsigned("gram", 16).bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1))


@dataclass(frozen=True)
class Model:
    """``seen[k]`` (gram, n, logp) and, for k > 1, ``weights[k]`` (ctx, weight) of grams of k symbols.

    ``unseen`` is the probability of a symbol that was never seen: the empty context's weight, uniformly.
    """

    seen: dict[int, DataFrame]
    weights: dict[int, DataFrame]
    unseen: float
    empty: bool


def discounts(counts_of_counts: dict[int, int]) -> tuple[float, float, float]:
    """D1, D2, D3+ of modified Kneser-Ney, kept inside 0 .. n where counts of counts are too thin."""
    n1, n2, n3, n4 = (counts_of_counts.get(i, 0) for i in (1, 2, 3, 4))
    if not any(counts_of_counts.values()):
        return 0.0, 0.0, 0.0
    if not n1:  # nothing is rare, so there is nothing to estimate from; something is held back for what was never seen
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.0), float(i + 1)) for i, d in enumerate(raw))


def fit(texts: DataFrame) -> Model:
    """The model of all texts (column ``text``)."""
    counted = texts.mapInArrow(_count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = {ORDER: stored(counted, "grams")}
    for order in range(ORDER - 1, 0, -1):
        longer = counts[order + 1].select(_suffix(order + 1).alias("gram"))
        counts[order] = stored(longer.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "grams")
    symbols = counts[1].count()
    uniform = 1 / (symbols + 1)
    seen: dict[int, DataFrame] = {}
    weights: dict[int, DataFrame] = {}
    unseen = uniform
    for order in range(1, ORDER + 1):
        few = counts[order].where("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()
        d1, d2, d3 = discounts({r["n"]: r["c"] for r in few})
        off = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        held = F.greatest(F.col("n") - off, F.lit(0.0))
        if order == 1:  # one context, the empty one
            total = counts[1].agg(F.sum("n").alias("all"), F.sum(off).alias("off")).first()
            unseen = uniform * (total["off"] / total["all"] if symbols else 0.0)
            rows = counts[1].withColumn("p", held / F.lit(float(total["all"] or 1)) + F.lit(unseen))
        else:
            keyed = counts[order].select("gram", "n", _context(order).alias("ctx"), _suffix(order).alias("suffix"))
            sums = keyed.groupBy("ctx").agg(F.sum("n").alias("all"), F.sum(off).alias("off"))
            sums = stored(sums.select("ctx", "all", (F.col("off") / F.col("all")).alias("weight")), "contexts")
            below = seen[order - 1].select(F.col("gram").alias("suffix"), F.exp("logp").alias("lower"))
            rows = keyed.join(sums, "ctx").join(below, "suffix").withColumn("p", held / F.col("all") + F.col("weight") * F.col("lower"))
            weights[order] = sums.select("ctx", "weight")
        seen[order] = stored(rows.select("gram", "n", F.log(F.greatest("p", F.lit(1e-300))).alias("logp")), "probabilities")
    return Model(seen, weights, unseen, symbols == 0)


def resolve(wanted: DataFrame, model: Model) -> DataFrame:
    """``gram, logp`` of each distinct gram of ``wanted``, by sharded joins with the tables of every order."""
    rows = wanted.select("gram", F.col("gram").alias("__at"), F.lit(0.0).alias("__off"), F.lit(None).cast("double").alias("__logp"))
    for order in range(ORDER, 0, -1):
        found = model.seen[order].select(F.col("gram").alias("__at"), F.col("logp").alias("__found"))
        rows = rows.join(found, "__at", "left").withColumn("__logp", F.coalesce("__logp", F.col("__found") + F.col("__off"))).drop("__found")
        if order > 1:
            at = rows.withColumnsRenamed({"gram": "__gram", "__at": "gram"}).withColumn("ctx", _context(order))
            at = at.join(model.weights[order], "ctx", "left")
            # An unknown context passes all its mass on.
            passed = F.log(F.greatest(F.coalesce("weight", F.lit(1.0)), F.lit(1e-300)))
            rows = at.select(F.col("__gram").alias("gram"), _suffix(order).alias("__at"), (F.col("__off") + passed).alias("__off"), "__logp")
    unseen = float(np.log(max(model.unseen, 1e-300)))
    return rows.select("gram", F.coalesce("__logp", F.col("__off") + unseen).alias("logp"))


# --- perplexity -----------------------------------------------------------------------------------


def perplexities(keyed: DataFrame, model: Model, frequent: int = FREQUENT) -> DataFrame:
    """Row key, ``n`` grams and ``log_perplexity`` (null without grams) of every document."""
    spark = keyed.sparkSession
    top = model.seen[ORDER].orderBy(F.col("n").desc(), "gram").limit(frequent).select("gram", "logp").toArrow()
    known, logs = (np.asarray(top[c].combine_chunks()) for c in ("gram", "logp"))
    order = np.argsort(known)
    held = spark.sparkContext.broadcast((known[order], logs[order]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per document one row with gram null (sum of known log probabilities, number of grams), and one per other gram."""
        known, logs = held.value
        for batch in in_slices(batches):
            files, places, texts = (batch.column(i) for i in range(3))
            who, gram, n, total = [], [], [], []
            for i, text in enumerate(texts.to_pylist()):
                count, sum_known, others = 0, 0.0, []
                for part in grams(text):
                    at = np.minimum(np.searchsorted(known, part), max(known.size - 1, 0))
                    hit = known[at] == part if known.size else np.zeros(part.size, dtype=bool)
                    count += part.size
                    sum_known += float(logs[at[hit]].sum()) if known.size else 0.0
                    if not hit.all():
                        values, counts = np.unique(part[~hit], return_counts=True)
                        others.append((values, counts))
                who.append(np.array([i]))
                gram.append(np.zeros(1, dtype=np.int64))
                n.append(np.array([count]))
                total.append(np.array([sum_known]))
                if others:
                    values, counts = _added(others) if len(others) > 1 else others[0]
                    who.append(np.full(values.size, i))
                    gram.append(values)
                    n.append(counts)
                    total.append(np.full(values.size, np.nan))
            rows = np.concatenate(who) if who else np.zeros(0, dtype=np.int64)
            sums = np.concatenate(total) if total else np.zeros(0)
            own = ~np.isnan(sums)
            empty = np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    files.take(pa.array(rows)),
                    places.take(pa.array(rows)),
                    pa.array(np.concatenate(gram) if gram else empty, mask=own),
                    pa.array(np.concatenate(n) if n else empty),
                    pa.array(np.where(own, sums, 0.0)),
                ],
                names=[FILE, POS, "gram", "n", "total"],
            )

    schema = f"{FILE} long, {POS} long, gram long, n long, total double"
    rows = stored(keyed.select(*ROW, whole_text().alias("text")).mapInArrow(score, schema), "scored")
    rest = rows.where(F.col("gram").isNotNull())
    resolved = stored(resolve(rest.select("gram").distinct(), model), "resolved")
    tail = rest.join(resolved, "gram").select(*ROW, F.lit(0).cast("bigint").alias("n"), (F.col("n") * F.col("logp")).alias("total"))
    head = rows.where(F.col("gram").isNull()).select(*ROW, "n", "total")
    summed = head.unionByName(tail).groupBy(*ROW).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return summed.select(*ROW, "n", F.when(F.col("n") > 0, -F.col("total") / F.col("n")).alias("log_perplexity"))


# --- decisions ------------------------------------------------------------------------------------


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The distinct doc_ids that are labelled good and not toxic."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    marked = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("__id"))
    return marked.agg(F.min(F.coalesce(good, F.lit(False))).alias("good")).where("good").select("__id")


def _copy() -> Column:
    """Equal for equal texts."""
    return F.xxhash64(whole_text()).alias("copy")


def _trains() -> Column:
    return F.pmod("copy", F.lit(2)) == 0


def scored(keyed: DataFrame, labels: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """Row key, doc_id, lang, ``trusted`` (sets the limits), ``learned`` (the model was trained on the text), ``n`` and ``log_perplexity``; stored."""
    ids = stored(trusted_ids(labels), "trusted")
    side = F.broadcast(ids) if ids.count() <= KEYS_BROADCAST else ids
    texts = keyed.select(named("doc_id").cast("bigint").alias("__id"), whole_text().alias("text"), _copy())
    texts = texts.where(_trains()).join(side, "__id", "left_semi")
    learned = stored(texts.groupBy("copy").agg(F.min("text").alias("text")), "learned")
    model = fit(learned.select("text"))
    facts = keyed.select(*ROW, named("doc_id").cast("bigint").alias("__id"), named("lang").cast("string").alias("lang"), _copy())
    facts = facts.join(ids.withColumn("trusted", F.lit(True)), "__id", "left")
    facts = facts.join(learned.select("copy", F.lit(True).alias("learned")), "copy", "left")
    sets = F.coalesce(F.col("trusted") & ~_trains(), F.lit(False)).alias("trusted")
    facts = facts.select(*ROW, F.col("__id").alias("doc_id"), "lang", "copy", sets, F.coalesce("learned", F.lit(False)).alias("learned"))
    if model.empty:
        return stored(facts.withColumn("n", F.lit(0).cast("bigint")).withColumn("log_perplexity", F.lit(None).cast("double")), "perplexities")
    return stored(facts.join(perplexities(keyed, model, frequent), ROW), "perplexities")


def _each_text(rows: DataFrame, value: str) -> DataFrame:
    """One row per language and text, so that copies don't outvote the rest; trusted if any copy is."""
    return rows.groupBy("lang", "copy").agg(F.max("trusted").alias("trusted"), F.min(value).alias(value))


def _drawn(own: Column, n: Column, wider: Column, prior: int) -> Column:
    """The figure of n texts, drawn to that of a wider set; the latter alone where n is 0."""
    return F.coalesce((n * own + prior * wider) / (n + prior), wider)


def _level(rows: DataFrame) -> DataFrame:
    """Add ``score``: the distance from the language's level in units of the expected scatter."""
    middle = lambda of: F.percentile_approx(of, 0.5, ACCURACY)
    own = F.when(F.col("trusted"), F.col("log_perplexity"))
    each = _each_text(rows, "log_perplexity")
    levels = each.groupBy("lang").agg(
        F.count(own).alias("support"), F.count("log_perplexity").alias("documents"), middle(own).alias("own"), middle(F.col("log_perplexity")).alias("all")
    )
    overall = F.lit(each.agg(middle(own).alias("level")).first()["level"]).cast("double")  # one number
    level = _drawn(F.col("own"), F.col("support"), _drawn(F.col("all"), F.col("documents"), overall, LEVEL_PRIOR), LEVEL_PRIOR)
    scatter = F.sqrt(1 / F.greatest(F.col("n"), F.lit(1)) + 1 / SPREAD)
    joined = _with_language(rows, levels.select("lang", level.alias("level")))
    return joined.withColumn("score", (F.col("log_perplexity") - F.col("level")) / scatter).drop("level")


def _with_language(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Join facts by language, null being one."""
    name = F.coalesce("lang", F.lit("\0")).alias("__lang")
    return rows.select("*", name).join(facts.select(name, *[c for c in facts.columns if c != "lang"]), "__lang", "left").drop("__lang")


def judged(rows: DataFrame, quantiles=QUANTILES, fence: float = FENCE) -> DataFrame:
    """Add ``score``, ``lowest`` and ``highest`` (limits of the score in the row's language) and ``kept``; stored."""
    scores = stored(_level(rows), "scores")
    sets = _each_text(scores, "score").where(F.col("trusted") & F.col("score").isNotNull())
    cut = F.percentile_approx("score", list(quantiles), ACCURACY).alias("cut")
    everywhere = sets.agg(cut).first()["cut"] or [None, None]  # one row of two numbers
    own = sets.groupBy("lang").agg(F.count(F.lit(1)).alias("support"), cut)
    n = F.coalesce("support", F.lit(0))
    low, high = (_drawn(F.col("cut")[i], n, F.lit(x).cast("double"), LIMIT_PRIOR) for i, x in enumerate(everywhere))
    limits = _with_language(scores, own).withColumn("lowest", low - fence * (high - low)).withColumn("highest", high + fence * (high - low))
    inside = F.col("score").between(F.col("lowest"), F.col("highest"))
    return stored(limits.withColumn("kept", F.col("learned") | F.coalesce(inside, F.lit(True))).drop("cut", "support"), "judged")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, perplexity, score, lowest, highest, kept."""
    rows = judged(scored(with_row_key(docs), labels))
    return rows.select("doc_id", "lang", F.exp("log_perplexity").alias("perplexity"), "score", "lowest", "highest", "kept")


@passes_columns
def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, in the columns of ``docs``."""
    keyed = with_row_key(docs)
    rejected = judged(scored(keyed, labels)).where("not kept").select(*ROW)
    return without_rows(keyed, rejected, docs.columns)
