"""The Kneser-Ney classifier against a plain implementation, and its decisions on the sample."""

import math
import random
import re
from collections import Counter, defaultdict

import cases
import pytest

from meterline.llm import quality
from meterline.llm.common import FILE, POS, ROW, with_row_key

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


class Plain:
    """Interpolated modified Kneser-Ney over characters, with dictionaries."""

    def __init__(self, texts, order=4):
        self.order = order
        fold = lambda t: tuple(min(ord(c), 0xFFFF) for c in t)
        top = Counter(fold(t)[i : i + order] for t in texts for i in range(len(t) - order + 1))
        self.counts = {order: top}
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.uniform = 1 / (len(self.counts[1]) + 1)
        self.off, self.sums, self.weight = {}, {}, {}
        for n, table in self.counts.items():
            d = quality.discounts(Counter(table.values()))
            self.off[n] = lambda c, d=d: d[min(c, 3) - 1]
            self.sums[n], taken = Counter(), defaultdict(float)
            for g, c in table.items():
                self.sums[n][g[:-1]] += c
                taken[g[:-1]] += self.off[n](c)
            self.weight[n] = {x: t / self.sums[n][x] for x, t in taken.items()}

    def p(self, gram):
        n = len(gram)
        if n == 0:
            return self.uniform
        lower = self.p(gram[1:])
        ctx = gram[:-1]
        if ctx not in self.sums[n]:
            return lower
        c = self.counts[n].get(gram, 0)
        own = max(c - self.off[n](c), 0) / self.sums[n][ctx] if c else 0.0
        return max(own + self.weight[n][ctx] * lower, 1e-300)

    def log_perplexity(self, text):
        codes = [min(ord(c), 0xFFFF) for c in text or ""]
        grams = [tuple(codes[i : i + self.order]) for i in range(len(codes) - self.order + 1)]
        return -sum(math.log(self.p(g)) for g in grams) / len(grams) if grams else None


TRUSTED = [cases.prose(i, 60) for i in range(12)] + ["ünïcödé 😀😀 漢字 text", "", "abc"]


@pytest.mark.parametrize("frequent", [0, 40, 1 << 17])
def test_perplexities_equal_brute_force(spark, frequent):
    plain = Plain(TRUSTED)
    model = quality.fit(spark.createDataFrame([(t,) for t in TRUSTED], "text string"))
    docs = cases.messy(spark)
    keyed = with_row_key(docs)
    scored = keyed.join(quality.perplexities(keyed, model, frequent), ROW).collect()
    assert len(scored) == docs.count()
    for r in scored:
        want = plain.log_perplexity(r.text)
        if want is None:
            assert r.log_perplexity is None and r.n == 0
        else:
            assert r.n == len(r.text) - 3 and abs(r.log_perplexity - want) < 1e-9 * max(1, abs(want))


def test_probabilities_add_up(spark):
    plain = Plain(TRUSTED)
    symbols = [g[0] for g in plain.counts[1]]
    for ctx in [tuple(map(ord, "the")), tuple(map(ord, "qu ")), (1, 2, 3)]:
        total = sum(plain.p((*ctx, s)) for s in symbols) + plain.p((*ctx, 12345))
        assert abs(total - 1) < 1e-9


def test_grams_in_slices(monkeypatch):
    text = cases.prose(3, 300)
    whole = [g for part in quality.grams(text) for g in part.tolist()]
    monkeypatch.setattr(quality, "SLICE", 50)
    assert [g for part in quality.grams(text) for g in part.tolist()] == whole
    assert len(whole) == len(text) - 3


def test_discounts():
    assert quality.discounts({}) == (0.0, 0.0, 0.0)
    d = quality.discounts({1: 100, 2: 40, 3: 20, 4: 12})
    y = 100 / 180
    assert d == pytest.approx((1 - 2 * y * 0.4, 2 - 3 * y * 0.5, 3 - 4 * y * 0.6))


def test_decisions_on_the_sample(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.quality_report(docs, labels).collect()}
    marks = {r.doc_id: r for r in labels.collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert got.keys() == texts.keys()
    noisy = re.compile(r"[%&#$*!]{2,}| \| ")
    clean = [d for d, t in texts.items() if not noisy.search(t) and (d not in marks or marks[d].quality == 1)]
    shouted = [d for d, t in texts.items() if len(re.findall(r"[%&#$*!]{2,}", t)) > 0.5 * len(t.split()) > 20]
    assert len(clean) > 500 and sum(not got[d].kept for d in clean) <= 0.01 * len(clean)
    assert len(shouted) > 40 and sum(got[d].kept for d in shouted) <= 0.02 * len(shouted)


def test_keep_good_in_the_columns_of_documents(spark):
    docs = cases.messy(spark)
    labels = spark.createDataFrame([(100 + i, 1, 0) for i in range(40)] + [(1, 1, 1), (2, 0, 0), (2, 1, 0), (None, 1, 0), (3, None, None)], LABELS)
    left = quality.keep_good(docs, labels)
    assert left.columns == docs.columns
    kept = {r.doc_id for r in left.collect()}
    assert {100, 111, 139, 5, 6} <= kept
    report = quality.quality_report(docs, labels)
    assert report.count() == docs.count()
    assert [r.kept for r in report.where("doc_id = 14").collect()] == [14 in kept]
    assert 14 not in kept and 9 not in kept


def test_nothing_trusted_and_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    docs = cases.messy(spark)
    assert quality.keep_good(docs, none).count() == docs.count()
    assert quality.quality_report(cases.empty(spark), none).count() == 0
    assert quality.keep_good(cases.empty(spark), none).count() == 0
    ids = quality.trusted_ids(spark.createDataFrame([(1, 1, None), (2, 1, 0), (2, 0, 0), (3, 1, 1), (4, None, 0)], LABELS))
    assert [r["__id"] for r in ids.collect()] == [1]


def value_at(values, share):
    ordered = sorted(values)
    return ordered[max(math.ceil(share * len(ordered)), 1) - 1] if ordered else None


def drawn(own, n, wider, prior):
    return wider if own is None else (n * own + prior * wider) / (n + prior)


def brute_verdicts(rows, fence):
    """lang, copy, trusted, n, log_perplexity to (score, lowest, highest, kept), by one rule at every size."""
    each = {}
    for lang, copy, trusted, _, lp in rows:
        old = each.get((lang, copy), (False, lp))
        each[lang, copy] = (old[0] or trusted, lp)
    sets = {k: lp for k, (trusted, lp) in each.items() if trusted and lp is not None}
    overall = value_at(sets.values(), 0.5)
    level = {}
    for lang in {r[0] for r in rows}:
        mine = [lp for (x, _), lp in sets.items() if x == lang]
        whole = [lp for (x, _), (_, lp) in each.items() if x == lang and lp is not None]
        level[lang] = drawn(value_at(mine, 0.5), len(mine), drawn(value_at(whole, 0.5), len(whole), overall, 30), 30)
    score = [None if lp is None else (lp - level[lang]) / math.sqrt(1 / n + 1 / 5000) for lang, _, _, n, lp in rows]
    scores = {(r[0], r[1]): s for r, s in zip(rows, score) if (r[0], r[1]) in sets}
    out = []
    for (lang, *_), s in zip(rows, score):
        mine = [x for (of, _), x in scores.items() if of == lang]
        low, high = (drawn(value_at(mine, q), len(mine), value_at(scores.values(), q), 100) for q in quality.QUANTILES)
        low, high = low - fence * (high - low), high + fence * (high - low)
        out.append((s, low, high, s is None or low <= s <= high))
    return out


@pytest.mark.parametrize("fence", [0.0, 1.0])
def test_verdicts_equal_brute_force(spark, fence):
    r = random.Random(5)
    rows = []
    for lang, size, middle in (("en", 400, 1.5), ("de", 40, 1.9), ("fr", 3, 2.4), (None, 5, 1.0), ("none trusted", 6, 3.0)):
        for i in range(size):
            n = r.choice([1, 5, 60, 900, 20_000])
            text = (lang, i, lang != "none trusted" and r.random() < 0.5, n, None if r.random() < 0.05 else middle + r.gauss(0, 1) * math.sqrt(1 / n + 1 / 5000))
            rows += [text] * r.choice([1, 1, 1, 4])
    want = brute_verdicts(rows, fence)
    table = [(1, i, i, lang, copy, trusted, i % 50 == 0, n, lp) for i, (lang, copy, trusted, n, lp) in enumerate(rows)]
    df = spark.createDataFrame(table, f"{FILE} long, {POS} long, doc_id long, lang string, copy long, trusted boolean, learned boolean, n long, log_perplexity double")
    got = {x.doc_id: x for x in quality.judged(df, fence=fence).collect()}
    assert len(got) == len(rows) and (fence > 0 or any(not w[3] for w in want))
    for i, (score, low, high, kept) in enumerate(want):
        have = got[i]
        assert (have.score is None) == (score is None) and (score is None or have.score == pytest.approx(score, rel=1e-9, abs=1e-9))
        assert (have.lowest, have.highest) == (pytest.approx(low, rel=1e-9), pytest.approx(high, rel=1e-9))
        assert have.kept == (kept or i % 50 == 0)


def test_a_language_that_grows_has_no_step(spark):
    """One text more moves the limits a little at any size: no count switches the rule."""
    r = random.Random(2)
    big = [("en", i, True, 1000, r.gauss(1.5, 0.03)) for i in range(1500)]
    small = [("de", i, True, 1000, r.gauss(1.9, 0.06)) for i in range(700)]
    for size in (1, 2, 28, 31, 99, 101, 498, 502, 650):
        a, b = (brute_verdicts([*big, *small[:k]], 1.0)[-1] for k in (size, size + 1))
        assert abs(a[1] - b[1]) < 0.2 * abs(a[1]) and abs(a[2] - b[2]) < 0.2 * abs(a[2])
