"""Tokeniser fertility: base counts, measures and bands against brute force."""

import base64
import math
import random
import re
import unicodedata
from collections import Counter

import cases
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from meterline.llm import fertility, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATHS = [public_tokenizers.path(name) for name in queries.FERTILITY_VOCABULARIES]
SF = "/root/testdata/sf0.01"


def encoders():
    out = []
    for path in PATHS[:2]:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        whole = lambda t, c=coder: c.decode_single_token_bytes(t).decode("utf-8", "ignore").encode() == c.decode_single_token_bytes(t)
        out.append((lambda w, c=coder: c.encode_ordinary(" " + w), lambda t, f=whole: not f(t)))
    piece = sentencepiece.SentencePieceProcessor(model_file=PATHS[2])
    return [*out, (lambda w: piece.encode(w), lambda t: piece.is_byte(t) or piece.is_unknown(t))]


def base(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    marked = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, sum(x in lines[:i] for i, x in enumerate(lines)), len(marked)


def measures(text, coders):
    words = WORD.findall(text)
    out = []
    for encode, partial in coders:
        tokens = [[t for i in range(0, len(w), 64) for t in encode(w[i : i + 64])] for w in words]
        flat = [t for ts in tokens for t in ts]
        n = len(flat)
        out += [1000 * sum(map(len, words)) // n, 10_000 * sum(map(partial, flat)) // n] if n else [None, None]
        starts = [*range(0, len(words) - 49, 50)]
        if starts and len(words) % 50:
            starts.append(len(words) - 50)
        bits = []
        for s in starts:
            counts = Counter(t for ts in tokens[s : s + 50] for t in ts)
            total = sum(counts.values())
            bits.append(-sum(c / total * math.log2(c / total) for c in counts.values()))
        out.append(1000 * sum(bits) / len(bits) if bits else None)
    return out


def agrees(row, text, coders):
    assert tuple(row[c] for c in fertility.BASE) == base(text)
    names = [f"{m}_{i}" for i in range(3) for m in fertility.MEASURES]
    for name, want in zip(names, measures(text, coders)):
        assert row[name] == want if want is None or not name.startswith("bits") else abs(row[name] - want) <= 0.51, (name, row)


def test_messy_table(spark):
    rows = cases.messy_rows() + [(300, "漢字 かな " * 40 + "\n\n # \nx\n x\nx", None, "a"), (301, "ряд слов " * 30, None, "a"), (302, "1 2 3", None, None)]
    rows = [r for r in rows if r[0] != 8]
    got = fertility.fertility_report(cases.frame(spark, rows), PATHS).collect()
    assert len(got) == len(rows)
    coders = encoders()
    by = {}
    for r in rows:
        by.setdefault(r[0], r)
    for row in got:
        if row.doc_id is not None:
            agrees(row, by[row.doc_id][1] or "", coders)
    bands = {r.doc_id: r.band for r in got}
    assert bands[1] == "language en" and bands[300].startswith("script ") and bands[301] == "script CYRILLIC" and bands[302] == "script None"
    assert fertility.fertility_report(cases.empty(spark), PATHS).count() == 0


def test_script():
    assert unicodedata.name("я").startswith("CYRILLIC")
    assert [fertility.script(t) for t in ("abc я", "", "12", "яab", "яя漢漢")] == ["LATIN", None, None, "LATIN", "CJK"]


def test_words_are_the_same_in_any_lot(spark, monkeypatch):
    df = cases.messy(spark)
    names = [f"{m}_{i}" for i in range(3) for m in fertility.MEASURES]
    whole = sorted(map(str, fertility.measured(df, PATHS).select("doc_id", *fertility.BASE, *names).collect()))
    for name, value in (("LOT_CHARS", 50), ("HELD_WORDS", 3), ("LOT_WINDOWS", 2)):
        monkeypatch.setattr(fertility, name, value)
    assert sorted(map(str, fertility.measured(df, PATHS).select("doc_id", *fertility.BASE, *names).collect())) == whole


@pytest.fixture(scope="module")
def sample(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in queries.QUERIES["op11_tokeniser_fertility"](spark, SF).collect()}
    return {r.doc_id: r for r in docs.collect()}, rows


def test_query_on_the_sample(sample):
    docs, got = sample
    assert got.keys() == docs.keys()
    coders = encoders()
    for doc_id, d in docs.items():
        row = got[doc_id]
        assert tuple(row[c] for c in fertility.BASE) == base(d.text or "")
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
        assert row.kept == (not row.base_failed and row.outside == "")
        if doc_id % 40 == 1:
            agrees(row, d.text or "", coders)


def test_bands_on_the_sample(sample):
    """Limits from quartiles of distinct texts, drawn to those of all texts; clean texts stay, strewn and table-like ones go."""
    docs, got = sample
    names = [f"{m}_{i}" for i in range(3) for m in fertility.MEASURES]
    judged = [r for r in got.values() if not r.base_failed]

    def quartiles(rows, name):
        values = sorted({(docs[r.doc_id].text, r.band): r[name] for r in rows}.values())
        return [values[math.ceil(len(values) * k / 4) - 1] for k in (1, 2, 3)], len(values)

    for name in names:
        kind = name.split("_")[0]
        every, _ = quartiles(judged, name)
        for band in {r.band for r in judged}:
            mine = [r for r in judged if r.band == band]
            own, n = quartiles(mine, name)
            low, middle, high = ((n * a + 50 * b) / (n + 50) for a, b in zip(own, every))
            least = fertility.LEAST_WIDTHS[kind] * middle + (100 if kind == "bytes" else 0)
            reach = fertility.FENCES[kind] * max(high - low, least)
            for r in mine:
                assert (name in r.outside.split(",")) == (not low - reach <= r[name] <= high + reach)
    noisy = re.compile(r"[%&#$*!]{2,}| \| ")
    plain = [r for r in judged if not noisy.search(docs[r.doc_id].text)]
    strewn = [r for r in judged if len(re.findall(r"[%&#$*]{3}", docs[r.doc_id].text)) > 0.5 * r.n_words]
    assert len(plain) > 500 and np.mean([r.kept for r in plain]) > 0.995
    assert len(strewn) > 10 and np.mean([r.kept for r in strewn]) < 0.1


def test_near_copies_do_not_narrow_a_band(spark):
    r = random.Random(5)
    texts = [(i, cases.prose(i, 120), "en", "a") for i in range(60)]
    one = cases.prose(999, 120).split()
    texts += [(100 + i, " ".join([*one[:60], cases.WORDS[i % 20], *one[61:]]), "en", "a") for i in range(200)]
    texts += [(400 + i, texts[0][1], "en", "a") for i in range(300)]
    r.shuffle(texts)
    got = {x.doc_id: x for x in fertility.fertility_report(cases.frame(spark, texts), PATHS).collect()}
    assert sum(not x.kept for x in got.values() if not x.base_failed) == 0
