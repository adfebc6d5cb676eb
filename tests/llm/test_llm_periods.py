"""Periodic runs against brute force."""

import hashlib
import random
import re
import time
import zlib

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import periods, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """Every maximal stretch at every lag; of equal stretches the least lag is the period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(12, 2 * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


@pytest.mark.parametrize("block, many", [(2, 1), (1024, 64)])
def test_runs_equal_brute_force(monkeypatch, block, many):
    monkeypatch.setattr(periods, "BLOCK", block)
    monkeypatch.setattr(periods, "MANY", many)
    r = random.Random(block)
    for _ in range(1500):
        n, kinds = r.randint(0, 70), r.choice([1, 2, 3, 5, 20, 60])
        words = [r.randrange(kinds) for _ in range(n)]
        if n and r.random() < 0.6:
            a = r.randrange(n)
            p = 1 + (n - a) // r.randint(2, 9)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            if r.random() < 0.4:
                words[r.randrange(n)] = 99
        found = periods.runs(np.array(words, dtype=np.int64))
        got = list(zip(*(x.tolist() for x in found)))
        assert got == brute(words)
        left = np.array(words, dtype=object)[periods.kept_words(n, found)] if n else []
        assert " ".join(map(str, left)) == collapsed(list(map(str, words)), got)


def test_hits_in_lots(monkeypatch):
    monkeypatch.setattr(periods, "HITS", 10)
    words = [0] * 40 + list(range(5)) * 9 + [7, 8] * 20
    found = periods.runs(np.array(words, dtype=np.int64))
    assert list(zip(*(x.tolist() for x in found))) == brute(words)


def test_pieces_that_fall_apart_step_by_step():
    # each lonely word frees the next one: the recursion is as deep as the text is long
    words = [x for i in range(3000) for x in (*range(10_000_000 + 11 * i, 10_000_000 + 11 * i + 11), i, i + 1)]
    begun = time.time()
    assert periods.segments(np.array(words, dtype=np.int64)) == []
    assert time.time() - begun < 20


def test_long_texts():
    for words in (np.zeros(200_000, np.int64), np.arange(300_000) % 99_000, np.random.default_rng(1).integers(0, 500, 300_000)):
        begun = time.time()
        start, length, period = periods.runs(words)
        assert time.time() - begun < 60
        if words[0] == 0 and words[1] in (0, 1):
            assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [words.size], [1 if words[1] == 0 else 99_000])


def test_messy_table(spark):
    rows = cases.messy_rows() + [(200, "a b " * 500, "en", "a"), (201, "la " * 12, None, None), (202, "la " * 11, None, None)]
    long = max((r[1] or "" for r in rows if r[0] == 8), key=len)
    got = periods.periodic_runs(cases.frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted(((str(r[0]), (w := WORD.findall(r[1] or "")), brute(w)) for r in rows if len(r[1] or "") != len(long)), key=str)
    have = [(str(g.doc_id), g.collapsed, [tuple(x) for x in g.runs]) for g in got if g.n_words < 20_000]
    assert sorted(have, key=str) == sorted([(i, collapsed(w, f), f) for i, w, f in want], key=str)
    assert periods.periodic_runs(cases.empty(spark)).count() == 0


def test_query_on_the_sample(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.QUERIES["op12_periodic_runs"](spark, sf).collect()}
    assert got.keys() == docs.keys()
    checked = 0
    for doc_id, text in docs.items():
        words = planted(doc_id, WORD.findall(text or ""))
        if len(words) > 600:
            continue
        checked += 1
        found, row = brute(words), got[doc_id]
        assert row.n_runs == len(found)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, found).encode()).hexdigest()
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        assert (row.start, row.length, row.period) == best
        assert row.exponent_milli == (1000 * best[1] // best[2] if found else None)
    assert checked > 700 and sum(r.n_runs > 0 for r in got.values()) > 100


def test_null_ids_keep_their_text(spark):
    df = spark.createDataFrame([(None, "a b"), (7, None), (8, " \n")], "doc_id long, text string")
    assert [r.t for r in df.select(queries.with_planted_period().alias("t")).collect()][0] == "a b"
    assert df.select(F.max(F.length(queries.with_planted_period()))).first()[0] == 3
