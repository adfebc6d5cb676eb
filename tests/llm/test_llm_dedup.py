"""Exact dedup, SimHash near-dedup and components against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest
import xxhash

from meterline.llm import components, exact_dedup, simhash

ASCII_BLANK = re.compile("[\x20\x09-\x0d]+")


def plain(text):
    return ASCII_BLANK.sub("", text or "")


@pytest.mark.parametrize("counters", [1, 3, 1023])
def test_exact_dedup_equals_brute_force(spark, counters):
    rows = cases.messy_rows()
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[plain(text)].append((-len(text or ""), doc_id is None, doc_id))
    want = []
    for doc_id, text, *_ in rows:
        group = groups[plain(text)]
        best = min(group, key=lambda g: (g[0], g[1], g[2] or 0))
        want.append((doc_id, best[2], len(group), hashlib.sha256(plain(text).encode()).hexdigest()))
    got = exact_dedup.exact_dedup(cases.messy(spark), counters).collect()
    key = lambda t: tuple((v is None, str(v)) for v in t)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == sorted(want, key=key)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_drop_copies_keeps_columns_and_one_of_each(spark):
    docs = cases.messy(spark)
    left = exact_dedup.drop_copies(docs, 2)
    assert left.columns == docs.columns
    own = left.select("__row_file", "__Row_Pos", "__text", "__words", "given__words").distinct().collect()
    assert [tuple(r) for r in own] == [("f", -1, 7, "w", "g")]
    texts = [plain(r.text) for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({plain(t) for _, t, *_ in cases.messy_rows()})


def test_misra_gries_keeps_what_is_frequent():
    import pyarrow as pa

    r = random.Random(3)
    values = [b"hot"] * 400 + [b"warm"] * 300 + [str(r.randrange(500)).encode() for _ in range(600)]
    r.shuffle(values)
    batches = [pa.RecordBatch.from_arrays([pa.array(values[i : i + 100], pa.binary())], names=["d"]) for i in range(0, 1300, 100)]
    (out,) = exact_dedup.misra_gries(iter(batches), 9)
    held = dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist()))
    assert len(held) <= 9
    for value, true in ((b"hot", 400), (b"warm", 300)):
        assert true - 1300 / 10 <= held[value] <= true


def test_empty_tables(spark):
    docs = cases.empty(spark)
    assert exact_dedup.exact_dedup(docs).count() == 0
    assert exact_dedup.drop_copies(docs).count() == 0
    assert simhash.simhash_classes(docs).count() == 0
    assert simhash.drop_near_copies(docs).count() == 0


# --- SimHash --------------------------------------------------------------------------------------


def naive_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in ASCII_BLANK.split(lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps):
    """Smallest index reachable over links of at most two bits."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def cloud(seed, centers, members, flips):
    r = random.Random(seed)
    out = []
    for _ in range(centers):
        c = r.getrandbits(64)
        out += [c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, flips))) for _ in range(members)]
    return out + [0, 1, 3, 7, 15, (1 << 64) - 1, (1 << 63), r.getrandbits(64)]


def test_fingerprint_equals_naive():
    for _, text, *_ in cases.messy_rows():
        assert simhash.fingerprint((text or "").encode()) == naive_fingerprint(text)


def test_fingerprint_in_slices(monkeypatch):
    text = cases.prose(9, 500)
    monkeypatch.setattr(simhash, "SLICE", 7)
    assert simhash.fingerprint(text.encode()) == naive_fingerprint(text)


def test_hash_is_sparks(spark):
    value = spark.sql("SELECT xxhash64('ab c d') AS h").first().h
    assert value % (1 << 64) == xxhash.xxh64_intdigest(b"ab c d", 42)


@pytest.mark.parametrize("seed", range(6))
def test_node_links_equal_brute_force(seed):
    fps = sorted(set(cloud(seed, 3, 60, 4)))
    u, v = simhash.node_links(np.array(fps, dtype=np.uint64), at_once=17)
    assert all(int(a) in fps and int(b) in fps for a, b in zip(u, v))
    want = classes(fps)
    place = {f: i for i, f in enumerate(fps)}
    root = list(range(len(fps)))
    for a, b in zip(u, v):
        root[place[int(a)]] = place[int(b)]
    flat = lambda i: i if root[i] == i else flat(root[i])
    got = [flat(i) for i in range(len(fps))]
    assert len({(a, b) for a, b in zip(want, got)}) == len(set(want)) == len(set(got))


def test_search_finds_every_near_pair():
    codes = np.array(sorted(set(cloud(11, 4, 50, 3))), dtype=np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    who, at = simhash.search(codes, codes, 2)
    want = {(i, j) for i in range(codes.size) for j in range(codes.size) if int(codes[i] ^ codes[j]).bit_count() <= 2}
    assert set(zip(who.tolist(), at.tolist())) == want


def test_submasks_cover_the_free_bits():
    for mask in (0, 0xFF, 0xFFFF_FFFF_0000_0000):
        added = [m & ~mask for m in simhash.submasks(mask)]
        assert sum(a.bit_count() for a in added) == 64 - mask.bit_count()
        assert added[0] & added[1] == added[1] & added[2] == 0


@pytest.mark.parametrize("node_rows", [40, 2048])
def test_links_through_split_nodes(spark, node_rows):
    fps = sorted(set(cloud(5, 2, 120, 3)))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    distinct = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = simhash.near_links(distinct, node_rows=node_rows)
    roots = {r.node: r.root for r in components.components(links).collect()}
    got = [roots.get(f, f) for f in signed]
    want = classes(fps)
    assert len({(a, b) for a, b in zip(want, got)}) == len(set(want)) == len(set(got))


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(30)] + [(7, 7), (300, 301), (301, 300), (-9, -3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(1, 61)} | {200 + i: 100 for i in range(30)} | {301: 300, -3: -9}
    assert got == want


def test_classes_of_messy_documents(spark):
    rows = cases.messy_rows()
    extra = [(500 + i, cases.prose(7, 400).replace(" ", "  ") + (" end" if i % 2 else ""), "en", "a") for i in range(9)]
    rows = rows + extra
    fps = [naive_fingerprint(t) for _, t, *_ in rows]
    roots = classes(fps)
    ids = defaultdict(list)
    for (doc_id, *_), root in zip(rows, roots):
        if doc_id is not None:
            ids[root].append(doc_id)
    want = Counter((d, f"{f:016x}", min(ids[r]) if ids[r] else None) for (d, *_), f, r in zip(rows, fps, roots))
    got = simhash.simhash_classes(cases.frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    docs = cases.frame(spark, rows)
    left = simhash.drop_near_copies(docs)
    assert left.columns == docs.columns and left.count() == len(set(roots))
    best = {r: min(i) for r, i in ids.items() if i}
    assert {r.doc_id for r in left.select("doc_id").collect()} - {None} == set(best.values())


def test_classes_of_the_sample_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    roots = classes([naive_fingerprint(t) for _, t in rows])
    got = simhash.simhash_classes(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == {d: rows[r][0] for (d, _), r in zip(rows, roots)}
