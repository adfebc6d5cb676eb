"""The mix: targets, draws, permutations and the mixed documents."""

import re
from collections import Counter, defaultdict

import cases
import pytest
from pyspark.sql import functions as F

from meterline.llm import mixing

WORD = re.compile("[^\x20\x09-\x0d]+")


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Reshare the excess by weight until no source is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in order if s not in capped)
        out = {s: most * sizes[s] if s in capped else rest * weight[s] / open_weight for s in order}
        above = {s for s in order if s not in capped and out[s] > most * sizes[s] + 1e-9}
        if not above:
            return out
        capped |= above


@pytest.fixture(scope="module")
def rows():
    more = [(1000 + i, cases.prose(i, 50 + i % 300), "en", ["a", "b", "c", "hot", "hot", "hot", None, "é"][i % 8]) for i in range(300)]
    return cases.messy_rows() + more


@pytest.fixture(scope="module")
def mixed(spark, rows):
    return mixing.mix(cases.frame(spark, rows))


def sizes_of(rows):
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    return sizes


def test_targets_and_taken_words(rows, mixed):
    got = mixing.taken_words(mixed).collect()
    sizes = sizes_of(rows)
    want = targets(sizes)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, len(WORD.findall(t or ""))) for d, t, *_ in rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source, words in taken.items():
        assert abs(words - want[source]) <= mixing.BLOCK * 1.5, (source, words, want[source])


def test_reruns_agree(spark, rows, mixed):
    again = mixing.taken_words(mixing.mix(cases.frame(spark, rows)))
    key = lambda df: Counter((r.doc_id, r.size, r.taken) for r in df.collect())
    assert sum(key(again).values()) == len(rows)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert key(mixing.taken_words(mixing.mix(docs))) == key(mixing.taken_words(mixing.mix(docs)))


def test_slots_fill_every_shard_once_and_no_round_repeats_a_block(mixed):
    slots = mixed.slots.collect()
    places = sorted(r.shard * mixing.SHARD + r.position for r in slots)
    assert places == list(range(len(slots)))
    assert max(Counter((r.rank, r.round, r.block) for r in slots).values()) == 1
    facts = {r["rank"]: r for r in mixed.sources.collect()}
    assert Counter(r["rank"] for r in slots) == Counter({k: f.slots for k, f in facts.items() if f.slots})
    assert all(r.block < facts[r["rank"]].blocks for r in slots)


def test_pieces_cover_each_taken_block(mixed):
    sizes = {r["rank"]: r.source_size for r in mixed.sources.collect()}
    words = defaultdict(int)
    for p in mixed.pieces.collect():
        words[p["rank"], p.round, p.block] += p.to_word - p.from_word
    for (rank, _, block), n in words.items():
        assert n == min(mixing.BLOCK, sizes[rank] - block * mixing.BLOCK)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 97, 1000])
def test_permutations_are_bijections(spark, size):
    df = spark.range(size).select(mixing.permuted(F.col("id"), F.lit(size).cast("bigint"), F.lit(7)).alias("p"))
    out = [r.p for r in df.collect()]
    assert sorted(out) == list(range(size))
    if size == 1000:
        assert sum(a != b for a, b in zip(out, range(size))) > 950


def test_mixed_documents(spark, rows):
    docs = cases.frame(spark, rows)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = out.collect()
    texts = defaultdict(list)
    for d, t, *_ in rows:
        texts[d].append(" ".join(WORD.findall(t or "")))
    for r in got:
        assert r.n_chars == len(r.text)
        flat = " ".join(WORD.findall(r.text))
        assert flat and any(flat in t for t in texts[r.doc_id])
    want = targets(sizes_of(rows))
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += len(WORD.findall(r.text))
    for source in want:
        assert abs(taken[source] - want[source]) <= 1.5 * mixing.BLOCK


def test_runs_are_exact_parts_of_the_text(spark):
    wide = lambda i: "".join(f"  w{i}_{k}" + ["\n\n    ", "\t", " ", "\r\n"][k % 4] for k in range(40 + 7 * i))
    rows = [(i, wide(i), "en", ["a", "b", "c"][i % 3]) for i in range(60)]
    got = mixing.mixed_documents(cases.frame(spark, rows)).collect()
    texts = {d: t for d, t, *_ in rows}
    parts = [r for r in got if r.text != texts[r.doc_id]]
    assert len(parts) > 20
    for r in parts:
        assert r.text in texts[r.doc_id] and r.text == r.text.strip(), r
        assert r.n_chars == len(r.text)


def test_the_mix_does_not_depend_on_the_files(spark, rows, tmp_path):
    docs = cases.frame(spark, rows + [(1000, "a second text of this id " * 30, "en", "a"), (None, "no id " * 40, "en", "b")])
    docs.repartition(7, "text").sortWithinPartitions("n_chars").write.parquet(f"{tmp_path}/a")
    docs.coalesce(1).orderBy(F.col("text").desc()).write.parquet(f"{tmp_path}/b")
    key = lambda r: (r.doc_id, r.source, r.text)
    one, other = (Counter(map(key, mixing.mixed_documents(spark.read.parquet(f"{tmp_path}/{k}")).collect())) for k in "ab")
    assert one == other


def test_empty(spark):
    assert mixing.taken_words(mixing.mix(cases.empty(spark))).count() == 0
    assert mixing.mixed_documents(cases.empty(spark)).count() == 0
    blank = cases.frame(spark, [(1, None, None, None), (2, " ", "en", "a")])
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in mixing.taken_words(mixing.mix(blank)).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    assert mixing.mixed_documents(blank).count() == 0
