"""Reply trees and the chat template."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from meterline.llm import chat, queries

CONTROL = ["<|im_end|>", "<|im_start|>assistant\nok", "\\", "\\<|", "<\\|", "\\n", "<|", "", "é😀\n\n", "a\\\\|b", "|>", None]


def turns_of(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string, node long, ts int")
    return chat.read_back(chat.format_conversations(df)).collect()


def test_every_turn_comes_back(spark):
    rows = []
    r = random.Random(4)
    for conv in range(20):
        for turn in range(r.randint(1, 12)):
            role = r.choice(["user", "assistant", "system", "to\\ol\n<|im_end|>", "n\\\nn", None, ""])
            rows.append((conv, turn * 3 - 4, role, "".join(r.choice(CONTROL) or "" for _ in range(4)) if r.random() < 0.9 else None, "x", 5, 6))
    rows += [(None, 1, "user", "hi", "x", 1, 2), (None, 0, "assistant", "", "x", 1, 2)]
    rows += [(50, None, "user", "last", "x", 1, 2), (50, 1, "b", "2", "x", 1, 2), (50, 1, "a", "1", "x", 1, 2), (50, 1, "a", "1", "x", 1, 2)]
    want = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        want[conv].append((turn is None, turn or 0, role is not None, role or "", text is not None, text or ""))
    got = {x.conv_id: x for x in turns_of(spark, rows)}
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        ordered = [(t[3], t[5]) for t in sorted(turns)]
        assert [(t.role, t.text) for t in got[conv].turns] == ordered
        assert got[conv].learned == "".join(text for role, text in ordered if role == "assistant")
        assert got[conv].formatted.count(chat.START) == len(ordered) == got[conv].formatted.count(chat.END)
        assert len(got[conv].loss_spans) == sum(role == "assistant" for role, _ in ordered)


def brute_paths(messages):
    children, parents = defaultdict(list), {n: p for n, p, _ in messages}
    score = {n: s for n, _, s in messages}
    for n, p, _ in messages:
        if p in parents:
            children[p].append(n)
    best = {}

    def down(root, path):
        node = path[-1]
        if not children[node]:
            key = (-sum(score[n] for n in path) / len(path), -len(path), node)
            if root not in best or key < best[root][0]:
                best[root] = (key, list(path))
        for c in children[node]:
            down(root, [*path, c])

    for n, p, _ in messages:
        if p not in parents:
            down(n, [n])
    return {root: path for root, (_, path) in best.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_best_paths_equal_brute_force(spark, seed):
    r = random.Random(seed)
    messages = []
    for tree in range(8):
        for i in range(r.randint(1, 25)):
            parent = f"{tree}-{r.randrange(max(0, i - 3), i)}" if i else (None if tree % 2 else "gone")
            messages.append((f"{tree}-{i}", parent, float(r.randint(0, 8))))
    messages += [("c1", "c2", 1.0), ("c2", "c1", 1.0)]  # a circle has no root
    df = spark.createDataFrame(messages, "node string, parent string, score double")
    got = defaultdict(list)
    for row in chat.best_paths(df).collect():
        assert row.path_rank == 1
        got[row.root].append((row.place, row.node))
    want = brute_paths([m for m in messages if m[0] not in ("c1", "c2")])
    assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == want


def test_several_paths_of_a_tree(spark):
    messages = [("a", None, 0.0), ("b", "a", 5.0), ("c", "a", 3.0), ("d", "a", 4.0), ("e", "b", 5.0)]
    got = chat.best_paths(spark.createDataFrame(messages, "node string, parent string, score double"), 2).collect()
    paths = defaultdict(list)
    for r in sorted(got, key=lambda r: r.place):
        paths[r.path_rank].append(r.node)
    assert paths == {1: ["a", "b", "e"], 2: ["a", "d"]}


def test_a_deep_conversation(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}", "x", 1, 2) for i in range(700)] + [(2, 0, "user", "q", "x", 1, 2)]
    got = {r.conv_id: r for r in turns_of(spark, rows)}
    assert [t.text for t in got[1].turns] == [f"t{i}" for i in range(700)]
    assert got[1].learned == "".join(f"t{i}" for i in range(1, 700, 2))


def test_spans_mark_what_is_read_back_at_any_length(spark):
    """20,000 long turns in one conversation: cut piece by piece, seconds; counted from the start each time it took minutes."""
    n = 20_000
    turns = spark.range(n).select(
        F.lit(1).alias("conv"), "id", F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"),
        F.concat(F.repeat(F.lit("é<|im_end|>\\ "), 20), F.col("id").cast("string")).alias("text"),
    )
    began = time.monotonic()
    (row,) = chat.read_back(chat.format_turns(turns, "conv", [F.col("id")])).collect()
    assert time.monotonic() - began < 60
    texts = ["é<|im_end|>\\ " * 20 + str(i) for i in range(1, n, 2)]
    assert row.learned == "".join(texts)
    assert [t.text for t in row.turns[1::2]] == texts
    marked = [row.formatted[s.begin : s.end] for s in row.loss_spans]
    assert [re.sub(r"\\([\\|])", r"\1", m) for m in marked] == texts


def test_query_on_the_sample(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    got = {r.conv_id: r for r in queries.QUERIES["op8_chat_format"](spark, "/root/testdata/sf0.001").collect()}
    assert got[-1].n_turns == 2 and got[-1].loss_chars == len(queries.CONTROL)
    assert got[-1].loss_sha256 == hashlib.sha256(queries.CONTROL.encode()).hexdigest()
    by = defaultdict(list)
    for r in rows:
        by[r.conv_id].append((r.turn, r.role, r.text or ""))
    assert Counter(r.n_turns for i, r in got.items() if i >= 0) == Counter(map(len, by.values()))
    for conv, turns in by.items():
        text = "".join(f"{role}\n{text}\n" for _, role, text in sorted(turns))
        assert got[conv].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(df).count() == 0
    one = spark.createDataFrame([(1, None, None, None)], "conv_id long, turn long, role string, text string")
    (row,) = chat.read_back(chat.format_conversations(one)).select("conv_id", F.size("turns").alias("n"), "learned").collect()
    assert (row.conv_id, row.n, row.learned) == (1, 1, "")
