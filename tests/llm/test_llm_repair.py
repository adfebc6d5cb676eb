"""Conversation repair against an exhaustive search over edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from meterline.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, states string, audit long, fact int"
DONE, OPEN = re.compile("^(s?(ua)+)?$"), re.compile("^(s?(ua)*u?)?$")


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        again = (role, text) in seen
        seen.add((role, text))
        blank = not re.search(r"[^\x20\x09-\x0D]", text)
        cut = not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text)
        out.append("blank" if blank else "duplicate" if again else "truncated" if cut else "")
    return out


def search(rows):
    """The least (cost, audit, text) over all edits, by trying them all."""
    found, best = faults(rows), [None]

    def go(i, cost, audit, turns, added):
        if best[0] and cost > best[0][0]:
            return
        said = "".join(r[:1] for r, _ in turns)
        if not OPEN.match(said):
            return
        if i == len(rows) and DONE.match(said):
            best[0] = min(filter(None, [best[0], (cost, audit, "\n".join(f"{r}:{t}" for r, t in turns))]))
        if i < len(rows):
            _, role, text = rows[i]
            if found[i] not in ("blank", "duplicate"):
                more = 3 if found[i] == "truncated" else 0
                if role:
                    go(i + 1, cost + more, audit + "K", [*turns, (role, text)], 0)
                for other in ("user", "assistant"):
                    go(i + 1, cost + more + 3, audit + "R", [*turns, (other, text)], 0)
            go(i + 1, cost + 4, audit + "D", turns, 0)
        if added < 3:
            for other in ("user", "assistant"):
                go(i, cost + 3, audit + "I", [*turns, (other, "")], added + 1)

    go(0, 0, "", [], 0)
    return best[0]


def wanted(rows):
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    found, (cost, audit, text) = faults(rows), search(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def as_tuple(r):
    return (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)


@pytest.fixture(scope="module")
def talk():
    r = random.Random(13)
    out = defaultdict(list)
    for conv in [*range(300), None]:
        for turn in range(r.randint(1, 6)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "unicorn"])
            text = r.choice(["Hi.", "What?", "cut", "x! \n", "", None, " \t", f"t{turn}.", f"{turn}\x0b"])
            place = None if r.random() < 0.05 else turn * r.choice([1, 1, 2]) - 1
            out[conv] += [(place, role, text)] * (2 if r.random() < 0.1 else 1)
    return out


def test_audits_equal_exhaustive_search(spark, talk):
    flat = [(c, *row, "s", 1, 2) for c, rows in talk.items() for row in rows]
    random.Random(1).shuffle(flat)
    df = spark.createDataFrame(flat, SCHEMA)
    got = {r.conv_id: r for r in repair.audits(df).collect()}
    assert got.keys() == talk.keys()
    for conv, rows in talk.items():
        assert as_tuple(got[conv]) == wanted(rows), rows
    turns = defaultdict(list)
    for t in repair.repaired_turns(df).collect():
        turns[t.conv_id].append((t.turn, t.role, t.text))
    for conv, row in got.items():
        mended = sorted(turns[conv])
        assert [t for t, _, _ in mended] == list(range(len(mended)))
        assert DONE.match("".join(role[:1] for _, role, _ in mended))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in mended).encode()).hexdigest() == row.repaired_sha256


def test_order_of_audits_equals_order_of_strings(monkeypatch):
    for prime in ((1 << 61) - 1, 3):  # with a tiny prime nearly all hashes collide
        monkeypatch.setattr(repair, "_PRIME", prime)
        r = random.Random(prime)
        nodes = [repair.Node(None, "", 0)]
        known = {"": nodes[0]}
        for _ in range(400):
            parent, letter = r.choice(nodes), r.choice("DIKR")
            name = parent.audit() + letter
            if name not in known:
                known[name] = repair.Node(parent, letter, 0)
                nodes.append(known[name])
        assert all(n.audit() == name for name, n in known.items())
        for _ in range(4000):
            a, b = r.choice(nodes), r.choice(nodes)
            assert repair.before(a, b) == (a.audit() < b.audit())


def test_a_long_conversation(spark):
    n = 30_000
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}." if i % 7 else "cut", "s", 1, 2) for i in range(n)]
    (got,) = repair.audits(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    again = sum(i % 7 == 0 for i in range(n)) - 2
    assert (got.gaps, got.blank, got.duplicate, got.truncated, got.illegal) == (0, 0, again, 2, 0)
    assert len(got.audit) - got.audit.count("I") == n and got.audit.count("D") >= again


def test_query_on_the_sample(spark):
    sf = "/root/testdata/sf0.01"
    talk = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        code = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", r.text or " ")}.get(code, r.text)
        row = (r.turn, "user" if code == 4 else r.role, text)
        talk[r.conv_id] += [row] * {0: 0, 3: 2}.get(code, 1)
    got = {r.conv_id: r for r in queries.QUERIES["op13_conversation_repair"](spark, sf).collect()}
    assert got.keys() == talk.keys()
    assert all(as_tuple(got[c]) == wanted(rows) for c, rows in talk.items())


def test_conversations_that_lose_all_rows(spark, tmp_path):
    gone = next(c for c in range(1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in (0,)))
    rows = [(gone, 0, "user", "Hi."), (None, None, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in queries.QUERIES["op13_conversation_repair"](spark, str(tmp_path)).collect()}
    assert as_tuple(got[gone]) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got[None].blank + got[None].cost in (0, 5)


def test_empty(spark):
    assert repair.audits(spark.createDataFrame([], SCHEMA)).count() == 0
    assert repair.repaired_turns(spark.createDataFrame([], SCHEMA)).count() == 0
