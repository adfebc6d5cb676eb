"""Conversation structure repair: the cheapest edits that make the roles ``(s?(ua)+)?``, and the audit string that names them.

Rows of a conversation are read by turn (nulls first). A row is blank without a word, a duplicate if role and text were
seen earlier, truncated if its last character that isn't blank is none of ``.!?``; its first fault counts. Edits are Keep (cost 0), Rerole to user or
assistant (3), Delete (4; the only one for blank rows and duplicates) and Insert of an empty user or assistant turn (3). A truncated row that stays
costs 3 more. Of the cheapest edits those with the least audit, the string of their initials, are taken.

Method. A dynamic programme over rows keeps, for each of the four states of the role pattern, the cheapest edits so far.
Their audits are linked nodes that share all prefixes: a node holds its letter, its depth, a rolling hash of the whole prefix and its
ancestors 1, 2, 4, ... steps up. Ties in cost compare two audits by their longest common prefix: both are brought to one depth by
ancestors, then the largest jumps that keep the hashes apart lead to the first letter in which they differ. Equal hashes are
verified: prefixes that are not the same node are compared letter by letter. Two edits with one audit reach the same
state, so equal prefixes always are one node, and no audit is a proper prefix of its rival of equal cost.

Rows are shuffled once by conversation, sorted by Spark and streamed: a task holds no text but of the row it reads. Each state also carries the digest of the
turns repaired so far, so the digest of the result needs no second pass. Of a conversation a task holds one digest per row (for duplicates) and the
audit nodes that are still in use. One conversation is one task's work, as its audit and its digest are single values in order.

Defined cases. Null role and text count as one blank; null turns come first and don't count for gaps; rows of one turn
follow one another by role and text. A null conv_id is one conversation. A role that begins with none of s, u, a can't be kept, nor can an empty one. Repeated rows are
duplicates. A conversation without a row that stays has an empty audit and the digest of nothing. Other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import WORD, named, stored

RECAST, DROPPED, ADDED, CUT_OFF = 3, 4, 3, 3

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
_INITIALS = "-sua"
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
# The one turn other than a system turn that may follow each state.
_NEXT = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
_LEGAL = {"su", "ua", "au"}

_PRIME = (1 << 61) - 1
_BASE = 1_000_003


# --- audits ---------------------------------------------------------------------------------------


class Node:
    """An edit and, through its ancestors, all edits before it."""

    __slots__ = ("letter", "state", "depth", "hash", "up")

    def __init__(self, parent: Node | None, letter: str, state: int):
        self.letter = letter
        self.state = state
        self.depth = parent.depth + 1 if parent else 0
        self.hash = (parent.hash * _BASE + ord(letter)) % _PRIME if parent else 0
        up = [parent] if parent else []
        while up and len(up[-1].up) >= len(up):
            up.append(up[-1].up[len(up) - 1])
        self.up = tuple(up)

    def at(self, depth: int) -> Node:
        """The ancestor at a depth."""
        node = self
        while node.depth > depth:
            node = node.up[(node.depth - depth).bit_length() - 1]
        return node

    def path(self) -> list[Node]:
        nodes, node = [], self
        while node.up:
            nodes.append(node)
            node = node.up[0]
        return nodes[::-1]

    def audit(self) -> str:
        return "".join(node.letter for node in self.path())


def _verified(x: Node, y: Node) -> tuple[Node, Node] | None:
    """The first edits in which two prefixes of one depth differ, if they do; walks back no further than to the node they share."""
    first = None
    while x is not y:
        if x.letter != y.letter:
            first = (x, y)
        x, y = x.up[0], y.up[0]
    return first


def before(a: Node, b: Node) -> bool:
    """Whether the audit of ``a`` is less than that of ``b``."""
    depth = min(a.depth, b.depth)
    x, y = a.at(depth), b.at(depth)
    if x.hash == y.hash:
        first = _verified(x, y)
        return first[0].letter < first[1].letter if first else a.depth < b.depth
    for k in reversed(range(len(x.up))):
        if k < len(x.up) and x.up[k].hash != y.up[k].hash:
            x, y = x.up[k], y.up[k]
    # Equal hashes from here on up: what they say is checked, a collision is only a longer way to the first difference.
    first = _verified(x.up[0], y.up[0]) or (x, y)
    return first[0].letter < first[1].letter


# --- the programme --------------------------------------------------------------------------------


@dataclass
class Head:
    """The cheapest edits that reach a state: cost, audit, and the digest of the turns they leave."""

    cost: int
    node: Node
    digest: object


def _said(digest, first: bool, role: str, text: str):
    """The digest with one more turn."""
    more = digest.copy()
    more.update(f"{'' if first else chr(10)}{role}:{text}".encode())
    return more


def _better(heads: dict, state: int, cost: int, parent: Node, letter: str) -> Node | None:
    """The new node, if it beats what is known of the state."""
    known = heads.get(state)
    if known is not None and known[0] < cost:
        return None
    node = Node(parent, letter, state)
    return node if known is None or cost < known[0] or before(node, known[1]) else None


def _finished(won: dict) -> dict[int, Head]:
    """Heads whose digests are made only for what has won."""
    return {state: Head(cost, node, digest() if callable(digest) else digest) for state, (cost, node, digest) in won.items()}


def with_inserts(heads: dict[int, Head]) -> dict[int, Head]:
    """Heads, with what inserted turns reach from them."""
    changed = True
    while changed:
        changed = False
        for state, head in list(heads.items()):
            to, role = _NEXT[state]
            known = {s: (h.cost, h.node) for s, h in heads.items()}
            node = _better(known, to, head.cost + ADDED, head.node, INSERT)
            if node:
                heads[to] = Head(head.cost + ADDED, node, _said(head.digest, state == START, role, ""))
                changed = True
    return heads


def with_row(heads: dict[int, Head], role: str, text: str, must_go: bool, cut_off: bool) -> dict[int, Head]:
    """Heads after one more row."""
    won: dict[int, tuple] = {}

    def offer(state: int, cost: int, head: Head, letter: str, digest) -> None:
        node = _better(won, state, cost, head.node, letter)
        if node:
            won[state] = (cost, node, digest)

    extra = CUT_OFF if cut_off else 0
    for state, head in heads.items():
        offer(state, head.cost + DROPPED, head, DELETE, head.digest)
        if must_go:
            continue
        kept = _KEPT.get((state, role[:1]))
        if kept is not None:
            offer(kept, head.cost + extra, head, KEEP, lambda h=head, s=state: _said(h.digest, s == START, role, text))
        to, other = _NEXT[state]
        offer(to, head.cost + RECAST + extra, head, REROLE, lambda h=head, s=state, o=other: _said(h.digest, s == START, o, text))
    return _finished(won)


@dataclass
class Conversation:
    """What is known of a conversation whose rows come in order."""

    conv_id: int | None
    heads: dict[int, Head] = field(default_factory=lambda: with_inserts({START: Head(0, Node(None, "", START), hashlib.sha256())}))
    seen: set[bytes] = field(default_factory=set)
    low: int | None = None
    high: int | None = None
    turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    last: str | None = None

    def add(self, turn: int | None, role: str, text: str, fact: bytes, empty: bool, cut_off: bool) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        again = fact in self.seen
        self.seen.add(fact)
        self.blank += empty
        self.duplicate += again and not empty
        self.truncated += cut_off and not again and not empty
        if self.last is not None:
            self.illegal += self.last + role[:1] not in _LEGAL
        self.last = role[:1]
        self.heads = with_inserts(with_row(self.heads, role, text, empty or again, cut_off))

    def row(self) -> tuple:
        ends = [self.heads[s] for s in (START, ASSISTANT) if s in self.heads]
        best = ends[0]
        for other in ends[1:]:
            if other.cost < best.cost or other.cost == best.cost and before(other.node, best.node):
                best = other
        states = "".join(_INITIALS[node.state] for node in best.node.path())
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, best.cost, best.node.audit(), states, best.digest.hexdigest())


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "states", "repaired_sha256"]
_TYPES = [pa.int64()] * 7 + [pa.string()] * 3


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, from rows in the order of conversations and turns."""
    now: Conversation | None = None
    for batch in batches:
        done = []
        for conv_id, turn, role, text, fact, empty, cut_off in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.row())
                now = Conversation(conv_id)
            now.add(turn, role, text, fact, empty, cut_off)
        if done:
            yield _batch(done)
    if now is not None:
        yield _batch([now.row()])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), _TYPES)], names=COLUMNS)


# --- the operator ---------------------------------------------------------------------------------


def _clean(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text, nulls of the last two being one blank."""
    filled = lambda c: F.coalesce(named(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select(*[named(c).cast("bigint").alias(c) for c in ("conv_id", "turn")], filled("role"), filled("text"))


def audits(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``states`` has, for every edit, the initial of the role that the repaired conversation ends with after it (``-``: no turn yet).
    """
    facts = _clean(conversations).select(
        "conv_id", "turn", "role", "text",
        F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)).alias("fact"),
        (~F.col("text").rlike(WORD)).alias("empty"),
        (~F.rtrim(F.col("text"), F.lit(" \t\n\u000b\f\r")).rlike(r"[.!?]\z")).alias("cut_off"),
    )
    sorted_ = facts.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    numbers = ", ".join(f"{c} long" for c in COLUMNS[:7])
    return sorted_.mapInArrow(_rows, f"{numbers}, audit string, states string, repaired_sha256 string")


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """The turns of every repaired conversation: conv_id, turn (from 0), role, text, edit. One row per turn, nothing gathered."""
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = _clean(conversations).select("*", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).alias("__nth"))
    found = stored(audits(conversations).select("conv_id", "audit", "states"), "audits")
    letters = F.posexplode(F.arrays_zip(F.split("audit", "").alias("edit"), F.split("states", "").alias("state"))).alias("place", "e")
    edits = found.where(F.col("audit") != "").select("conv_id", letters).select("conv_id", "place", "e.edit", "e.state")
    so_far = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edits = edits.select(
        "*",
        F.sum((F.col("edit") != INSERT).cast("int")).over(so_far).alias("__row"),
        (F.sum((F.col("edit") != DELETE).cast("int")).over(so_far) - 1).alias("__turn"),
    ).where(F.col("edit") != DELETE)
    source = rows.select(F.col("conv_id").alias("__id"), "__nth", F.col("role").alias("__role"), F.col("text").alias("__text"))
    same = F.col("conv_id").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__nth")) & (F.col("edit") != INSERT)
    other = F.when(F.col("state") == "u", "user").otherwise("assistant")
    return edits.join(source, same, "left").select(
        "conv_id",
        F.col("__turn").alias("turn"),
        F.when(F.col("edit") == KEEP, F.col("__role")).otherwise(other).alias("role"),
        F.when(F.col("edit") == INSERT, "").otherwise(F.col("__text")).alias("text"),
        "edit",
    )
