"""Byte-level BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the last ``WINDOW`` bytes cuts every text into chunks, so passages that documents share
are cut alike wherever they stand. The tokens of a chunk depend on its neighbours only near its ends: between a
character that isn't white space and a white space character the tokenizer always splits, and what follows such a split
doesn't depend on what precedes it. Each chunk is taken apart at its first and last such split:

- The body between them is encoded once and reused. Bodies that occur most often over all documents are
  encoded in one distributed step and broadcast (``SHARED_BYTES`` bounds them, chosen exactly by bytes saved);
  all others are encoded where they occur, once per task as long as a cache of ``CACHE_BYTES`` holds them.
- The ends that meet at a chunk join are repaired: the text from the last split before the join to the first one
  behind it is encoded anew. A chunk without a split joins its neighbours' window, which grows until both of its ends
  are splits, where the tokens of both sides must agree.

So ids are exactly those of one encoding of the whole text, special tokens in it included. Decoding maps ids back to the
bytes of the vocabulary. The text itself is never shuffled, only digests of chunks and the frequent chunks.

The vocabulary file is a parameter, read by the driver and broadcast (a few MB for any published vocabulary).

Defined cases. Null text counts as empty and has no ids. Rows that repeat are encoded row by row. Very long texts are
read whole and cost as many chunks. Other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import in_slices, stored, whole_text

WINDOW = 16
MEAN_BITS = 9
SHARED_BYTES = 8 << 20
CACHE_BYTES = 8 << 20
LONGEST_SHARED = 1 << 14

# The split pattern of this kind of vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, by its rule."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Bytes of every token with its id, and the special tokens, from a tokenizers file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    to_byte = byte_alphabet()
    ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return ranks, special


class Codec:
    """Encodes and decodes whole texts; made once per task from the broadcast vocabulary."""

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int]):
        self.encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.any_special = set(special)
        self.pieces = {i: b for b, i in ranks.items()} | {i: s.encode() for s, i in special.items()}

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode(text, allowed_special=self.any_special), dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


def cuts(data: bytes) -> np.ndarray:
    """Places where the rolling hash of the last ``WINDOW`` bytes cuts the text, moved on to the next character."""
    codes = np.frombuffer(data, dtype=np.uint8)
    if codes.size <= WINDOW:
        return np.zeros(0, dtype=np.int64)
    hashed = (codes.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    width = 1
    while width < WINDOW:  # the hash of 2w bytes from two hashes of w bytes
        hashed = hashed[:-width] * np.uint32(pow(0x01000193, width, 1 << 32)) + hashed[width:]
        hashed ^= hashed >> np.uint32(15)
        width *= 2
    at = np.flatnonzero(hashed >> np.uint32(32 - MEAN_BITS) == 0) + WINDOW
    at = at[at < codes.size]
    for _ in range(3):
        inside = codes[at] & 0xC0 == 0x80
        at = np.where(inside & (at + 1 < codes.size), at + 1, at)
    return np.unique(at[codes[at] & 0xC0 != 0x80])


# Between these two bytes the tokenizer splits whatever stands around them.
_SPLIT = re.compile(rb"[!-~](?=[\t-\r ])")


def parts(data: bytes) -> list[tuple[bytes, bool]]:
    """The text as pieces that may be encoded alone, each with whether it is the body of a chunk.

    Joined they give the text. The others are the windows around the chunk joins.
    """
    out: list[tuple[bytes, bool]] = []
    ends = [*cuts(data).tolist(), len(data)]
    open_at, begin = 0, 0
    for end in ends:
        first = _SPLIT.search(data, begin, min(end + 1, len(data))) if begin else None
        head = first.end() if first else (0 if not begin else -1)
        if head >= 0:
            tail = _last_split(data, max(head, begin), end) if end < len(data) else len(data)
            if tail > head:
                if head > open_at:
                    out.append((data[open_at:head], False))
                out.append((data[head:tail], True))
                open_at = tail
        begin = end
    if open_at < len(data):
        out.append((data[open_at:], False))
    return out


def _last_split(data: bytes, begin: int, end: int) -> int:
    """The last split in a chunk, or -1."""
    size = 64
    while True:
        start = max(begin, end - size)
        found = -1
        for m in _SPLIT.finditer(data, start, end):
            found = m.end()
        if found >= 0 or start == begin:
            return found if found > begin else -1
        size *= 4


def _digest(body: bytes) -> bytes:
    return hashlib.blake2b(body, digest_size=16).digest()


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest, length and count of the chunk bodies of one task, added up over a batch."""
    for batch in in_slices(batches):
        seen: dict[bytes, list] = {}
        for data in batch.column(0).to_pylist():
            for body, shared in parts(data):
                if shared and 2 * WINDOW < len(body) <= LONGEST_SHARED:
                    seen.setdefault(_digest(body), [len(body), 0])[1] += 1
        columns = list(seen), [v[0] for v in seen.values()], [v[1] for v in seen.values()]
        types = pa.binary(), pa.int64(), pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["digest", "size", "n"])


def shared_bodies(texts: DataFrame, most_bytes: int = SHARED_BYTES) -> dict[bytes, int]:
    """Digest and length of the bodies whose reuse saves most, ``most_bytes`` of text at most.

    The choice covers all documents: it is a top-k by bytes saved over exact counts, k such that even
    the longest bodies fit. What isn't chosen is encoded where it occurs.
    """
    counted = texts.mapInArrow(_bodies, "digest binary, size long, n long").groupBy("digest").agg(F.max("size").alias("size"), F.sum("n").alias("n"))
    saved = F.col("size") * (F.col("n") - 1)
    top = counted.where(F.col("n") > 1).orderBy(saved.desc(), "digest").limit(most_bytes // (1 << MEAN_BITS)).select("digest", "size")
    chosen, held = {}, 0
    for row in top.collect():
        held += row["size"]
        if held > most_bytes:
            break
        chosen[bytes(row["digest"])] = row["size"]
    return chosen


def encoded_bodies(texts: DataFrame, chosen: dict[bytes, int], make) -> dict[bytes, bytes]:
    """The ids of each chosen body, encoded once."""
    if not chosen:
        return {}
    wanted = texts.sparkSession.sparkContext.broadcast(frozenset(chosen))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in in_slices(batches):
            found: dict[bytes, bytes] = {}
            for data in batch.column(0).to_pylist():
                for body, shared in parts(data):
                    if shared and (d := _digest(body)) in wanted.value and d not in met:
                        met.add(d)
                        found[d] = body
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], names=["digest", "body"])

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = make()
        for batch in in_slices(batches):
            encoded = [codec.encode(b.decode()).tobytes() for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(encoded, pa.binary())], names=["digest", "ids"])

    one = texts.mapInArrow(encode, "digest binary, body binary").groupBy("digest").agg(F.min("body").alias("body"))
    table = stored(one.mapInArrow(ids, "digest binary, ids binary"), "bodies")
    return {bytes(r["digest"]): bytes(r["ids"]) for r in table.collect()}


def encode_documents(docs: DataFrame, path: str, keep: list[str], shared_bytes: int = SHARED_BYTES) -> DataFrame:
    """Columns ``keep`` of every document with ``ids`` (little-endian unsigned 32-bit), n_tokens, n_reused and ``decoded``."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(vocabulary(path))
    texts = docs.select(whole_text().cast("binary").alias("t"))

    def make() -> Codec:
        return Codec(*held.value)

    table = spark.sparkContext.broadcast(encoded_bodies(texts, shared_bodies(texts, shared_bytes), make))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, shared = make(), table.value
        cache: dict[bytes, np.ndarray] = {}
        size = 0
        for batch in in_slices(batches):
            out: list[tuple[bytes, int, int, str]] = []
            for data in batch.column(batch.num_columns - 1).to_pylist():
                ids, reused = [], 0
                for piece, body in parts(data):
                    key = _digest(piece) if body else b""
                    if body and (known := shared.get(key)) is not None:
                        found = np.frombuffer(known, dtype="<u4")
                        reused += found.size
                    elif body and (known := cache.get(key)) is not None:
                        found = known
                        reused += found.size
                    else:
                        found = codec.encode(piece.decode())
                        if body and len(piece) > 2 * WINDOW:
                            size += 4 * found.size + 150
                            if size > CACHE_BYTES:
                                cache.clear()
                                size = 0
                            cache[key] = found
                    ids.append(found)
                whole = np.concatenate(ids) if ids else np.zeros(0, dtype="<u4")
                out.append((whole.astype("<u4").tobytes(), whole.size, reused, codec.decode(whole)))
            made = zip(zip(*out) if out else [()] * 4, (pa.binary(), pa.int64(), pa.int64(), pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(list(c), t) for c, t in made)], names=[*kept.names, "ids", "n_tokens", "n_reused", "decoded"]
            )

    kept = docs.select(*keep).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
    rows = docs.select(*keep, whole_text().cast("binary").alias("__text"))
    return rows.mapInArrow(encode, f"{schema}, ids binary, n_tokens long, n_reused long, decoded string")
