"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

Everything is DataFrame and SQL functions, row by row inside the scan.

- The five-word shingles of a text are hashed once. The upper bits of a hash name one of ``BINS`` bins, the least
  remaining value of each bin is kept. One array sort does it: each hash carries its bin in front, one
  sentinel per bin is added, and the first entry of each bin is its minimum (or its sentinel, if it is empty).
- An empty bin copies the value of another one: it tries the bins in a pseudorandom order of its own until one isn't empty
  (optimal densification). The order of bin i is ``try t -> (A[i] * t + C[i]) mod BINS`` with odd ``A``, so it meets every
  bin. A few tries are written out, the rest is found by the least try among the filled bins.
- Of each bin the ``BITS`` low-order bits stay, one hexadecimal digit, packed 16 to a long number.
- ``likeness`` counts equal digits in the packed numbers by bit operations, and corrects for digits that agree by chance:
  ``(share - 1/16) / (1 - 1/16)``, cut to 0 .. 1.

Defined cases. Null text counts as empty. Words are lower-cased runs without ASCII white space; fewer than five make one
shingle of the whole sequence. A text without words has the empty fingerprint, like another empty one by 1 and anything
else by 0. Texts are read whole. The next document is that of the next row by doc_id (nulls last), rows that repeat a doc_id
in the order of the input; after the last comes the first, so a single row is followed by itself. Other columns are not looked at; an
empty table gives an empty result.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import BLANK, FILE, POS, ROW, stored, whole_text, with_row_key

WORDS = 5
BINS = 256
BITS = 4
TRIES = 20
LOW = 63 - (BINS.bit_length() - 1)  # bits of a hash below its bin
DIGITS = 64 // BITS

_SPREAD = random.Random(BINS)
_STEP = [_SPREAD.randrange(1, BINS, 2) for _ in range(BINS)]
_SHIFT = [_SPREAD.randrange(BINS) for _ in range(BINS)]
_BACK = [pow(a, -1, BINS) for a in _STEP]


def _numbers(values: list[int]) -> Column:
    """A constant array, folded to one literal when the query is planned."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def shingle_hashes(text: Column) -> list[tuple[str, Column]]:
    """Steps (name, column) that lead from a text to the 63-bit hashes of its shingles."""
    words = F.filter(F.split(F.lower(text), BLANK + "+"), lambda w: w != "")
    hashed = F.transform("__words", lambda w: F.xxhash64(w))
    last = F.size("__hashed") - WORDS + 1
    at = lambda i, k: F.get(F.col("__hashed"), i + k)
    kept = lambda h: h.bitwiseAND(F.lit((1 << 63) - 1))
    shingled = F.when(
        last >= 1, F.transform(F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0))), lambda i: kept(F.xxhash64(*[at(i, k) for k in range(WORDS)])))
    ).when(F.size("__hashed") > 0, F.array(kept(F.xxhash64("__hashed")))).otherwise(F.array().cast("array<bigint>"))
    return [("__words", words), ("__hashed", hashed), ("__shingles", shingled)]


def densified() -> list[tuple[str, Column]]:
    """Steps that lead from shingle hashes to one value per bin, none empty unless all are."""
    empty = (1 << LOW) - 1
    sentinels = _numbers([i << LOW | empty for i in range(BINS)])
    ordered = F.sort_array(F.concat("__shingles", sentinels))
    # Two neighbours lie in different bins if they differ above the low bits.
    firsts = F.filter("__ordered", lambda x, i: (i == 0) | (x.bitwiseXOR(F.get(F.col("__ordered"), i - 1)) > empty))
    values = F.transform("__firsts", lambda x: F.when(x.bitwiseAND(F.lit(empty)) != empty, x.bitwiseAND(F.lit(empty))))
    filled = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.get(F.col("__values"), i).isNotNull())

    probes = [_numbers([(_STEP[i] * t + _SHIFT[i]) % BINS for i in range(BINS)]) for t in range(1, TRIES + 1)]

    def value(own: Column, i: Column) -> Column:
        tries = [F.get(F.col("__values"), F.get(probe, i)) for probe in probes]
        shift, back = F.get(F.col("__shift"), i), F.get(F.col("__back"), i)
        least = F.array_min(F.transform("__filled", lambda j: F.struct(((back * (j - shift + BINS) + BINS - 1) % BINS).alias("t"), j.alias("j"))))
        # named twice, so that the planner computes the filled bins once per row and not once per use
        rest = F.when(F.size("__filled") > 0, F.get(F.col("__values"), least["j"]))
        return F.coalesce(own, *tries, rest)

    return [
        ("__ordered", ordered),
        ("__firsts", firsts),
        ("__values", values),
        ("__filled", filled),
        ("__shift", _numbers(_SHIFT)),
        ("__back", _numbers(_BACK)),
        ("__dense", F.transform("__values", value)),
    ]


def packed() -> Column:
    """The low-order bits of all bins, 16 digits to a long; empty if no bin has a value."""
    pack = lambda acc, v: F.shiftleft(acc, BITS).bitwiseOR(v.bitwiseAND(F.lit((1 << BITS) - 1)))
    # Written out per long, not as a lambda over them: the planner would compute the bins once per long.
    groups = [F.slice("__dense", g * DIGITS + 1, DIGITS) for g in range(BINS // DIGITS)]
    longs = F.array(*[F.aggregate(g, F.lit(0).cast("bigint"), pack) for g in groups])
    return F.when(F.size("__shingles") > 0, longs).otherwise(F.array().cast("array<bigint>"))


def with_fingerprint(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Add the packed fingerprint of ``text`` as ``name`` (array of long numbers)."""
    before = df.columns
    # One projection per step: a step that is used several times is computed once.
    for step, column in [*shingle_hashes(text), *densified()]:
        df = df.withColumn(step, column)
    return df.select(*before, packed().alias(name))


def digits(fingerprint: Column) -> Column:
    """A fingerprint as text, one hexadecimal digit per bin."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), DIGITS, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, corrected for digits that agree by chance."""
    ones = 0x1111111111111111

    def unequal(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        z = z.bitwiseOR(F.shiftrightunsigned(z, 2))
        return F.bit_count(z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseAND(F.lit(ones)))

    differ = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda acc, n: acc + n)
    chance = 1 / (1 << BITS)
    share = (1 - differ / F.lit(float(BINS)) - chance) / (1 - chance)
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))
    )


# --- the next document ----------------------------------------------------------------------------

ORDER = ["doc_id", FILE, POS]


def followers(ids: DataFrame) -> DataFrame:
    """Every row (``ROW``, doc_id, n) with the key of the next row, ``next_file`` and ``next_pos``.

    Rows are sorted in ranges; only the first row of each range is known beyond it. There are as many of
    these as ranges, so ordering them in one task is cheap.
    """
    ordered = [F.col("doc_id").asc_nulls_last(), F.col(FILE).asc(), F.col(POS).asc()]
    ranged = ids.repartitionByRange(*ordered).withColumn("range", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), *ORDER)
    heads = ranged.groupBy("range").agg(F.min(key).alias("head"))
    around = Window.orderBy("range")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("range", F.coalesce(F.lead("head").over(around), F.first("head").over(whole)).alias("after"))
    inside = Window.partitionBy("range").orderBy(*ordered)
    following = F.coalesce(F.lead(key).over(inside), F.col("after"))
    return ranged.join(heads, "range").select(
        *ids.columns, following[FILE].alias("next_file"), following[POS].alias("next_pos")
    )


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Row key, doc_id, n_chars, digest of the edited text, both fingerprints and the key of the next document; stored.

    The edited text ends with the beginning of the next document in place of the last half of its own. The texts are
    shuffled once, and once more as much of each as the document before it needs.
    """
    keyed = with_row_key(docs)
    ids = keyed.select(*ROW, F.col("doc_id").cast("bigint").alias("doc_id"), F.char_length(whole_text()).cast("bigint").alias("n_chars"))
    links = stored(followers(ids), "followers")
    before = links.select(
        F.col("next_file").alias(FILE), F.col("next_pos").alias(POS),
        F.col(FILE).alias("to_file"), F.col(POS).alias("to_pos"), F.floor(F.col("n_chars") / 2).alias("wanted"),
    )
    around = stored(links.join(before, ROW), "neighbours")
    texts = keyed.select(*ROW, whole_text().alias("text")).join(around, ROW)
    handed = texts.select(
        F.col("to_file").alias(FILE), F.col("to_pos").alias(POS),
        F.substr("text", F.lit(1), F.col("wanted").cast("int")).alias("beginning"),
    )
    own = F.substr("text", F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int"))
    both = texts.join(handed, ROW).withColumn("edited", F.concat(own, F.col("beginning")))
    both = both.select(*ROW, "doc_id", "n_chars", "next_file", "next_pos", "text", "edited")
    both = with_fingerprint(both, F.col("text"), "fingerprint").drop("text")
    both = both.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    return stored(with_fingerprint(both, F.col("edited"), "edited_fingerprint").drop("edited"), "fingerprints")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    pairs = edited_pairs(docs)
    following = pairs.select(F.col(FILE).alias("next_file"), F.col(POS).alias("next_pos"), F.col("fingerprint").alias("next_fingerprint"))
    return pairs.join(following, ["next_file", "next_pos"]).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        digits(F.col("fingerprint")).alias("fingerprint"),
        digits(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
