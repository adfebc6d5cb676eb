"""Secret scans: patterns for known kinds, and a randomness test battery for tokens that no pattern knows.

Everything is DataFrame and SQL functions.

Patterns. For each kind the text is split at the matches: the pieces between them and the matches themselves give every
position in code points, whatever the text holds.

Battery. A run of characters of the base-64 alphabets is read in three ways (``READINGS``): as base 64, as base 64 for URLs, and
as letters and digits. Each cuts the run at the characters that it can't hold; "=" ends a piece in all of them and belongs to it
only where the run ends, as padding. So a key glued to a name by "=", "/", "+", "_" or "-" is also looked at by itself. Every
maximal piece of 20 or more characters (16 besides padding) is a candidate, a piece that several readings share once. Its encoding
is the smallest alphabet that holds it (digits, hex in one case, base 32, letters and digits, base 64 in either spelling); one of
them always does. Three tests per encoding ask whether it may be a draw of independent uniform symbols:

- chi-squared of the symbol counts against a uniform alphabet,
- runs above and below the middle of the alphabet (Wald-Wolfowitz),
- lag-one serial correlation of the symbols.

Their z-scores follow from exact means and variances for the candidate's length. A candidate that any test rejects at
``REJECT`` (Bonferroni over the three) isn't random.

False-discovery control. What passes by chance are ordinary words, and the shorter they are the easier they pass. So a second
p-value asks how likely letters drawn with the frequencies of ordinary text (of the candidates rejected above, per encoding)
would be as uniform as the candidate; its mean and variance again depend on the length. Benjamini-Hochberg at ``RATE`` runs
within strata of encoding and length over all candidates of the corpus. p-values are rounded up to a grid first, so the step-up
rule needs only counts per grid cell; the rule stays exact for the rounded values, and no stratum is ever gathered in one place.

Defined cases. Null text counts as empty. Spans are by start, then by kind in the order assign, access, hex, random. Base spans
stay as they are; a random piece that overlaps one is left out, since it is reported already. Random pieces that overlap each other
(readings of one run) make one span. Rows that repeat are scanned row by row,
whole. Other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import ROW, named, stored, whole_text, with_row_key

# The patterns of the known kinds, in the order of the report, with the rule that a match must pass.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]

LEAST = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# The characters that each reading of a run holds; padding only counts at the end of the run.
READINGS = [rf"[{held}]+(?:=+(?![A-Za-z0-9+/_=-]))?" for held in ("A-Za-z0-9+/", "A-Za-z0-9_-", "A-Za-z0-9")]
UPPER, LOWER, NUMBERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
# name, pattern of the whole token, alphabet in symbol order; the first that fits is inferred
ENCODINGS = [
    ("digits", r"^[0-9]+$", NUMBERS),
    ("hex", r"^[0-9a-f]+$", NUMBERS + "abcdef"),
    ("HEX", r"^[0-9A-F]+$", NUMBERS + "ABCDEF"),
    ("base32", r"^[A-Z2-7]+=*$", UPPER + "234567"),
    ("alnum", r"^[A-Za-z0-9]+$", UPPER + LOWER + NUMBERS),
    ("base64", r"^[A-Za-z0-9+/]+=*$", UPPER + LOWER + NUMBERS + "+/"),
    ("base64url", r"^[A-Za-z0-9_-]+=*$", UPPER + LOWER + NUMBERS + "-_"),
]
REJECT = 0.01
RATE = 0.01
GRID = 20  # cells per power of ten of p
DEEPEST = 300  # p-values below 10^-300 share a cell


SPANS = "array<struct<start:bigint,kind:int,end:bigint,match:string>>"
CHUNK = 256


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """Array of (start, kind, end, match) of all matches, leftmost and not overlapping.

    Places are running sums over gaps and matches. A fold copies what it has gathered at each step, so it runs over
    chunks of ``CHUNK`` matches, each from the place where it begins: the work grows in proportion to the matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.char_length(pair["gap"])
        end = begin + F.char_length(pair["match"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def placed(chunk: Column, begin: Column) -> Column:
        empty = F.struct(begin.alias("at"), F.array().cast(SPANS).alias("spans"))
        return F.aggregate(chunk, empty, step, lambda s: s["spans"])

    def begins(chunks: Column) -> Column:
        """The place where each chunk begins."""
        size = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda n, p: n + F.char_length(p["gap"]) + F.char_length(p["match"]))
        zero = F.array(F.lit(0).cast("bigint"))
        return F.aggregate(F.transform(chunks, size), zero, lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))

    def cut(pairs: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(pairs), F.lit(CHUNK))
        return F.transform(firsts, lambda first: F.slice(pairs, first, F.lit(CHUNK)))

    # Bound to names by the outer functions, each step is computed once per text.
    once = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)
    pairs = F.zip_with(found, F.slice(between, 1, F.greatest(F.size(found), F.lit(0))), lambda m, g: F.struct(m.alias("match"), g.alias("gap")))
    spans = once(once(pairs, cut), lambda chunks: F.flatten(F.zip_with(chunks, F.slice(begins(chunks), 1, F.size(chunks)), placed)))
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(F.array().cast(SPANS))


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end) of the known kinds, in order."""
    assigned = F.filter(_matches(text, ASSIGN, 0), lambda m: F.length(F.regexp_extract(m["match"], ASSIGN, 2)) >= 6)
    every = F.concat(assigned, _matches(text, ACCESS, 1), _matches(text, HEX, 2))
    return F.transform(F.array_sort(every), lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")))


# --- the battery ----------------------------------------------------------------------------------


def _pick(values: list) -> Column:
    """A value per inferred encoding (column ``encoding``: place in ENCODINGS)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("encoding") + 1)


def symbols() -> Column:
    """The token as places in its alphabet, padding left out."""
    chars = F.filter(F.split(F.regexp_replace("token", "=+$", ""), ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.position(c, F.col("alphabet")) - 1)


def pieces(run: Column) -> Column:
    """Array of (start, end, match) of the pieces of a run in all readings, each once; positions are those of the text."""
    cut = F.concat(*[_matches(run["match"], reading, 3) for reading in READINGS])
    long = F.filter(cut, lambda m: m["end"] - m["start"] >= LEAST)
    moved = F.transform(long, lambda m: F.struct((run["start"] + m["start"]).alias("start"), (run["start"] + m["end"]).alias("end"), m["match"].alias("match")))
    # Sorted, so that equal ones are neighbours; array_distinct would compare every pair of structs.
    apart = lambda a: F.filter(a, lambda m, i: (i == 0) | (m != F.get(a, i - 1)))
    return F.element_at(F.transform(F.array(F.array_sort(moved)), apart), 1)


def candidates(keyed: DataFrame) -> DataFrame:
    """One row per candidate: row key, start, end, token, encoding, length and the counts that the tests need; stored."""
    text = whole_text()
    runs = keyed.select(*ROW, F.explode(_matches(text, CANDIDATE, 3)).alias("run"))
    rows = runs.select(*ROW, F.explode(pieces(F.col("run"))).alias("m"))
    rows = rows.select(*ROW, F.col("m.start").alias("start"), F.col("m.end").alias("end"), F.col("m.match").alias("token"))
    encoding = F.lit(None).cast("int")
    for place, (_, pattern, _) in reversed(list(enumerate(ENCODINGS))):
        encoding = F.when(F.rlike("token", F.lit(pattern)), F.lit(place)).otherwise(encoding)
    rows = rows.withColumn("encoding", encoding)
    rows = rows.withColumn("alphabet", _pick([a for _, _, a in ENCODINGS])).withColumn("symbols", symbols())
    rows = rows.withColumn("n", F.size("symbols").cast("double")).where(F.col("n") >= 16)
    # Sum of squared symbol counts: over the alphabet, not over pairs of characters.
    squares = F.aggregate(
        F.sequence(F.lit(1), F.char_length("alphabet")),
        F.lit(0.0),
        lambda acc, i: acc + F.pow(F.length("token") - F.length(F.replace("token", F.substr("alphabet", i, F.lit(1)), F.lit(""))), F.lit(2.0)),
    )
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("runs", "high", "sum", "square", "product")], F.lit(None).cast("int").alias("last"))
    middle = F.char_length("alphabet") / 2

    def step(acc: Column, x: Column) -> Column:
        changed = (acc["last"] >= middle) != (x >= middle)
        return F.struct(
            (acc["runs"] + F.when(acc["last"].isNull() | changed, 1.0).otherwise(0.0)).alias("runs"),
            (acc["high"] + F.when(x >= middle, 1.0).otherwise(0.0)).alias("high"),
            (acc["sum"] + x).alias("sum"),
            (acc["square"] + x * x).alias("square"),
            (acc["product"] + F.coalesce(acc["last"] * x, F.lit(0)).cast("double")).alias("product"),
            x.alias("last"),
        )

    rows = rows.withColumn("squares", squares).withColumn("walk", F.aggregate("symbols", zero, step))
    kept = ["start", "end", "token", "encoding", "n", "squares", "walk.runs", "walk.high", "walk.sum", "walk.square", "walk.product"]
    rows = rows.select(*ROW, *kept, F.element_at("symbols", 1).alias("first"), F.element_at("symbols", -1).alias("final"))
    return stored(rows, "candidates")


def upper_tail(name: str) -> Column:
    """P(Z > z) of a standard normal variable for a column z: a polynomial near 0, a continued fraction far out."""
    z, x = F.col(name), F.abs(name)
    t = 1 / (1 + 0.2316419 * x)
    near = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * t * (
        0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))
    )
    far = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) / (x + 1 / (x + 2 / (x + 3 / (x + 4 / (x + 0.65)))))
    tail = F.when(x < 3, near).otherwise(far)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def randomness(found: DataFrame) -> DataFrame:
    """Add ``p_random``: the battery's p-value under independent uniform symbols."""
    size = _pick([float(len(a)) for _, _, a in ENCODINGS])
    n = F.col("n")
    chi = size / n * F.col("squares") - n
    chi_z = (chi - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
    low = n - F.col("high")
    pairs = 2 * F.col("high") * low
    runs_sd = F.sqrt(F.greatest(pairs * (pairs - n) / (n * n * (n - 1)), F.lit(1e-9)))
    runs_z = (F.col("runs") - (pairs / n + 1)) / runs_sd
    # The circular serial product, whose mean and variance under a random order of the symbols are known.
    spread = F.col("square") - F.col("sum") * F.col("sum") / n
    cyclic = F.col("product") + F.col("first") * F.col("final") - F.col("sum") * F.col("sum") / n
    serial_z = F.when(spread > 0, (cyclic / spread + 1 / (n - 1)) * F.sqrt(n)).otherwise(F.lit(99.0))
    scored = found.withColumns({"chi_z": chi_z, "runs_z": F.abs(runs_z), "serial_z": F.abs(serial_z)})
    scored = scored.withColumns({"chi_p": upper_tail("chi_z"), "runs_p": 2 * upper_tail("runs_z"), "serial_p": 2 * upper_tail("serial_z")})
    least = 3 * F.least("chi_p", "runs_p", "serial_p")
    return scored.select(*found.columns, F.least(F.lit(1.0), least).alias("p_random"))


def ordinary_moments(tested: DataFrame) -> DataFrame:
    """Per encoding the second and third moment of the symbol frequencies in the tokens that aren't random.

    Counts run over all rejected candidates. Where an encoding has none that look like text, the letters of a text are assumed to
    fill a quarter of its alphabet.
    """
    chars = tested.where(F.col("p_random") < REJECT).select("encoding", F.explode(F.split("token", "")).alias("c")).where("c not in ('', '=')")
    counts = chars.groupBy("encoding", "c").agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy("encoding").agg(F.sum("n").alias("all"))
    share = F.col("n") / F.col("all")
    return counts.join(total, "encoding").groupBy("encoding").agg(F.sum(share**2).alias("s2"), F.sum(share**3).alias("s3"))


def uniform_for_text(tested: DataFrame) -> DataFrame:
    """Add ``cell``: the grid cell (rounded up) of the p-value that ordinary characters look this uniform, and ``stratum``."""
    moments = F.broadcast(ordinary_moments(tested))  # at most one row per encoding
    size = _pick([float(len(a)) for _, _, a in ENCODINGS])
    n = F.col("n")
    # Rejected candidates that are more even than a quarter of the alphabet are no text, but random ones rejected by chance.
    textlike = F.col("s2") > 4 / size
    s2 = F.when(textlike, F.col("s2")).otherwise(4 / size)
    s3 = F.when(textlike, F.col("s3")).otherwise(16 / (size * size))
    mean = n + n * (n - 1) * s2
    variance = 4 * n * (n - 1) * (n - 2) * (s3 - s2 * s2) + 2 * n * (n - 1) * (s2 - s2 * s2)
    z = (mean - F.col("squares")) / F.sqrt(F.greatest(variance, F.lit(1e-9)))
    p = F.greatest(F.col("text_p"), F.lit(10.0**-DEEPEST))
    return (
        tested.join(moments, "encoding", "left")
        .withColumn("text_z", z)
        .withColumn("text_p", upper_tail("text_z"))
        .withColumn("cell", F.floor(-F.log10(p) * GRID).cast("int"))
        .withColumn("stratum", F.floor(F.log2(n) * 2).cast("int"))
        .drop("s2", "s3", "text_z", "text_p")
    )


def discoveries(found: DataFrame, rate: float = RATE) -> DataFrame:
    """The candidates that pass the battery and Benjamini-Hochberg in their stratum."""
    tested = stored(uniform_for_text(stored(randomness(found), "battery")), "tested")
    cells = tested.groupBy("encoding", "stratum", "cell").agg(F.count(F.lit(1)).alias("here"))
    best_first = Window.partitionBy("encoding", "stratum").orderBy(F.col("cell").desc())
    all_cells = Window.partitionBy("encoding", "stratum")
    ranked = cells.withColumn("so_far", F.sum("here").over(best_first)).withColumn("all", F.sum("here").over(all_cells))
    p = F.pow(F.lit(10.0), -F.col("cell") / GRID)
    last = ranked.where(p <= rate * F.col("so_far") / F.col("all")).groupBy("encoding", "stratum").agg(F.min("cell").alias("least_cell"))
    passed = tested.where(F.col("p_random") >= REJECT).join(F.broadcast(last), ["encoding", "stratum"])
    return passed.where(F.col("cell") >= F.col("least_cell"))


def apart_and_joined(found: DataFrame, based: DataFrame) -> DataFrame:
    """The found pieces that overlap no base span, those that overlap each other as one: row key, start, end.

    One walk over the spans of a text in each direction tells how far base spans reach from the left and from the right.
    """
    known = based.join(found.select(*ROW).distinct(), ROW, "left_semi").select(*ROW, F.explode("base").alias("b"))
    known = known.select(*ROW, F.col("b.start").alias("start"), F.col("b.end").alias("end"), F.lit(True).alias("is_base"))
    every = found.select(*ROW, "start", "end", F.lit(False).alias("is_base")).unionByName(known)
    up = Window.partitionBy(*ROW).orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*ROW).orderBy(F.col("start").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    left, right = F.max(F.when(F.col("is_base"), F.col("end"))), F.min(F.when(F.col("is_base"), F.col("start")))
    every = every.withColumn("left", left.over(up)).withColumn("right", right.over(down)).where(~F.col("is_base"))
    free = every.where(~(F.coalesce(F.col("left") > F.col("start"), F.lit(False)) | F.coalesce(F.col("right") < F.col("end"), F.lit(False))))
    order = Window.partitionBy(*ROW).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(reach <= F.col("start"), F.lit(True)).cast("int")
    numbered = free.withColumn("new", new).withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy(*ROW, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """One row per document: doc_id, ``base`` and ``spans``: arrays of (start, kind, end)."""
    keyed = with_row_key(docs)
    based = stored(keyed.select(*ROW, named("doc_id").cast("bigint").alias("doc_id"), base_spans(whole_text()).alias("base")), "base-spans")
    found = apart_and_joined(discoveries(candidates(keyed), rate), based)
    extra = found.groupBy(*ROW).agg(F.collect_list(F.struct("start", F.lit(3).alias("kind"), "end")).alias("extra"))
    both = based.join(extra, ROW, "left")
    extra = F.coalesce("extra", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    return both.select("doc_id", "base", F.array_sort(F.concat("base", extra)).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    kind = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    rows = scan(docs)
    count = lambda column, k: F.size(F.filter(column, lambda s: s["kind"] == k)).cast("bigint")
    return rows.select(
        "doc_id",
        *[count("base", k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count("spans", 3).alias("n_random"),
    )
