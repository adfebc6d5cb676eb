"""Mixing sources to target weights: packed blocks, multinomial draws, permuted indices, a join by index.

Everything is DataFrame and SQL functions.

1. ``sized`` counts the words of every text once and stores only the counts.
2. ``shares`` sets the target of each source: its weight's part of ``share`` x all words, no more than ``most`` times
   its own words; what is above goes to the other sources by weight until none is above.
3. ``placed`` lays the documents of a source end to end in a pseudorandom order, so word offsets cut the source into
   blocks of ``block`` words (the last one shorter). The running sums go through chunks of about ``CHUNK`` documents, so a hot
   source is spread over as many tasks as it has chunks.
4. ``slots`` gives each source as many slots of the output as its target needs. A pseudorandom permutation of all slots deals them to
   output shards of ``shard`` slots. That is the multinomial draw of source counts per shard, conditioned on the targets:
   within a shard the counts vary like independent draws, over all shards they add up exactly. Slot k of a source takes
   the block that the source's own index permutation gives for k; every round over the source has another permutation.
5. ``pieces`` joins slots and blocks by (source, block index).

A permutation is a keyed Feistel network on a grid of about the needed size, walked until it is inside. It is a
bijection, so no round takes a block twice, and since a target is ``most`` times the source at most, neither does the mix
take any word more than ``most`` times. All draws are hashes of stable values: reruns agree.

Defined cases. Null text and text without words have size 0 and are never taken; a null source is a source of its own,
last in order. Rows that repeat a doc_id are rows of their own (rows alike in all looked-at columns may swap places).
Sources without words get target 0. Other columns are not looked at; an empty table gives an empty result. The table of
sources (one row each) is ranked in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import ROW, WORD, named, passes_columns, stored, whole_text, with_row_key

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK = 128
SHARD = 1024
CHUNK = 4096
ROUNDS = 3
WALKS = 40


@dataclass(frozen=True)
class Mix:
    """The tables of a mix; all are stored."""

    documents: DataFrame  # row key, doc_id, source, size, first: word offset in its source
    sources: DataFrame  # source, rank, weight, source_size, target, blocks, slots, first_slot
    slots: DataFrame  # source rank, round, block, shard, position
    pieces: DataFrame  # source rank, first, shard, position, round, block, from_word, to_word


def sized(keyed: DataFrame) -> DataFrame:
    """Row key, doc_id, source, number of words and digest of every document."""
    return stored(
        keyed.select(
            *ROW,
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.regexp_count(whole_text(), F.lit(WORD)).cast("bigint").alias("size"),
            F.unhex(F.sha2(whole_text().cast("binary"), 256)).alias("digest"),
        ),
        "sizes",
    )


def shares(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """Target, blocks and slots of every source."""
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("rank", (F.row_number().over(everything) - 1).cast("bigint"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("most", (F.col("source_size") * most).cast("double"))
    # Sources reach their cap in the order of cap / weight, so running sums tell who does.
    by_cap = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy(F.lit(0))
    level = (
        F.sum("source_size").over(all_rows) * share - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    filled = ranked.withColumn("level", level)
    # The first source below its cap has the level of all the others; behind it the level only falls.
    below = F.when(F.col("most") > F.col("level") * F.col("weight"), F.col("level"))
    out = filled.withColumn("final", F.max(below).over(all_rows))
    out = out.withColumn("target", F.least(F.col("most"), F.coalesce(F.col("final") * F.col("weight"), F.col("most"))))
    out = out.withColumn("blocks", F.ceil(F.col("source_size") / block))
    needed = F.when(F.col("source_size") > 0, F.round(F.col("target") * F.col("blocks") / F.col("source_size"))).otherwise(0)
    out = out.withColumn("slots", F.least(needed.cast("bigint"), F.col("blocks") * most))
    so_far = F.sum("slots").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = out.withColumn("first_slot", so_far - F.col("slots")).withColumn("all_slots", F.sum("slots").over(all_rows))
    return stored(out.select("source", "rank", "weight", "source_size", "target", "blocks", "slots", "first_slot", "all_slots"), "shares")


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """The documents with ``rank`` of their source and ``first``: where they begin in its run of words."""
    chunks = max(1, -(-sizes.count() // CHUNK))
    order = F.xxhash64(F.lit("order"), "doc_id", "digest")  # the text tells rows apart that repeat a doc_id
    known = F.broadcast(sources.select("source", "rank")) if sources.count() <= CHUNK else sources.select("source", "rank")
    rows = sizes.join(known, sizes["source"].eqNullSafe(known["source"])).drop(known["source"])
    rows = rows.withColumn("order", order)
    rows = stored(rows.withColumn("chunk", F.pmod("order", F.lit(chunks))), "chunked")
    sums = rows.groupBy("rank", "chunk").agg(F.sum("size").alias("words"))
    up_to = Window.partitionBy("rank").orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = stored(sums.withColumn("chunk_first", F.sum("words").over(up_to) - F.col("words")).drop("words"), "chunks")
    within = Window.partitionBy("rank", "chunk").orderBy("order", "doc_id", "digest", *ROW).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = rows.withColumn("inner", F.sum("size").over(within) - F.col("size")).join(starts, ["rank", "chunk"])
    return stored(laid.withColumn("first", F.col("chunk_first") + F.col("inner")).drop("chunk", "chunk_first", "inner", "order", "digest"), "placed")


def permuted(index: Column, size: Column, *key: Column) -> Column:
    """The place of ``index`` in a keyed pseudorandom permutation of 0 .. size - 1."""
    wide = F.greatest(F.ceil(F.sqrt(size.cast("double"))).cast("bigint"), F.lit(1).cast("bigint"))
    high = F.greatest(F.ceil(size / wide).cast("bigint"), F.lit(1).cast("bigint"))

    def both(acc: Column, turn: Column) -> Column:
        left = F.pmod(acc["l"] + F.pmod(F.xxhash64(F.lit(1), turn, acc["r"], *key), wide), wide)
        right = F.pmod(acc["r"] + F.pmod(F.xxhash64(F.lit(2), turn, left, *key), high), high)
        return F.struct(left.alias("l"), right.alias("r"))

    def once(x: Column) -> Column:
        grid = F.struct((x % wide).alias("l"), F.floor((x - x % wide) / wide).cast("bigint").alias("r"))
        turns = F.array(*[F.lit(i) for i in range(ROUNDS)])
        return F.aggregate(turns, grid, both, lambda s: s["r"] * wide + s["l"])

    def walk(acc: Column, _: Column) -> Column:
        return F.when((acc >= 0) & (acc < size), acc).otherwise(once(F.when(acc < 0, -acc - 1).otherwise(acc)))

    # -index - 1 marks what has not been moved yet
    steps = F.sequence(F.lit(0), F.lit(WALKS))
    found = F.aggregate(steps, -index.cast("bigint") - 1, walk)
    return F.when((found >= 0) & (found < size), found).otherwise(F.raise_error(F.lit("a permutation walk did not end")).cast("bigint"))


def slots(documents: DataFrame, sources: DataFrame, most: int = MOST, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """Every slot of the output: the source's rank, the round, the block it takes, and its shard and position there.

    Slot k of a source comes from the document in which block k mod blocks begins, so the rows of a hot
    source come from as many tasks as its documents.
    """
    facts = sources.select("rank", "blocks", "slots", "first_slot", "all_slots")
    facts = F.broadcast(facts) if sources.count() <= CHUNK else facts
    begins = documents.where("size > 0").join(facts, "rank").select(
        "rank", "blocks", "slots", "first_slot", "all_slots",
        F.ceil(F.col("first") / block).alias("low"),
        F.ceil((F.col("first") + F.col("size")) / block).alias("high"),
    )
    each = begins.where("low < high").withColumn("index", F.explode(F.sequence("low", F.col("high") - 1))).drop("low", "high")
    turns = each.withColumn("round", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(most)])))
    turns = turns.withColumn("k", F.col("round") * F.col("blocks") + F.col("index")).where(F.col("k") < F.col("slots"))
    dealt = turns.select(
        "rank",
        "round",
        permuted(F.col("index"), F.col("blocks"), F.lit(3), F.col("rank"), F.col("round")).alias("block"),
        permuted(F.col("first_slot") + F.col("k"), F.col("all_slots"), F.lit(4)).alias("place"),
    )
    return stored(
        dealt.select("rank", "round", "block", F.floor(F.col("place") / shard).cast("bigint").alias("shard"), (F.col("place") % shard).alias("position")),
        "slots",
    )


def pieces(documents: DataFrame, drawn: DataFrame, block: int = BLOCK) -> DataFrame:
    """The words of each document that each slot takes: ``from_word`` to ``to_word``, counted in the document."""
    spans = documents.where("size > 0").select(
        "rank", "first", "size",
        F.explode(
            F.sequence(F.floor(F.col("first") / block), F.floor((F.col("first") + F.col("size") - 1) / block))
        ).alias("block"),
    )
    begin = F.greatest(F.col("block") * block, F.col("first")) - F.col("first")
    end = F.least((F.col("block") + 1) * block, F.col("first") + F.col("size")) - F.col("first")
    cut = spans.select("rank", "block", "first", begin.alias("from_word"), end.alias("to_word"))
    return stored(cut.join(drawn, ["rank", "block"]), "pieces")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK, shard: int = SHARD) -> Mix:
    """Draw the mix."""
    return mix_keyed(with_row_key(docs), weights, share, most, block, shard)


def mix_keyed(keyed: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK, shard: int = SHARD) -> Mix:
    """Draw the mix of rows that have their row key."""
    sizes = sized(keyed)
    sources = shares(sizes, weights, share, most, block)
    documents = placed(sizes, sources)
    drawn = slots(documents, sources, most, shard, block)
    return Mix(documents, sources, drawn, pieces(documents, drawn, block))


def taken_words(mixed: Mix) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    taken = mixed.pieces.groupBy("rank", "first").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    taken = taken.withColumn("some", F.lit(True))
    facts = mixed.sources.select("rank", "source_size", "target")
    rows = mixed.documents.withColumn("some", F.col("size") > 0)
    return rows.join(taken, ["rank", "first", "some"], "left").join(facts, "rank").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), "source"
    )


@passes_columns
def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """The mix in the columns of ``docs``: one row for each unbroken run of words that a round takes of a document.

    A text that is taken in full stays as it is. Of others the run is the part of the text from the start of its first word to the
    end of its last one, with all white space between. ``n_chars``, where there is one, is the length of the new text; all other
    columns are those of the document.
    """
    keyed = with_row_key(docs)
    mixed = mix_keyed(keyed, weights, share, most, block, shard)
    along = Window.partitionBy("rank", "first", "round").orderBy("from_word")
    islands = mixed.pieces.withColumn("island", F.col("block") - F.row_number().over(along))
    runs = islands.groupBy("rank", "first", "round", "island").agg(F.min("from_word").alias("__from"), F.max("to_word").alias("__to"))
    per_doc = runs.groupBy("rank", "first").agg(F.array_sort(F.collect_list(F.struct("round", "__from", "__to"))).alias("__runs"))
    found = per_doc.join(mixed.documents.where("size > 0").select(*ROW, "rank", "first", "size"), ["rank", "first"])
    found = found.select(*ROW, "__runs", F.col("size").alias("__size"))
    partly = F.exists("__runs", lambda r: r["__to"] - r["__from"] < F.col("__size"))
    words = F.when(partly, F.regexp_extract_all(whole_text(), F.lit(f"({WORD})")))
    gaps = F.slice(F.split(whole_text(), WORD, -1), F.lit(2), F.size("__words"))  # the white space behind each word

    def text(run: Column) -> Column:
        length = run["__to"] - run["__from"]
        spaced = F.array_join(F.slice("__spaced", (run["__from"] + 1).cast("int"), (length - 1).cast("int")), "")
        part = F.concat(spaced, F.element_at("__words", run["__to"].cast("int")))
        return F.when(length == F.col("__size"), F.col("__text")).otherwise(part)

    rows = keyed.join(found, ROW).withColumn("__words", words).withColumn("__text", whole_text())
    rows = rows.withColumn("__spaced", F.when(F.col("__words").isNotNull(), F.zip_with("__words", gaps, lambda w, g: F.concat(w, g))))
    rows = rows.withColumn("text", F.explode(F.transform("__runs", text)))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*[named(c) for c in docs.columns])
