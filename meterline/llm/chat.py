"""Reply trees to chat-formatted conversations, with a loss mask over the assistant's texts.

Messages name their parent; a message without one is a root. Self-joins by doubling enumerate the paths: after k joins
every message knows its ancestor 2^k steps up, its depth and the score summed over the way, so a tree of
depth d takes log2(d) joins instead of d. Paths from root to leaf are ranked by score (mean over the path, then longer,
then by the leaf's id). The messages of the chosen paths are found by walking the stored jumps down again,
largest first, so only rows on chosen paths are ever made: nothing is multiplied by the number of leaves.

Formatting escapes control strings inside texts and roles reversibly: a backslash becomes two, ``<|`` becomes ``<\\|``,
and a line break in a role becomes ``\\n``. So the markers of the template stand nowhere but at turns, and ``read_back``
restores every turn and everything under the loss mask from the formatted text alone.

Defined cases. Null text and null role count as empty. Rows of a conversation are ordered by turn, null turns last;
rows that repeat a turn follow one another by role and text. A null conv_id is one conversation of its own. A conversation
is the unit of the output and is put together in one task, from rows that were sorted by Spark. Other columns
are not looked at; empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import stored

# The markers of the template.
START = "<|im_start|>"
END = "<|im_end|>"
LEARNED = "assistant"

Jumps = list[DataFrame]


# --- reply trees ----------------------------------------------------------------------------------


def climb(messages: DataFrame) -> tuple[DataFrame, Jumps]:
    """``root, depth, total`` of every message, and the jump tables (``node, up``: 2^k steps) of the climb.

    ``messages`` has ``node``, ``parent`` (null for a root; of unknown parents too) and ``score``. A message on a circle
    of replies has no root and is left out.
    """
    known = messages.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    state = messages.join(known, "parent", "left").select(
        "node",
        F.when(F.col("known"), F.col("parent")).alias("up"),
        F.lit(1).cast("bigint").alias("depth"),
        F.col("score").cast("double").alias("total"),
    )
    state = stored(state, "climb")
    settled, rising, jumps = [state.where(F.col("up").isNull())], state.where(F.col("up").isNotNull()), []
    for _ in range(state.count().bit_length() + 1):
        if rising.isEmpty():
            break
        jumps.append(rising.select("node", "up"))
        # Only messages that are still rising are joined: few trees are deep.
        known = reduce(DataFrame.unionByName, [*settled, rising])
        above = known.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("total").alias("add"))
        risen = rising.join(above, "up").select(
            "node",
            F.col("next").alias("up"),
            (F.col("depth") + F.col("more")).alias("depth"),
            (F.col("total") + F.col("add")).alias("total"),
        )
        risen = stored(risen, "climb")
        settled.append(risen.where(F.col("up").isNull()))
        rising = risen.where(F.col("up").isNotNull())
    return reduce(DataFrame.unionByName, settled).select("node", "depth", "total"), jumps


def _walk(start: DataFrame, jumps: Jumps, carried: list[str]) -> DataFrame:
    """All ancestors of the nodes of ``start``, themselves included, with ``carried`` and ``height`` above the start."""
    reached = start.withColumn("height", F.lit(0).cast("bigint"))
    for k in reversed(range(len(jumps))):
        higher = reached.join(jumps[k], "node").select(
            F.col("up").alias("node"), *carried, (F.col("height") + (1 << k)).alias("height")
        )
        reached = stored(reached.unionByName(higher), "paths")
    return reached


def best_paths(messages: DataFrame, paths: int = 1) -> DataFrame:
    """The ``paths`` best root-to-leaf paths of every tree: ``root, path_rank, place, node``.

    Ties of the mean score go to the longer path, then to the smaller leaf.
    """
    climbed, jumps = climb(messages)
    parents = messages.select(F.col("parent").alias("node")).distinct()
    leaves = climbed.join(parents, "node", "left_anti").select("node", "depth", (F.col("total") / F.col("depth")).alias("mean"))
    roots = _tops(leaves.select("node"), jumps)
    # A rank of k within a tree of any size: partial top-k per slice of the tree, then over the slices.
    order = [F.col("mean").desc_nulls_last(), F.col("depth").desc(), F.col("node").asc()]
    ranked = leaves.join(roots, "node")
    slices = ranked.withColumn("slice", F.pmod(F.xxhash64("node"), F.lit(64)))
    near = slices.withColumn("r", F.row_number().over(Window.partitionBy("root", "slice").orderBy(*order))).where(F.col("r") <= paths)
    best = near.withColumn("path_rank", F.row_number().over(Window.partitionBy("root").orderBy(*order))).where(F.col("path_rank") <= paths)
    start = stored(best.select("node", "root", "path_rank", "depth"), "best")
    on_path = _walk(start, jumps, ["root", "path_rank", "depth"])
    return on_path.select("root", "path_rank", (F.col("depth") - F.col("height")).alias("place"), "node")


def _tops(nodes: DataFrame, jumps: Jumps) -> DataFrame:
    """``node, root`` of the given nodes: the largest jumps that stay inside the tree, one after the other."""
    at = nodes.select("node", F.col("node").alias("root"))
    for k in reversed(range(len(jumps))):
        step = jumps[k].select(F.col("node").alias("root"), "up")
        at = stored(at.join(step, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "tops")
    return at


# --- the template ---------------------------------------------------------------------------------


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def _unescaped_role(role: Column) -> Column:
    # a line break is written with one backslash, so with an odd number of them before the n
    return F.regexp_replace(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"), r"\\([\\|])", "$1")


def format_turns(turns: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per value of ``key``: ``formatted`` and ``loss_spans`` (begin, end in code points, one per assistant turn).

    ``turns`` has ``role`` and ``text``; the turns of a conversation are sorted by ``order``.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    tail = f"{END}\n"
    pieces = turns.select(
        key,
        F.struct(*order).alias("place"),
        F.concat(F.lit(START), _escaped_role(role), F.lit("\n")).alias("head"),
        escaped(text).alias("body"),
        (role == LEARNED).alias("learned"),
    ).withColumn("size", F.char_length("head") + F.char_length("body") + F.lit(len(tail)))
    so_far = Window.partitionBy(key).orderBy("place", "head", "body").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spots = pieces.withColumn("end", F.sum(F.col("size").cast("bigint")).over(so_far) - len(tail))
    turn = F.struct("end", F.concat("head", "body").alias("said"), "learned", (F.col("end") - F.char_length("body")).alias("begin"))
    gathered = spots.select(key, turn.alias("t")).groupBy(key).agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return gathered.select(
        key,
        F.array_join(F.transform("ts", lambda t: F.concat(t["said"], F.lit(tail))), "").alias("formatted"),
        F.transform(F.filter("ts", lambda t: t["learned"]), lambda t: F.struct(t["begin"].alias("begin"), t["end"].alias("end"))).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Add ``turns`` (role, text) and ``learned`` (text under the loss mask), from ``formatted`` and its spans alone."""
    pieces = F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, 1 << 30)
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            _unescaped_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescaped(
                F.substr(p, F.instr(p, "\n") + 1, F.char_length(p) - F.instr(p, "\n") - len(END) - 1)
            ).alias("text"),
        ),
    )
    # Spans are one per learned turn, in order. A text ends where its turn's tail begins, so each is cut out of its
    # own piece: the work is linear in the conversation, where positions in the whole would be counted from its start.
    own = F.filter(pieces, lambda p: F.substring_index(p, "\n", 1) == LEARNED)
    size = lambda s: (s["end"] - s["begin"]).cast("int")
    texts = F.zip_with(own, "loss_spans", lambda p, s: unescaped(F.substr(p, F.char_length(p) - len(END) - size(s), size(s))))
    learned = F.array_join(texts, "")
    return formatted.select("*", turns.alias("turns"), learned.alias("learned"))


# --- conversations --------------------------------------------------------------------------------


def as_replies(conversations: DataFrame) -> DataFrame:
    """Rows by turn as messages: each replies to the one before it in its conversation, the first to nobody."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), F.col("role"), F.col("text"))
    numbered = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
        (F.row_number().over(order) - 1).cast("bigint").alias("turn"),
    )
    name = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    node = lambda turn: F.concat_ws(":", name, turn.cast("string"))
    return numbered.select(
        "conv_id", "turn", "role", "text", node(F.col("turn")).alias("node"),
        F.when(F.col("turn") > 0, node(F.col("turn") - 1)).alias("parent"), F.lit(0.0).alias("score"),
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """The best path of every conversation's tree, formatted: ``conv_id, formatted, loss_spans``."""
    messages = stored(as_replies(conversations), "messages")
    chosen = best_paths(messages.select("node", "parent", "score"))
    heads = messages.where(F.col("parent").isNull()).select(F.col("node").alias("root"), "conv_id")
    turns = chosen.join(messages.select("node", "role", "text"), "node")
    return format_turns(turns, "root", [F.col("place")]).join(heads, "root").select("conv_id", "formatted", "loss_spans")
