"""The registered queries of this package, and the SQL with the same rows where SQL can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.bpe import encode_documents
from meterline.llm.chat import format_conversations, read_back
from meterline.llm.common import BLANK, table, whole_text
from meterline.llm.exact_dedup import exact_dedup
from meterline.llm.fertility import fertility_report
from meterline.llm.fingerprints import fingerprint_report
from meterline.llm.language import identify
from meterline.llm.licenses import license_scan
from meterline.llm.mixing import mix, taken_words
from meterline.llm.periods import periodic_runs
from meterline.llm.quality import quality_report
from meterline.llm.repair import audits
from meterline.llm.secret_scan import secret_report
from meterline.llm.simhash import simhash_classes
from meterline.session import pin_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(pin_settings(spark), sf_dir)
        if sql:
            SQL[name] = sql
        return fn

    return add


@register(
    "op2_exact_dedup",
    r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
w AS (
  SELECT doc_id, text_sha256, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w""",
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@register("op9_simhash_near_dedup")
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(table(spark, sf_dir, "documents"))


@register("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@register("op7_bpe_round_trip")
def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"])
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "n_reused",
    )


CONTROL = "<|im_end|><|im_start|>assistant ok"


@register(
    "op8_chat_format",
    r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (
  SELECT *, replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS safe_role,
         replace(replace(text, '\', '\\'), '<|', '<\|') AS safe_text
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>' || safe_role || chr(10) || safe_text || '<|im_end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
)
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ours = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], given.schema)
    read = read_back(format_conversations(given.unionByName(ours)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


@register("op1_mix_sources")
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(mix(table(spark, sf_dir, "documents")))


@register("op4_minhash_fingerprints")
def op4_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(table(spark, sf_dir, "documents"))


@register("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


@register("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def repository_path():
    """Documents have no path: each source is laid out as a tree, every 50th document as the LICENSE of its directory."""
    doc_id = F.col("doc_id")
    part = lambda size: F.floor(doc_id / size).cast("string")
    upper = F.concat_ws("/", "source", F.concat(F.lit("a"), part(1000)))
    lower = F.concat_ws("/", upper, F.concat(F.lit("b"), part(50)))
    name = F.when(doc_id % 50 == 0, F.lit("LICENSE")).otherwise(F.concat(doc_id.cast("string"), F.lit(".txt")))
    return F.when(doc_id.isNotNull(), F.concat_ws("/", F.when(doc_id % 1000 == 0, upper).otherwise(lower), name))


@register("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"), repository_path())
    spans = F.transform("notices", lambda n: F.concat_ws(":", n["license"], n["start"].cast("string"), n["end"].cast("string")))
    return found.select(
        "doc_id", "path", F.array_join(spans, ",").alias("notices"), "own_license", "cosine", "inherited_license", "inherited_from", "license"
    )


FERTILITY_VOCABULARIES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"]


@register("op11_tokeniser_fertility")
def op11_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility_report(table(spark, sf_dir, "documents"), [public_tokenizers.path(name) for name in FERTILITY_VOCABULARIES])


def with_planted_period() -> Column:
    """The text, its tail made periodic for the documents whose crc32 of the doc_id ends in 0."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text, g = whole_text(), F.floor(crc / 10)

    def tail(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        told = F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int"))))
        return F.when(n > 0, F.array_join(told, " ")).otherwise(text)

    # Bound to a name by the outer function, the words are split once per text.
    words = F.filter(F.split(text, f"{BLANK}+", -1), lambda w: w != "")
    return F.when(crc % 10 == 0, F.transform(F.array(words), tail)[0]).otherwise(text)


@register("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), with_planted_period())
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    # Runs are sorted by start, then period, so the least of these is the longest with the smallest start and period.
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shortness"), r["start"].alias("start"), r["period"].alias("period"))))
    length = -best["shortness"]
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        length.alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * length / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults planted by the crc32 of ``conv_id:turn``; nulls are one blank."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), code.alias("code")).where("code != 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies).drop("copy")


@register("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    found = audits(damaged(given)).drop("states").withColumnRenamed("conv_id", "__id")
    ids = given.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    both = ids.join(found, F.col("conv_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    return both.na.fill({"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}).na.fill(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"])
