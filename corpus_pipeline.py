"""The training-data pipeline: each stage calls one operator and hands its rows to the next as Parquet."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.bpe import encode_documents
from meterline.llm.common import stored, table
from meterline.llm.exact_dedup import drop_copies
from meterline.llm.mixing import mixed_documents
from meterline.llm.quality import keep_good
from meterline.llm.simhash import drop_near_copies
from meterline.session import pin_settings


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose perplexity lies within the limits of their language."""
    return keep_good(docs, table(pin_settings(spark), sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    pin_settings(spark)
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, by three-word shingles and two bits."""
    pin_settings(spark)
    return drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in the weights of the mix: one row for each run of words it takes of a document."""
    pin_settings(spark)
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every row of the mix (little-endian unsigned 32-bit), and the digests of ids and decoded text."""
    pin_settings(spark)
    coded = encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id", "source"])
    return coded.select(
        "doc_id",
        "source",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("mix_sources", mixture),
    ("bpe_encode", tokens),
]

# Model scores, XXH64 fingerprints and the mix's draws are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, one after the other."""
    docs = table(pin_settings(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
