"""From raw documents to tokens: the stages of the training corpus, each written and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.llm import bpe, exact_dedup, language, minhash, templates
from docpipe.llm.queries import language_model, tokenizer_path
from docpipe.llm.tables import stored, table
from docpipe.session import ship_package


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language (no letter at all) go. The model is learned from the
    labelled documents given."""
    ship_package(spark)
    return language.keep_known(docs, "text", language_model(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    ship_package(spark)
    return exact_dedup.keep_one(docs, "doc_id", "text")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate component the document with the smallest id stays."""
    ship_package(spark)
    return minhash.keep_one(docs, "doc_id", "text")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship_package(spark)
    return templates.clean(docs, "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document that is left, and the digest of the bytes they decode to: doc_id, n_tokens,
    ids, offsets (bytes), decoded_sha256."""
    ship_package(spark)
    # Written in between: chained, a task would hold two Python workers, one for each direction.
    encoded = stored(bpe.encode(docs, "text", tokenizer_path(), keep=["doc_id"]), "encoded")
    decoded = bpe.decode(encoded, "ids", tokenizer_path(), keep=["doc_id", "ids", "offsets"])
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "offsets",
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("minhash_near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("bpe_tokens", tokens),
]

# A language model and merged pieces are beyond SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
