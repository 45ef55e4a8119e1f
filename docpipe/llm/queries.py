"""Named queries: each operator over its whole given table, and the SQL that some can be held to."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.llm import (
    bpe,
    divergence,
    exact_dedup,
    language,
    lm_score,
    minhash,
    passages,
    prefix_trie,
    templates,
    training_order,
    transcripts,
    url_rules,
    warc,
)
from docpipe.llm.tables import table
from docpipe.scratch import scratch_table


def op4_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Exact copies among all documents; the largest doc_id of equal texts stays."""
    return exact_dedup.mark(table(spark, sf, "documents"), "doc_id", "text")


def _held_out(doc_id: str):
    """A quarter of the documents, which no model learns from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def language_model(docs: DataFrame) -> language.Model:
    return language.fit(docs.where(~_held_out("doc_id")), "doc_id", "text", "lang")


def op1_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Every page written to dictionary-compressed archives and read back."""
    manifest = warc.write_archives(
        table(spark, sf, "pages"), "page_id", "url", "html", scratch_table(spark, "warc"))
    return warc.read_archives(manifest).select(
        F.col("record_key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every whole document, learned from labelled ones that are not held out."""
    docs = table(spark, sf, "documents")
    texts = docs.select("doc_id", _held_out("doc_id").alias("held_out"), "text")
    return language.identify(texts, "text", language_model(docs), keep=["doc_id", "held_out"])


def op5_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(table(spark, sf, "documents"), "doc_id", "text")


#: How speakers are marked in the transcripts made of the conversations; the last style marks nobody.
STYLES = (
    {"user": "User: ", "assistant": "Assistant: ", "system": "System: "},
    {"user": "### Human: ", "assistant": "### AI: ", "system": "### Instructions: "},
    {"user": "Q: ", "assistant": "A: ", "system": "Context: "},
    {},
)


def op6_chat_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """Roles of all conversation turns, recovered from transcripts without their role column. The model
    learns from conversations that are not held out."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    style = F.pmod(F.xxhash64(F.lit("style"), "conv_id"), F.lit(len(STYLES)))
    mark = F.lit("")
    for i, marks in enumerate(STYLES):
        for role, text in marks.items():
            mark = F.when((style == i) & (F.col("role") == role), F.lit(text)).otherwise(mark)
    written = turns.withColumn("text", F.concat(mark, F.coalesce("text", F.lit(""))))
    blocks = transcripts.ordered(written, "conv_id", "turn", "text", "role")
    model = transcripts.fit(blocks.where(~_held_out("conv")))
    return transcripts.parse(blocks, model).select(
        F.col("conv").alias("conv_id"), F.col("ord").alias("turn"), _held_out("conv").alias("held_out"),
        "role_pred", "begins_turn", "turns", "rendered")


def tokenizer_path() -> str:
    """Where the rank file of the multilingual byte-level vocabulary is."""
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op7_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of every whole document, and the bytes they decode to."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, "text", tokenizer_path(), keep=["doc_id"])
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    encoded = encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                             F.sha2(listed, 256).alias("ids_sha256"), "ids")
    decoded = bpe.decode(encoded, "ids", tokenizer_path(), keep=["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_training_order(spark: SparkSession, sf: str) -> DataFrame:
    """Every token sequence of all documents, written in training order and read back."""
    manifest = training_order.materialise(
        table(spark, sf, "documents"), "doc_id", "text", tokenizer_path(), scratch_table(spark, "sequences"))
    return training_order.read(manifest).select(
        F.col("doc").alias("doc_id"), "window", "slot", F.col("count").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"))


def op8_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that hold a benchmark item, word for word or re-parameterised."""
    return templates.matches(table(spark, sf, "documents"), "doc_id", "text",
                             table(spark, sf, "benchmark"), "item_id", "text")


def op9_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Passages of 50 words or more that documents share, exactly or nearly."""
    return passages.repeated_passages(table(spark, sf, "documents"), "doc_id", "text")


LISTED = [
    url_rules.Listed("allow", "org", "/"),
    url_rules.Listed("block", "example.org", "/es/"),
    url_rules.Listed("block", "example.org", "/en/1"),
    url_rules.Listed("allow", "com", "/fr/"),
    url_rules.Listed("block", "com", "/de/"),
]


def op10_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Verdict on every page: listed rules, else rules mined from the labels of pages (a label's doc_id
    is taken as the page's id; low quality or toxic is bad)."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return url_rules.judge(table(spark, sf, "pages"), "page_id", "url", table(spark, sf, "labels"),
                           "doc_id", bad, LISTED)


def op13_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    """How far every source of every language is from the other sources, and its most over-used terms."""
    return divergence.audit(table(spark, sf, "documents"), "lang", "source", "text")


def rebuilt_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conv_id c (null ones are no conversation) rebuilt from the first h turns of conversation
    c - c % 5 (all if fewer, none if absent) and c's own turns after its first h; h = crc32 of c in
    decimal, mod 9. Returns (turns: conv, pos, role, text; conversations: conv)."""
    ordered = prefix_trie.ordered_turns(turns.where(F.col("conv_id").isNotNull()), "conv_id", "turn", "role", "text")
    convs = ordered.select("conv").distinct().select(
        "conv", (F.col("conv") - F.col("conv") % 5).alias("base"),
        (F.crc32(F.col("conv").cast("string").cast("binary")) % 9).alias("h"))
    borrowed = ordered.alias("t").join(
        convs.alias("c"), (F.col("t.conv") == F.col("c.base")) & (F.col("t.pos") < F.col("c.h"))).select(
        F.col("c.conv").alias("conv"), "t.pos", "t.role", "t.text")
    own = ordered.join(convs, "conv").where(F.col("pos") >= F.col("h")).select("conv", "pos", "role", "text")
    return borrowed.unionByName(own), convs.select("conv")


def op12_conversation_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Prefix trie of all rebuilt conversations: one row per distinct sequence of first turns."""
    turns, convs = rebuilt_conversations(table(spark, sf, "conversations"))
    return prefix_trie.trie_of(turns, convs)


def _held_out_7(doc_id: str):
    """A seventh of the documents, which the language model does not learn from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def op11_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    """Log10 probability of every whole document under a hierarchical Pitman-Yor trigram model learned
    from the documents that are not held out, beside an add-one unigram baseline."""
    docs = table(spark, sf, "documents").select("doc_id", "text", _held_out_7("doc_id").alias("held_out"))
    model = lm_score.fit(docs.where(~F.col("held_out")), "text")
    return lm_score.score(docs, "doc_id", "text", model, keep=["doc_id", "held_out"])


QUERIES = {
    "op1_warc": op1_warc,
    "op2_language_id": op2_language_id,
    "op3_training_order": op3_training_order,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_minhash": op5_minhash,
    "op6_chat_transcripts": op6_chat_transcripts,
    "op7_bpe": op7_bpe,
    "op8_decontaminate": op8_decontaminate,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_url_rules": op10_url_rules,
    "op11_lm_score": op11_lm_score,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_source_divergence": op13_source_divergence,
}
