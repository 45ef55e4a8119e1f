"""Documents -> chunk rows. Every operator here is one narrow projection followed by an explode."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpipe.functions import text as t
from docpipe.functions.columns import let, struct_of
from docpipe.functions.vectors import neighbour_cosine, neighbour_word_cosine


def _rows(docs: DataFrame, pieces: Column, text_col: str) -> DataFrame:
    kept = [c for c in docs.columns if c != text_col]
    return docs.select(*kept, F.posexplode(pieces).alias("chunk_index", "chunk")).select(
        *kept, "chunk_index", "chunk.*")


def chunk_recursive(
    docs: DataFrame,
    limit: int = t.DEFAULT_LIMIT,
    levels: Sequence[tuple[str, str]] = t.MARKDOWN_LEVELS,
    text_col: str = "text",
) -> DataFrame:
    """Markdown chunks with offsets; size is counted in characters."""
    spans = t.with_offsets(t.recursive_chunks(F.col(text_col), limit, levels))
    return _rows(docs, spans, text_col).withColumn(
        "token_count", F.col("end_index") - F.col("start_index"))


def chunk_tokens(
    docs: DataFrame,
    size: int = 512,
    overlap: int = 0,
    text_col: str = "text",
    tokenizer: Callable[[Column], Column] = t.tokens,
) -> DataFrame:
    """Fixed windows of ``size`` tokens. ``tokenizer`` maps a text column to an array of pieces that
    concatenate to the text; a pandas UDF around any vocabulary fits."""
    return _rows(docs, t.token_windows(tokenizer(F.col(text_col)), size, overlap), text_col)


def split_sentences(docs: DataFrame, text_col: str = "text") -> DataFrame:
    kept = [c for c in docs.columns if c != text_col]
    return docs.select(
        *kept, F.posexplode(t.sentences(F.col(text_col))).alias("sentence_index", "sentence"))


def chunk_semantic(
    docs: DataFrame,
    min_tokens: int = 50,
    max_tokens: int = 200,
    threshold: float = 0.5,
    text_col: str = "text",
    embed_sentences: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Sentence groups cut where neighbouring sentences differ, within the token bounds.

    ``embed_sentences`` maps an array<string> column to an array of vectors; by default sentences
    are compared as hashed bags of words. A document's sentences never leave its row, so nothing is
    shuffled.
    """
    cut = docs.withColumn("_parts", t.sentences_within(F.col(text_col), max_tokens))
    parts = F.col("_parts")
    if embed_sentences is None:
        # Two sentences at a time, where a chunk could end: most places are never compared.
        grouped = let(parts, lambda parts: t.group_sentences(
            parts, lambda at: F.get(neighbour_word_cosine(F.slice(parts, at, F.lit(2))), F.lit(1)),
            min_tokens, max_tokens, threshold))
    else:
        cut = cut.withColumn("_vectors", embed_sentences(parts))
        grouped = let(neighbour_cosine(F.col("_vectors")), lambda likeness: t.group_sentences(
            parts, lambda at: F.get(likeness, at), min_tokens, max_tokens, threshold))
    kept = [c for c in docs.columns if c != text_col]
    cut = cut.withColumn("_groups", grouped)
    spans = t.with_offsets(F.transform("_groups", lambda g: g["text"]))
    rows = F.zip_with(spans, F.col("_groups"), lambda span, group: struct_of(
        text=span["text"], start_index=span["start_index"], end_index=span["end_index"],
        token_count=group["token_count"], sentences=group["sentences"]))
    return cut.select(*kept, F.posexplode(rows).alias("chunk_index", "chunk")).select(
        *kept, "chunk_index", "chunk.*")


def with_chunk_id(chunks: DataFrame) -> DataFrame:
    """Adds ``id`` = source path, underscore, 0-based chunk index."""
    return chunks.withColumn("id", F.concat_ws("_", "source_path", "chunk_index"))


def _with_chunkless(counted: DataFrame, docs: DataFrame | None) -> DataFrame:
    """Adds a row with 0 chunks for each document that has none."""
    if docs is None:
        return counted
    names = docs.select("source_path").distinct().join(counted, "source_path", "left")
    return names.withColumn("n_chunks", F.coalesce("n_chunks", F.lit(0).cast("long")))


def chunk_counts(chunks: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """Chunks per document; given ``docs``, also of those without any."""
    counted = chunks.groupBy("source_path").agg(F.count("*").alias("n_chunks"))
    return _with_chunkless(counted, docs)


def corpus_totals(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: documents found and chunks made."""
    n_docs = docs.agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("m"))
    n_chunks = chunks.agg(F.lit(0).cast("long").alias("n"), F.count("*").alias("m"))
    return n_docs.unionByName(n_chunks).agg(
        F.sum("n").alias("n_documents"), F.sum("m").alias("n_chunks"))


def token_report(chunks: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """Chunk count and token minimum, mean and maximum per document; given ``docs``, also of those
    without chunks, with null tokens."""
    counted = chunks.withColumn("tokens", t.token_count(F.col("text")))
    report = counted.groupBy("source_path").agg(
        F.count("*").alias("n_chunks"),
        F.min("tokens").alias("min_tokens"),
        F.round(F.avg("tokens"), 6).alias("avg_tokens"),
        F.max("tokens").alias("max_tokens"),
    )
    return _with_chunkless(report, docs)
