"""Exact deduplication by two passes over Bloom filters.

Pass 1 sets, per segment of the hash space, the bits hit by at least two rows. Pass 2 tests every row
against these bits: a row whose bits are not all set has no equal and passes straight through; the
others (all true repeats and about one unique row in 200) are grouped by their full SHA-256. Texts
never move in ``mark``; ``keep_one`` moves only those of possibly repeated rows.

The filter takes 16 bits a row up to ``filter_bytes``. Past that many rows it only grows less
selective: more (thin) rows are grouped, up to all of them; the result stays the same.

Defined results: a null text counts as empty. Of equal texts the largest id stays; a null id is smaller
than any other. Rows that repeat both id and text are one document listed several times: one row stays.
An empty table gives an empty result. Other columns are untouched, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpipe.llm.tables import fresh, stored, whole_text

SEGMENT_BITS = 1 << 20
BITS_PER_ROW = 16
PROBES = 3
FILTER_BYTES = 64 << 20
FLUSH_ROWS = 1 << 20


def _segment(key: Column, segments: int) -> Column:
    return F.pmod(F.shiftrightunsigned(key, 40), F.lit(segments)).cast("int")


def _probe(key: Column, i: int) -> Column:
    """The i-th bit position of a row inside its segment."""
    first, step = key.bitwiseAND(0xFFFFF), F.shiftrightunsigned(key, 20).bitwiseAND(0xFFFFF)
    return (first + step.bitwiseOR(1) * i).bitwiseAND(SEGMENT_BITS - 1).cast("int")


def _probes(keys: np.ndarray, probes: int) -> np.ndarray:
    first, step = keys & 0xFFFFF, ((keys >> 20) & 0xFFFFF) | 1
    return np.stack([(first + step * i) & (SEGMENT_BITS - 1) for i in range(probes)])


def _task_bits(segments: int, probes: int):
    """Per task: the bits its rows set, and those of keys it saw twice."""

    def flush(keys: np.ndarray) -> pa.RecordBatch:
        distinct, seen = np.unique(keys, return_counts=True)
        segment = ((distinct.view(np.uint64) >> np.uint64(40)) % np.uint64(segments)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        distinct, seen, segment = distinct[order], seen[order], segment[order]
        cuts = np.flatnonzero(np.diff(segment, prepend=-1)) if len(segment) else []
        names, once, twice = [], [], []
        for start, stop in zip(cuts, [*cuts[1:], len(segment)], strict=True):
            bits = _probes(distinct[start:stop], probes).astype(np.uint32)
            names.append(int(segment[start]))
            again = np.unique(bits[:, seen[start:stop] > 1])
            values, hits = np.unique(bits, return_counts=True)
            once.append(values.tobytes())
            twice.append(np.union1d(again, values[hits > 1]).astype(np.uint32).tobytes())
        return pa.record_batch(
            [pa.array(names, pa.int32()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())],
            names=["segment", "once", "twice"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            rows += batch.num_rows
            if rows >= FLUSH_ROWS:
                yield flush(np.concatenate(held))
                held, rows = [], 0
        if rows:
            yield flush(np.concatenate(held))

    return run


def _merge_bits(pieces: pd.DataFrame) -> pd.DataFrame:
    """The bits of one segment that are set twice, over all tasks. At most a few MB of positions."""
    hits = np.zeros(SEGMENT_BITS, np.uint8)
    for once, twice in zip(pieces["once"], pieces["twice"], strict=True):
        at = np.frombuffer(once, np.uint32)
        hits[at] = np.minimum(hits[at] + 1, 2)
        hits[np.frombuffer(twice, np.uint32)] = 2
    words = np.packbits(hits == 2, bitorder="little").view(np.int64)
    return pd.DataFrame({"segment": [pieces["segment"].iloc[0]], "words": [words]})


def repeated_bits(keys: DataFrame, rows: int, filter_bytes: int = FILTER_BYTES,
                  probes: int = PROBES) -> tuple[DataFrame, int]:
    """Pass 1 over a one-column table of about ``rows`` 64-bit keys: (segment, words of the bits that are
    set twice), and the number of segments."""
    segments = max(1, min(math.ceil(rows * BITS_PER_ROW / SEGMENT_BITS),
                          filter_bytes * 8 // SEGMENT_BITS))
    pieces = keys.mapInArrow(_task_bits(segments, probes), "segment int, once binary, twice binary")
    merged = pieces.groupBy("segment").applyInPandas(_merge_bits, "segment int, words array<bigint>")
    return stored(merged, "bloom"), segments


def with_repeat_flag(df: DataFrame, key: str, bits: tuple[DataFrame, int], flag: str,
                     probes: int = PROBES) -> DataFrame:
    """Pass 2: ``df`` with whether another row may have the same key. Narrow: the bits are broadcast, at
    most ``filter_bytes`` of them by the number of segments chosen in pass 1."""
    seg, of_seg, words, _ = fresh(df, "segment", "segment_of", "words", flag)
    known = bits[0].toDF(of_seg, words)
    rows = df.withColumn(seg, _segment(F.col(key), bits[1]))
    rows = rows.join(F.broadcast(known), F.col(seg) == F.col(of_seg), "left")
    hit = F.lit(True)
    for i in range(probes):
        at = _probe(F.col(key), i)
        hit = hit & (F.getbit(F.get(F.col(words), F.shiftright(at, 6)), at.bitwiseAND(63)) == 1)
    return rows.withColumn(flag, F.coalesce(hit, F.lit(False))).drop(seg, of_seg, words)


def filter_rows(df: DataFrame, key: str, bits: tuple[DataFrame, int], probes: int = PROBES) -> DataFrame:
    """The rows of ``df`` whose key another row may have."""
    flag, = fresh(df, "possibly_repeated")
    return with_repeat_flag(df, key, bits, flag, probes).where(F.col(flag)).drop(flag)


def _flagged(df: DataFrame, text: str, filter_bytes: int) -> tuple[DataFrame, str, str]:
    """``df`` with the hash of its text and whether another row may have the same one."""
    sha, maybe, key = fresh(df, "text_sha256", "possibly_repeated", "key64")
    hashed = df.withColumn(sha, F.sha2(whole_text(df, text), 256))
    hashed = hashed.withColumn(key, F.xxhash64(sha))
    bits = repeated_bits(hashed.select(key), df.count(), filter_bytes)
    return with_repeat_flag(hashed, key, bits, maybe).drop(key), sha, maybe


def _groups(candidates: DataFrame) -> DataFrame:
    """(text_sha256, keep_id, group_size) of possibly repeated rows; folded on the map side."""
    return stored(candidates.groupBy("text_sha256").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "repeated")


def mark(df: DataFrame, id_col: str, text: str, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per row of ``df``: id_col, keep_id, group_size, kept, text_sha256."""
    flagged, sha, maybe = _flagged(df.select(id_col, text), text, filter_bytes)
    thin = flagged.select(F.col(id_col).alias("id"), F.col(sha).alias("text_sha256"),
                          F.col(maybe).alias("maybe"))
    alone = thin.where(~F.col("maybe")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    candidates = thin.where("maybe").drop("maybe")
    groups = _groups(candidates)
    # Equal rows travel as one with their number, so the single one to keep needs no window.
    listed = candidates.groupBy("text_sha256", "id").agg(F.count(F.lit(1)).alias("times"))
    decided = listed.join(groups, "text_sha256").select(
        "*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("nth"))
    decided = decided.select(
        "id", "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256")
    return alone.unionByName(decided).withColumnRenamed("id", id_col)


def keep_one(df: DataFrame, id_col: str, text: str, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    flagged, sha, maybe = _flagged(df, text, filter_bytes)
    alone = flagged.where(~F.col(maybe)).select(*[flagged[c] for c in df.columns])
    candidates = flagged.where(F.col(maybe))
    groups = _groups(candidates.select(F.col(sha).alias("text_sha256"), F.col(id_col).alias("id")))
    its, keep, size = fresh(flagged, "group_sha256", "keep_id", "group_size")
    groups = groups.toDF(its, keep, size)
    # The id is part of the key, so a large group of copies is dealt over all parts.
    winners = candidates.join(
        groups, (F.col(sha) == F.col(its)) & F.col(id_col).eqNullSafe(F.col(keep)))
    winners = winners.dropDuplicates([sha]).select(*[winners[c] for c in df.columns])
    return alone.unionByName(winners)
