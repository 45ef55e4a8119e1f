"""Training-order materialisation of token sequences.

Every document's ids, with an end id behind them, are cut into sequences of ``length`` ids (the last one is
filled up with end ids). A keyed Feistel network with cycle-walking permutes the places
``(document id - smallest id) * most windows + window``, so a sequence's place in training depends on the
key, its document and its window alone, never on files or tasks. Ranges of permuted places are written by
one task each, sorted, as shards of records of one fixed size. Permuted places that no sequence has are
left out: the global slot of a sequence is the number of sequences before it, known from the manifest's
counts. A reader finds the shard of any slot by arithmetic on the manifest and seeks to its byte.

A record is: document id (8 bytes), window (4), ids that count (4), then ``length`` ids of 2 bytes, all
little-endian. Shard files carry the name of their attempt and only the manifest's are read.

Defined results: null and empty texts have one sequence that holds the end id alone. Rows that repeat an id
have their sequences side by side. A null id comes after the largest one, and is read back as null. An empty
table writes no shard. Document ids must be integers whose range times the most windows is below 2^62.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docpipe.llm.bpe import Vocabulary
from docpipe.llm.tables import parts_for, stored, whole_text
from docpipe.llm.words import by_size, mix

LENGTH = 512
SHARD_BYTES = 16 << 20
PART_BYTES = 64 << 20
ROUNDS = 6
NO_ID = -(1 << 63)


def permuted(places: np.ndarray, domain: int, key: int) -> np.ndarray:
    """The keyed permutation of 0..domain-1 at ``places``: a balanced Feistel network over the next even
    number of bits, walked along its cycle until it is back inside the domain."""
    half = max(1, -(-max(domain - 1, 1).bit_length() // 2))
    low = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))
    out = places.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> shift, out[walking] & low
        for round_key in keys:
            left, right = right, left ^ (mix(right ^ round_key) & low)
        out[walking] = left << shift | right
        walking = walking[out[walking] >= np.uint64(domain)]
    return out.astype(np.int64)


def _record_type(length: int) -> np.dtype:
    return np.dtype([("doc", "<i8"), ("window", "<i4"), ("count", "<i4"), ("ids", "<u2", (length,))])


def _sequences(vocabulary, length: int, end: int, first_id: int, last_id: int, windows: int, key: int):
    domain = (last_id - first_id + 2) * windows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for whole in batches:
            for batch in by_size(whole, 1):
                ids, bounds = vocabulary.value.encode(batch.column(1).to_pylist())
                docs = batch.column(0)
                rank = np.where(docs.is_null().to_numpy(zero_copy_only=False), last_id - first_id + 1,
                                docs.fill_null(first_id).to_numpy(zero_copy_only=False) - first_id)
                sizes = np.diff(bounds) + 1
                counts = -(-sizes // length)
                owner = np.repeat(np.arange(len(sizes)), counts)
                window = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = bounds[:-1][owner] + window * length
                used = np.minimum(sizes[owner] - window * length, length)
                padded = np.append(ids, np.full(length, end)).astype("<u2")
                data = []
                for a, n, stop in zip(start.tolist(), used.tolist(), bounds[1:][owner].tolist(), strict=True):
                    own = padded[a:min(a + n, stop)]
                    data.append(squeeze(own.tobytes()))
                slots = permuted(rank[owner] * windows + window, domain, key)
                yield pa.RecordBatch.from_arrays(
                    [docs.take(pa.array(owner)), pa.array(window.astype(np.int32)), pa.array(used.astype(np.int32)),
                     pa.array(slots), pa.array(data, pa.binary())],
                    names=["doc", "window", "count", "place", "data"])

    return run


def _write(folder: str, length: int, end: int):
    record = _record_type(length)
    each = max(1, SHARD_BYTES // record.itemsize)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        expand = zstandard.ZstdDecompressor().decompress
        held, rows, nth, part = [], 0, 0, 0

        def save(records: np.ndarray) -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.seq"
            with files.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(records.tobytes())
            return pa.record_batch(
                [pa.array([part], pa.int32()), pa.array([nth], pa.int32()), [f"{folder}/{name}"], [len(records)]],
                names=["part", "nth", "shard", "records"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(0)[0].as_py()
            records = np.zeros(batch.num_rows, record)
            records["doc"] = batch.column(1).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            records["window"], records["count"] = (batch.column(i).to_numpy() for i in (2, 3))
            records["ids"] = end
            for i, data in enumerate(batch.column(4).to_pylist()):
                ids = np.frombuffer(expand(data), "<u2")
                records["ids"][i, :len(ids)] = ids
            held.append(records)
            rows += len(records)
            while rows >= each:
                flat = np.concatenate(held)
                yield save(flat[:each])
                held, rows, nth = [flat[each:]], rows - each, nth + 1
        if rows:
            yield save(np.concatenate(held))

    return run


def materialise(df: DataFrame, doc_id: str, text: str, path: str, folder: str, key: int = 1, end: int = 50256,
                length: int = LENGTH) -> DataFrame:
    """Writes the shards below ``folder`` (any place pyarrow can write to that all executors share).
    Returns the manifest: shard, records, first_slot."""
    vocabulary = Vocabulary.read(path)
    if max(vocabulary.size - 1, end) >= 1 << 16:
        raise ValueError("ids of two bytes are written; the vocabulary has larger ones")
    spark = df.sparkSession
    docs = df.select(F.col(doc_id).cast("long").alias("doc"), whole_text(df, text).alias("text"))
    # An id is at least a byte of text, so the bytes bound the windows.
    size = F.octet_length("text") + 1
    seen = docs.agg(F.min("doc"), F.max("doc"), F.max(F.ceil(size / length)), F.sum(size)).first()
    first_id, last_id, windows, total = seen[0] or 0, seen[1] or 0, seen[2] or 1, seen[3] or 0
    domain = (last_id - first_id + 2) * windows
    if domain >= 1 << 62:
        raise ValueError("the document ids are too far apart")
    shared = spark.sparkContext.broadcast(vocabulary)
    rows = docs.mapInArrow(_sequences(shared, length, end, first_id, last_id, windows, key),
                           "doc long, window int, count int, place long, data binary")
    parts = parts_for(spark, total, PART_BYTES)
    # Permuted places are even over their range, so equal ranges make equal parts.
    part = F.least(F.floor(F.col("place") / F.lit(domain / parts)), F.lit(parts - 1)).cast("int")
    dealt = rows.withColumn("part", part).repartitionById(parts, F.col("part"))
    ordered = dealt.sortWithinPartitions("place", "doc", "window", "data")
    manifest = stored(ordered.select("part", "doc", "window", "count", "data").mapInArrow(
        _write(folder.rstrip("/"), length, end), "part int, nth int, shard string, records long"), "shards")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part.
    starts = manifest.groupBy("part").agg(F.sum("records").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    return stored(manifest.join(starts, "part").select(
        "shard", "records", (F.col("part_start") + F.coalesce(F.sum("records").over(inside), F.lit(0))).alias("first_slot")),
        "shard-manifest")


def read(manifest: DataFrame, first: int = 0, length: int = LENGTH) -> DataFrame:
    """slot, doc, window, count, ids (bytes of 2-byte ids, the ``count`` first ones) from slot ``first`` on."""
    record = _record_type(length)
    each = max(1, (2 << 20) // record.itemsize)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, path = pyarrow.fs.FileSystem.from_uri(row["shard"])
                slot, stop = max(first, row["first_slot"]), row["first_slot"] + row["records"]
                with files.open_input_file(path) as source:
                    source.seek((slot - row["first_slot"]) * record.itemsize)
                    while slot < stop:
                        found = np.frombuffer(source.read(each * record.itemsize), record)
                        ids = [r[:n].tobytes() for r, n in zip(found["ids"], found["count"], strict=True)]
                        doc = pa.array(found["doc"].astype(np.int64), mask=found["doc"] == NO_ID)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.arange(slot, slot + len(found))), doc, pa.array(found["window"].astype(np.int32)),
                             pa.array(found["count"].astype(np.int32)), pa.array(ids, pa.binary())],
                            names=["slot", "doc", "window", "count", "ids"])
                        slot += len(found)

    asked = manifest.where(F.col("first_slot") + F.col("records") > first)
    count = asked.count()
    spark = manifest.sparkSession
    return asked.repartition(min(max(count, 1), parts_for(spark, count, 8))).mapInArrow(
        run, "slot long, doc long, window int, count int, ids binary")
