"""Exact k-nearest search of a vector table, for one vector or a table of queries.

No pair of (query, vector) ever becomes a row. Tasks read Arrow batches of vectors, compare each
batch with a bounded block of queries in one matrix product and keep the k best per query, so a task emits
at most k rows per query and the shuffle carries only those.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.functions.vectors import finite, squared_l2
from docpipe.scratch import scratch_table

# Queries sent to every task at a time: this many at most, and this many bytes of what a task holds
# for them, which is a vector and twice k kept rows each. A larger query table is taken in blocks.
SENT_ROWS = 16384
SENT_BYTES = 64 << 20
KEPT_ROW_BYTES = 128
# Distances held at once in a task.
TILE = 1 << 20


def nearest_to(
    vectors: DataFrame, query: Sequence[float], k: int = 3, keep: Sequence[str] = ("id",),
    vector_col: str = "vector",
) -> DataFrame:
    """The k rows nearest to one vector, ties by the first kept column. Native columns: every task
    keeps its own k (TakeOrderedAndProject). A vector with a missing or non-finite element is an
    error that names its row."""
    if not np.isfinite(np.asarray(query, dtype=np.float64)).all():
        raise ValueError("the query vector must be finite")
    target = F.array(*[F.lit(float(x)) for x in query])
    vector = F.col(vector_col)
    measured = F.when(finite(vector), squared_l2(vector, target)).otherwise(F.raise_error(
        F.concat(F.lit("not a finite vector: "), F.coalesce(F.col(keep[0]).cast("string"), F.lit("null")))))
    measured = vectors.filter(vector.isNotNull()).select(*keep, measured.alias("distance"))
    return measured.orderBy("distance", keep[0]).limit(k)


class _Block:
    """k best rows per query of one query block, over any number of vector batches."""

    def __init__(self, ids: Sequence, matrix: np.ndarray, k: int, names: Sequence[str]):
        self.ids, self.matrix, self.k, self.names = ids, matrix, k, list(names)
        self.squares = np.einsum("ij,ij->i", matrix, matrix)
        self.bound = np.full(len(ids), np.inf)
        self.best: pa.Table | None = None
        self.pending: list[pa.Table] = []

    def add(self, vectors: np.ndarray, kept: pa.RecordBatch) -> None:
        step = max(1, TILE // max(1, len(self.ids)))
        for start in range(0, len(vectors), step):
            self._tile(vectors[start:start + step], kept.slice(start, step))

    def _tile(self, vectors: np.ndarray, kept: pa.RecordBatch) -> None:
        squares = np.einsum("ij,ij->i", vectors, vectors)
        rough = squares[:, None] + self.squares[None, :] - 2.0 * (vectors @ self.matrix.T)
        # The matrix product rounds differently from the exact sum below, so candidates are taken
        # with a margin wider than that error, which grows with the data's own scale.
        scale = squares.max(initial=0.0) + self.squares.max(initial=0.0)
        margin = 1e-15 * (vectors.shape[1] + 8) * scale
        bound = self.bound
        if np.isinf(bound).any() and len(vectors) >= self.k:
            bound = np.minimum(bound, np.partition(rough, self.k - 1, axis=0)[self.k - 1])
        rows, queries = np.nonzero(rough <= bound[None, :] + margin)
        if not len(rows):
            return
        # Summed in the order of the elements, as the native expression does.
        exact = np.zeros(len(rows))
        for i in range(vectors.shape[1]):
            gap = vectors[rows, i] - self.matrix[queries, i]
            exact += gap * gap
        found = pa.Table.from_batches([kept]).take(pa.array(rows))
        found = found.append_column("_query", pa.array(queries.astype(np.int32)))
        found = found.append_column("distance", pa.array(exact))
        self.pending.append(found)
        # Merging sorts everything kept so far, so it waits for as many candidates again - but not
        # before every query has a bound to sift candidates with.
        waiting = sum(map(len, self.pending))
        if waiting >= self.k * len(self.ids) or np.isinf(self.bound).any():
            self._merge()

    def _merge(self) -> None:
        kept = [] if self.best is None else [self.best]
        found = pa.concat_tables([*kept, *self.pending])
        self.pending = []
        found = found.sort_by([
            ("_query", "ascending"), ("distance", "ascending"), (self.names[0], "ascending")])
        query = found.column("_query").to_numpy()
        place = np.arange(len(query)) - np.searchsorted(query, query)
        self.best = found.filter(pa.array(place < self.k)).combine_chunks()
        last = np.flatnonzero(place == self.k - 1)
        self.bound[query[last]] = found.column("distance").to_numpy()[last]

    def result(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if self.pending:
            self._merge()
        if self.best is None:
            return
        query_ids = pa.array(self.ids, schema.field("query_id").type).take(
            self.best.column("_query").combine_chunks())
        columns = [query_ids, *[self.best.column(n) for n in [*self.names, "distance"]]]
        yield from pa.Table.from_arrays(
            columns, names=["query_id", *self.names, "distance"]).cast(schema).to_batches()


def _matrix(column: pa.Array, width: int | None = None, ids: pa.Array | None = None) -> np.ndarray:
    """list<float> column -> float64 matrix; vectors of another width, and elements that are missing
    or not finite, are errors."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    width = width or (len(values) // len(column) if len(column) else 0)
    if np.any(column.value_lengths().to_numpy(zero_copy_only=False) != width):
        raise ValueError(f"all vectors must have {width} values")
    matrix = values.reshape(len(column), width).astype(np.float64)
    bad = np.flatnonzero(~np.isfinite(matrix).all(axis=1))
    if len(bad):
        raise ValueError(f"not a finite vector: {ids[int(bad[0])].as_py() if ids is not None else 'a query'}")
    return matrix


def _hit_schema(vectors: DataFrame, queries: DataFrame, keep: Sequence[str]) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        *[T.StructField(name, vectors.schema[name].dataType) for name in keep],
        T.StructField("distance", T.DoubleType()),
    ])


def _against_all(vectors: DataFrame, block: pa.Table, k: int, keep: Sequence[str], schema) -> DataFrame:
    """Every vector task gets the whole (bounded) query block."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    ids = block.column("query_id").to_pylist()
    shared = vectors.sparkSession.sparkContext.broadcast(
        _matrix(block.column("vector").combine_chunks(), ids=block.column("query_id")))
    names = list(keep)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Block(ids, shared.value, k, names)
        for batch in batches:
            if batch.num_rows:
                matrix = _matrix(batch.column("vector"), shared.value.shape[1], batch.column(names[0]))
                best.add(matrix, batch.select(names))
        yield from best.result(arrow)

    return vectors.select(*keep, "vector").mapInArrow(scan, schema)


def _in_blocks(
    vectors: DataFrame, queries: DataFrame, n_blocks: int, k: int, keep: Sequence[str], schema
) -> DataFrame:
    """Query table too large to send at once: block after block is held against all vectors, each in
    one scan without a shuffle, and its k rows per query and task are written."""
    spark = vectors.sparkSession
    block = F.pmod(F.xxhash64("query_id"), F.lit(n_blocks))
    found = scratch_table(spark, "nearest")
    for i in range(n_blocks):
        own = queries.filter(block == i).toArrow()
        if own.num_rows:
            _against_all(vectors, own, k, keep, schema).write.mode("append").parquet(found)
    return spark.read.schema(schema).parquet(found)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 3, keep: Sequence[str] = ("id",),
    max_block: int | None = None,
) -> DataFrame:
    """The k nearest rows of ``vectors(keep..., vector)`` for each row of ``queries(query_id,
    vector)``: query_id, rank from 1, kept columns, squared L2 ``distance``.

    Exact; equal distances rank by the first kept column. Null vectors, on either side, take no
    part; one with a missing or non-finite element is an error. The queries are written once, so
    that a model that makes them sees each of them once. ``max_block`` overrides the block size.
    """
    vectors = vectors.filter(F.col("vector").isNotNull())
    schema = _hit_schema(vectors, queries, keep)
    path = scratch_table(vectors.sparkSession, "queries")
    asked = queries.select("query_id", "vector").filter(F.col("vector").isNotNull())
    asked.write.parquet(path)
    queries = vectors.sparkSession.read.schema(asked.schema).parquet(path)
    head = queries.select(F.size("vector").alias("width")).limit(1).collect()
    if not head:
        partial = vectors.sparkSession.createDataFrame([], schema)
    else:
        held = 8 * max(1, head[0]["width"]) + 2 * k * KEPT_ROW_BYTES
        size = max_block or max(1, min(SENT_ROWS, SENT_BYTES // held))
        count = queries.count()
        if count <= size:
            partial = _against_all(vectors, queries.toArrow(), k, keep, schema)
        else:
            partial = _in_blocks(vectors, queries, -(-count // size), k, keep, schema)
    order = Window.partitionBy("query_id").orderBy("distance", keep[0])
    return (
        partial.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", *keep, "distance")
    )


def hit_report(hits: DataFrame, chars: int | None = None) -> DataFrame:
    """rank, id, source and text of every hit; ``chars`` shortens the shown text only."""
    text = F.col("text") if chars is None else F.substring("text", 1, chars)
    return hits.select("query_id", "rank", "id", "source_path", text.alias("text"))
