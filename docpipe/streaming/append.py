"""The vector table fed from a stream of documents, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from docpipe.functions.text import DEFAULT_LIMIT
from docpipe.operators import embedding
from docpipe.plans import jobs
from docpipe.sources import vector_store


def index_stream(
    documents: DataFrame, path: str, limit: int = DEFAULT_LIMIT,
    backend: embedding.Backend | None = None,
) -> DataStreamWriter:
    """Writer that chunks, embeds and appends every micro-batch of ``documents(source_path, text)``.
    The caller sets the trigger and the checkpoint location and starts it. A batch repeated after a
    failure replaces the rows of its first try, as each batch is kept by its number."""
    def store(batch: DataFrame, batch_id: int) -> None:
        vector_store.append_batch(jobs.index_rows(batch, limit, backend), path, batch_id)

    return documents.writeStream.foreachBatch(store)
