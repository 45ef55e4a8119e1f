"""Text -> vector column: the hashed default, or a user's model behind Arrow batches."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.functions.columns import with_once
from docpipe.functions.vectors import DEFAULT_WIDTH, hashed_vector

VECTOR = T.ArrayType(T.FloatType())
BATCH_TEXTS = 256


class Model(Protocol):
    def encode(self, texts: list[str]) -> Sequence[Sequence[float] | None]: ...


Backend = Callable[[DataFrame, str, str], DataFrame]


def hashed(width: int = DEFAULT_WIDTH) -> Backend:
    """Bag of words hashed to ``width`` buckets, native columns only."""
    def embed(df: DataFrame, text_col: str, out: str) -> DataFrame:
        return with_once(df, out, hashed_vector(F.col(text_col), width))

    return embed


def model(load: Callable[[], Model], batch_size: int = BATCH_TEXTS) -> Backend:
    """A user's model. ``load`` runs once per Python worker and task; only the text column crosses
    to Python. A batch whose encoding fails gives nulls, and the job goes on; a task logs how many
    failed and why the first one did."""
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load()
        failed, first = 0, None
        for texts in batches:
            vectors: list = []
            for start in range(0, len(texts), batch_size):
                part = texts.iloc[start:start + batch_size].tolist()
                try:
                    encoded = encoder.encode(part)
                    if len(encoded) != len(part):
                        raise ValueError("the model must return one vector per text")
                    vectors.extend(
                        None if v is None else [float(x) for x in v] for v in encoded)
                except Exception as error:
                    failed, first = failed + 1, first or error
                    vectors.extend([None] * len(part))
            yield pd.Series(vectors, dtype=object)
        if failed:
            logging.getLogger("docpipe").warning("%d batches were not embedded; the first: %r", failed, first)

    # Spark reads the batch form from the annotations, which are strings in this module.
    encode.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}

    def embed(df: DataFrame, text_col: str, out: str) -> DataFrame:
        # Marked so that a filter on the vectors is not moved before the model, which would make
        # the model run twice, and over other batches the second time.
        encoded = F.pandas_udf(encode, VECTOR).asNondeterministic()
        return df.withColumn(out, encoded(F.col(text_col)))

    return embed


def unavailable() -> Backend:
    """No backend: every vector is null."""
    return lambda df, text_col, out: df.withColumn(out, F.lit(None).cast(VECTOR))


def first_available(*loaders: Callable[[], Model]) -> Backend:
    """The first model that loads, tried in order on the driver; all nulls when none does."""
    for load in loaders:
        try:
            load()
        except Exception:
            continue
        return model(load)
    return unavailable()


def embed(
    df: DataFrame, text_col: str = "text", backend: Backend | None = None, out: str = "vector"
) -> DataFrame:
    """Adds a nullable array<float> column; rows keep their place and number."""
    return (backend or hashed())(df, text_col, out)


def valid_only(df: DataFrame, vector_col: str = "vector") -> DataFrame:
    return df.filter(F.col(vector_col).isNotNull())


def failure_report(df: DataFrame, vector_col: str = "vector") -> DataFrame:
    """Stored and dropped rows per source."""
    missing = F.col(vector_col).isNull()
    return df.groupBy("source_path").agg(
        F.count_if(~missing).alias("n_stored"), F.count_if(missing).alias("n_dropped"))


def vector_rows(chunks: DataFrame) -> DataFrame:
    """The four columns of the stored table, in order."""
    return chunks.select("id", "text", "source_path", "vector")
