"""Stored pages in, Markdown table out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.schemas import MARKDOWN, PAGES


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).parquet(path)


def write_markdown(documents: DataFrame, path: str) -> None:
    """One row per host and output path. Rows stay in their task, sorted by host, so that a reader of
    one host skips most row groups; nothing is shuffled and no host has a folder of its own."""
    rows = documents.select(*[
        F.col(f.name).cast(f.dataType) for f in MARKDOWN.fields])
    rows.sortWithinPartitions("host", "output_path").write.mode("overwrite").parquet(path)


def read_markdown_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MARKDOWN).parquet(path)
