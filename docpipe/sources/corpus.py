"""Markdown files of a directory tree as rows."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def any_path(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob pattern matches; asks the file system it belongs to, not the driver's
    disk."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(pattern)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    return found is not None and len(found) > 0


def _hidden_or_empty(spark: SparkSession, directory: str) -> tuple[list[str], list[str]]:
    """``.md`` files that Spark's own listing leaves out: names that start with ``_``, files without a
    byte. Folders whose names start with ``.`` or ``_`` stay out, as they do there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = hadoop.Path(directory)
    files = root.getFileSystem(conf)
    hidden, empty, folders = [], [], [root]
    while folders:
        for found in files.listStatus(folders.pop()):
            name = found.getPath().getName()
            if found.isDirectory():
                if name[0] not in "._":
                    folders.append(found.getPath())
            elif name.endswith(".md") and name[0] != ".":
                if found.getLen() == 0:
                    empty.append(found.getPath().toString())
                elif name[0] == "_":
                    hidden.append(found.getPath().toString())
    return hidden, empty


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            content = None
            try:
                files, place = pyarrow.fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))
                with files.open_input_stream(place, compression=None) as source:
                    content = source.read()
            except OSError as error:
                logging.getLogger("docpipe").warning("%s cannot be read: %s", path, error)
            yield pa.record_batch([[path], pa.array([content], pa.binary())], names=["path", "content"])


def scan_markdown(spark: SparkSession, directory: str) -> DataFrame:
    """(text, source_path, read) per ``.md`` file at any depth, also those named ``_...`` and empty
    ones. A file that is not UTF-8 has a null text and ``read`` false, so has one of these others that
    cannot be opened; a damaged file among the rest is left out. Line ends become \\n. A missing
    directory gives no rows."""
    schema = "path string, content binary"
    if not any_path(spark, directory):
        files = spark.createDataFrame([], schema)
    else:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.md")
            .option("recursiveFileLookup", "true")
            .option("ignoreCorruptFiles", "true")
            .load(directory).select("path", "content")
        )
        hidden, empty = _hidden_or_empty(spark, directory)
        if empty:
            files = files.unionByName(spark.createDataFrame([(p, b"") for p in empty], schema))
        if hidden:
            names = spark.createDataFrame([(p,) for p in hidden], "path string")
            files = files.unionByName(names.mapInArrow(_contents, schema))
    text = F.col("content").cast("string")
    text = F.when(F.is_valid_utf8(text), F.regexp_replace(text, r"\r\n?", "\n"))
    return files.select(
        text.alias("text"), F.regexp_replace("path", r"^file:/*", "/").alias("source_path"),
    ).withColumn("read", F.col("text").isNotNull())


def read_markdown(spark: SparkSession, directory: str) -> DataFrame:
    """(text, source_path) of the files of ``scan_markdown`` that could be read."""
    return scan_markdown(spark, directory).where("read").drop("read")
