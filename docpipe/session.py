"""Session-level helpers: shipping this package to Python workers, spreading small inputs."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# A scan with fewer tasks than this many bytes each is worth spreading over idle cores.
SPREAD_BYTES = 256 << 10
# What a Python worker is handed at a time, and the rows that a Parquet scan holds at a time, unless the
# session says otherwise. By default Arrow buffers of long texts outgrow an executor's room beside the
# heap, and a scan makes arrays of many megabytes of texts or token lists, which the heap grows for.
LIMITS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.parquet.columnarReaderBatchSize": "512",
}

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Makes docpipe importable in Python workers, wherever the job was started from, and bounds the
    batches they are handed and those of Parquet scans."""
    context = spark.sparkContext
    for key, value in LIMITS.items():
        # None: left at its default. Asked for without this argument, a key gives its default's text.
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="docpipe-ship-")
    context.addPyFile(shutil.make_archive(f"{folder}/docpipe", "zip", root.parent, root.name))
    _shipped.add(context.applicationId)


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spreads a scan over the cores when its files give fewer tasks than the data is worth.

    A large table already comes in more tasks than there are cores and is returned as it is.
    ``keys`` must be close to unique, so that the hash gives even parts.
    """
    wanted = min(
        df.sparkSession.sparkContext.defaultParallelism, plan_bytes(df) // SPREAD_BYTES)
    if df._jdf.queryExecution().toRdd().getNumPartitions() >= wanted:
        return df
    return df.repartition(wanted, *keys)
