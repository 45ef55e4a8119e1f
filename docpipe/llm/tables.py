"""Helpers shared by the operators: given tables, intermediate tables, number of parts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.scratch import scratch_table

ROW_GROUP_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared scratch folder and reads it back: evaluated once, lineage cut,
    and safe when executors are lost."""
    spark = df.sparkSession
    path = scratch_table(spark, name)
    # Writers hold a row group in the heap; these tables are read once or twice, whole.
    df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Removes ``stored`` tables that nothing reads any more, and the shuffles they were made by: Spark does
    that only when the driver collects its garbage."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            where = path(folder)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    if tables:
        tables[0].sparkSession.sparkContext._jvm.System.gc()


def parts_for(spark: SparkSession, size: int, each: int) -> int:
    """Shuffle parts for ``size`` units at ``each`` units a part; never fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / each))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with those of ``df`` (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def whole_text(df: DataFrame, text: str):
    """The text column with null as empty."""
    return F.coalesce(df[text], F.lit(""))
