"""The vector table: a Parquet folder that is created, appended to, opened, counted and reset."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.functions.vectors import finite
from docpipe.schemas import VECTORS
from docpipe.sources.corpus import any_path


def has_table(spark: SparkSession, path: str) -> bool:
    folder = path.rstrip("/")
    return any_path(spark, f"{folder}/*.parquet") or any_path(spark, f"{folder}/batch=*/*.parquet")


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; an empty table of the same schema when nothing was stored yet."""
    if not has_table(spark, path):
        return spark.createDataFrame([], VECTORS)
    return spark.read.schema(VECTORS).option("recursiveFileLookup", "true").parquet(path)


def _width(df: DataFrame) -> int | None:
    """Width of the first vector there is."""
    row = df.filter(F.col("vector").isNotNull()).select(F.size("vector").alias("n")).limit(1).collect()
    return row[0]["n"] if row else None


def _checked(df: DataFrame, width: int | None) -> DataFrame:
    """Rows as they are stored; a null id, a null vector, a missing or non-finite element or another
    width fails the write. The check rides along in the projection, so the data is computed once."""
    good = F.col("id").isNotNull() & F.col("vector").isNotNull() & finite(F.col("vector"))
    if width is not None:
        good = good & (F.size("vector") == width)
    message = F.concat(F.lit("not a storable row: "), F.coalesce("id", F.lit("null id")))
    return df.select(
        F.when(F.coalesce(good, F.lit(False)), F.col("id")).otherwise(F.raise_error(message))
        .cast("string").alias("id"),
        *[F.col(f.name).cast(f.dataType) for f in VECTORS.fields[1:]],
    )


def append_rows(df: DataFrame, path: str, width: int | None = None) -> None:
    """Create or append. An empty input changes nothing; errors are raised to the caller."""
    spark = df.sparkSession
    width = _width(open_table(spark, path)) or width or _width(df)
    if width is not None or not df.isEmpty():
        _checked(df, width).write.mode("append").parquet(path)


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """``append_rows`` for a numbered batch: writing a number again replaces its rows."""
    spark = df.sparkSession
    rows = df if "batch_id" not in df.columns else df.drop("batch_id")
    width = _width(open_table(spark, path)) or _width(rows)
    if width is not None or not rows.isEmpty():
        _checked(rows, width).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")


def replace_rows(df: DataFrame, path: str, width: int | None = None) -> None:
    """Reset and store: the table holds exactly these rows afterwards. All must have one width, the
    given one or that of the first row; finding it out computes the head of ``df`` once more.

    The rows are written to a folder of their own beside the table first; only a complete write takes
    the table's place (two renames), so a failed or bad build leaves the old table whole, and ``df``
    may read the table it replaces."""
    spark = df.sparkSession
    folder = path.rstrip("/")
    build = f"{folder}.build-{uuid.uuid4().hex}"
    try:
        _checked(df, width or _width(df)).write.mode("overwrite").parquet(build)
    except Exception:
        _delete(spark, build)
        raise
    _swap(spark, build, folder)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _delete(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    if fs.exists(where):
        fs.delete(where, True)


def _swap(spark: SparkSession, build: str, folder: str) -> None:
    """Puts the finished ``build`` in ``folder``'s place. The old table is moved aside, not deleted,
    until the build is in place; if that rename fails, it is moved back."""
    fs, target = _file_system(spark, folder)
    _, built = _file_system(spark, build)
    aside = None
    if fs.exists(target):
        _, aside = _file_system(spark, f"{folder}.old-{uuid.uuid4().hex}")
        if not fs.rename(target, aside):
            _delete(spark, build)
            raise OSError(f"could not move {folder} aside; it is unchanged")
    if not fs.rename(built, target):
        if aside is not None:
            fs.rename(aside, target)
        _delete(spark, build)
        raise OSError(f"could not put the new rows in {folder}; the old table is back")
    if aside is not None:
        fs.delete(aside, True)


def reset(spark: SparkSession, path: str) -> None:
    """Empties the table; a missing one is fine."""
    if has_table(spark, path):
        spark.createDataFrame([], VECTORS).write.mode("overwrite").parquet(path)


def count_rows(spark: SparkSession, path: str) -> int:
    """Stored rows; 0 without a table. Read from the Parquet footers alone."""
    return open_table(spark, path).count()
