"""Explicit schemas of the tables the jobs read and write."""

from pyspark.sql import types as T

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

MARKDOWN = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("host", T.StringType()),
    T.StructField("output_path", T.StringType()),
    T.StructField("markdown", T.StringType()),
])

DOCUMENTS = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("source_path", T.StringType()),
])

VECTORS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("source_path", T.StringType()),
    T.StructField("vector", T.ArrayType(T.FloatType())),
])

HITS = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("id", T.StringType()),
    T.StructField("source_path", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("distance", T.DoubleType()),
])
