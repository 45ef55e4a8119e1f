"""Vector expressions: the hashed bag-of-words embedding and distances, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docpipe.functions.columns import let, struct_of

DEFAULT_WIDTH = 64
WORD = r"[\p{L}\p{N}]+"


def word_buckets(text: Column, width: int = DEFAULT_WIDTH) -> Column:
    """Bucket number of every word: the CRC-32 of its UTF-8 bytes, modulo ``width``."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return F.transform(
        words, lambda word: (F.crc32(word.cast("binary")) % width).cast("int"))


def _bucket_counts(ordered: Column) -> Column:
    """(bucket, n) of a sorted bucket list, from the runs of equal buckets."""
    starts = F.filter(
        F.transform(ordered, lambda bucket, i: F.when(
            (i == 0) | (bucket != F.get(ordered, i - 1)), struct_of(bucket=bucket, at=i))),
        lambda run: run.isNotNull())
    return let(starts, lambda runs: F.transform(runs, lambda run, i: struct_of(
        bucket=run["bucket"],
        n=F.coalesce(F.get(runs, i + 1)["at"], F.size(ordered)) - run["at"])))


def hashed_vector(text: Column, width: int = DEFAULT_WIDTH) -> Column:
    """L2-normalised bucket counts as array<float>; null for text without words."""
    def counts(buckets: Column) -> Column:
        """Dense counts: with every bucket added once, the runs of the sorted list are the buckets."""
        every = F.sort_array(F.concat(buckets, F.sequence(F.lit(0), F.lit(width - 1))))
        return let(every, lambda ordered: let(
            F.filter(F.sequence(F.lit(0), F.size(ordered) - 1),
                     lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))),
            lambda starts: F.transform(starts, lambda at, k: (
                F.coalesce(F.get(starts, k + 1), F.size(ordered)) - at - 1).cast("double"))))

    def normalised(values: Column) -> Column:
        return let(norm(values), lambda n: F.transform(values, lambda v: (v / n).cast("float")))

    return let(word_buckets(text, width), lambda buckets: F.when(
        F.size(buckets) > 0, let(counts(buckets), normalised)))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(
        a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def neighbour_cosine(vectors: Column) -> Column:
    """Cosine of every vector with the one before it, null for the first or a missing vector."""
    def measured(items: Column) -> Column:
        return F.transform(items, lambda item, i: F.when(i > 0, let(
            F.get(items, i - 1),
            lambda before: dot(item["v"], before["v"])
            / F.nullif(item["n"] * before["n"], F.lit(0.0)),
        )))

    return let(F.transform(vectors, lambda v: struct_of(v=v, n=norm(v))), measured)


def neighbour_word_cosine(texts: Column, width: int = DEFAULT_WIDTH) -> Column:
    """``neighbour_cosine`` of the hashed vectors of an array of texts, from sparse bucket counts: the
    dot product is a sum over the buckets of one text that the other one has too. Short texts touch few
    buckets, so no dense vector is made."""
    def sparse(ordered: Column) -> Column:
        return let(_bucket_counts(ordered), lambda counts: struct_of(
            counts=counts, by_bucket=F.map_from_entries(counts),
            n=F.aggregate(counts, F.lit(0), lambda total, c: total + c["n"] * c["n"])))

    def shared(a: Column, b: Column) -> Column:
        return F.aggregate(a["counts"], F.lit(0), lambda total, c: (
            total + c["n"] * F.coalesce(b["by_bucket"][c["bucket"]], F.lit(0))))

    def measured(items: Column) -> Column:
        return F.transform(items, lambda item, i: F.when(i > 0, let(
            F.get(items, i - 1),
            lambda before: shared(item, before)
            / F.nullif(F.sqrt(item["n"]) * F.sqrt(before["n"]), F.lit(0.0)),
        )))

    # Each text's sorted buckets are bound once: ``sparse`` reads them at every word.
    return let(F.transform(texts, lambda t: let(F.sort_array(word_buckets(t, width)), sparse)), measured)


def squared_l2(a: Column, b: Column) -> Column:
    """Squared Euclidean distance in double, summed in order, so that equal vectors tie exactly."""
    squares = F.zip_with(
        a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))
    return F.aggregate(squares, F.lit(0.0), lambda total, s: total + s)


def finite(vector: Column) -> Column:
    """Whether every element is there and a finite number."""
    return ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
