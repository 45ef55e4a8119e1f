import math
import re
import zlib

from pyspark.sql import functions as F

from docpipe.operators import embedding
from docpipe.plans import jobs

TEXTS = ["Cats and cats", "über ÜBER 12", "...", "", "a " * 500, None]


def _df(spark, texts):
    return spark.createDataFrame(
        [(str(i), "s", t) for i, t in enumerate(texts)], "id string, source_path string, text string")


def _vectors(df):
    return {r["id"]: r["vector"] for r in df.collect()}


def test_hashed_vectors_by_hand(spark):
    got = _vectors(embedding.embed(_df(spark, TEXTS), backend=embedding.hashed(16)))
    for i, text in enumerate(TEXTS):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        if not words:
            assert got[str(i)] is None
            continue
        counts = [0] * 16
        for word in words:
            counts[zlib.crc32(word.encode()) % 16] += 1
        norm = math.sqrt(sum(c * c for c in counts))
        assert all(abs(a - c / norm) < 1e-6 for a, c in zip(got[str(i)], counts))


def test_repeated_ids_stay_separate_rows(spark):
    df = _df(spark, ["one", "two"]).withColumn("id", F.lit("same"))
    rows = embedding.embed(df).collect()
    assert len(rows) == 2 and rows[0]["vector"] != rows[1]["vector"]


class Lengths:
    def encode(self, texts):
        if "boom" in texts:
            raise RuntimeError("bad batch")
        return [[float(len(t))] for t in texts]


class Unloadable:
    def __init__(self):
        raise OSError("no weights here")


def test_model_keeps_order_and_fails_by_batch(spark):
    texts = ["a", "bb", "boom", "dddd", "eeeee"]
    df = _df(spark, texts).coalesce(1)
    got = _vectors(embedding.embed(df, backend=embedding.model(Lengths, batch_size=2)))
    assert got == {"0": [1.0], "1": [2.0], "2": None, "3": None, "4": [5.0]}
    kept = embedding.valid_only(embedding.embed(df, backend=embedding.model(Lengths, batch_size=2)))
    assert sorted(r["id"] for r in kept.collect()) == ["0", "1", "4"]


def test_wrong_number_of_vectors_is_a_failed_batch(spark):
    class Short:
        def encode(self, texts):
            return [[1.0]]

    assert set(_vectors(embedding.embed(
        _df(spark, ["a", "b"]).coalesce(1), backend=embedding.model(Short))).values()) == {None}


def test_backend_choice(spark):
    df = _df(spark, ["abc"])
    second = embedding.first_available(Unloadable, Lengths)
    assert _vectors(embedding.embed(df, backend=second)) == {"0": [3.0]}
    none = embedding.first_available(Unloadable)
    assert _vectors(embedding.embed(df, backend=none)) == {"0": None}


def test_failure_report(spark):
    df = embedding.embed(_df(spark, ["a", "...", "b"]))
    assert embedding.failure_report(df).first().asDict() == {
        "source_path": "s", "n_stored": 2, "n_dropped": 1}


def test_index_rows_shuffle_nothing_and_embed_once(spark):
    from tests.conftest import plan_of

    docs = _df(spark, ["# a\n\nb"]).select("source_path", "text")
    rows = jobs.index_rows(docs)
    plan = plan_of(rows)
    assert "Exchange" not in plan and plan.count("crc32") == 1
    assert rows.columns == ["id", "text", "source_path", "vector"]


def test_only_the_text_crosses_to_python(spark):
    from tests.conftest import plan_of

    df = embedding.embed(_df(spark, ["a"]), backend=embedding.model(Lengths))
    assert re.search(r"ArrowEvalPython \[encode\(text#\d+\)", plan_of(df))


