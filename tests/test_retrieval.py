import numpy as np
import pytest
from pyspark.sql import functions as F

from docpipe.operators import retrieval
from tests.conftest import plan_of


def _squared(v, q):
    total = 0.0
    for a, b in zip(v, q, strict=True):
        total += (float(a) - float(b)) ** 2
    return total


def _brute(vectors, queries, k):
    hits = []
    for query_id, q in queries:
        if q is None:
            continue
        ranked = sorted(
            (_squared(v, q), name)
            for name, v in vectors if v is not None)
        hits += [(query_id, i + 1, name, d) for i, (d, name) in enumerate(ranked[:k])]
    return hits


def _frames(spark, vectors, queries):
    return (spark.createDataFrame(vectors, "id string, vector array<float>").repartition(5),
            spark.createDataFrame(queries, "query_id long, vector array<float>"))


def _rows(hits):
    return sorted((r["query_id"], r["rank"], r["id"], r["distance"]) for r in hits.collect())


def _data(n, n_queries, width=6, seed=0):
    """Random vectors, a third of them copies of one, with nulls and exact ties."""
    rng = np.random.default_rng(seed)
    base = np.round(rng.normal(size=(n, width)), 1).astype(np.float32)
    base[: n // 3] = base[0]
    vectors = [(f"v{i:05d}", None if i % 17 == 5 else row.tolist()) for i, row in enumerate(base)]
    queries = [(q, None if q == 1 else (
        base[0].tolist() if q == 0 else np.round(rng.normal(size=width), 1).astype(np.float32).tolist()))
        for q in range(n_queries)]
    return vectors, queries


@pytest.mark.parametrize("k", [1, 3, 40, 1000])
def test_matches_brute_force(spark, k):
    vectors, queries = _data(300, 7)
    got = _rows(retrieval.nearest(*_frames(spark, vectors, queries), k))
    want = sorted(_brute(vectors, queries, k))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=2e-9)


@pytest.mark.parametrize("max_block", [1, 4, 6])
def test_query_blocks_give_the_same(spark, max_block):
    """More queries than may be sent at once: they are taken in blocks."""
    vectors, queries = _data(200, 25, seed=3)
    v, q = _frames(spark, vectors, queries)
    assert _rows(retrieval.nearest(v, q, 4, max_block=max_block)) == _rows(retrieval.nearest(v, q, 4))


def test_partitioning_does_not_matter(spark):
    vectors, queries = _data(250, 5, seed=4)
    v, q = _frames(spark, vectors, queries)
    want = _rows(retrieval.nearest(v.coalesce(1), q, 5))
    assert _rows(retrieval.nearest(v.repartition(16), q.repartition(3), 5)) == want
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert _rows(retrieval.nearest(v, q, 5)) == want
        assert _rows(retrieval.nearest(v, q, 5, max_block=2)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_small_tiles_and_batches(spark, monkeypatch):
    """Candidates found over many tiles equal those of one."""
    vectors, queries = _data(400, 6, seed=5)
    clean = [(n, v) for n, v in vectors if v is not None]
    ids = [q for q, v in queries if v is not None]
    matrix = np.array([v for _, v in queries if v is not None], dtype=np.float64)
    import pyarrow as pa

    def run(tile):
        monkeypatch.setattr(retrieval, "TILE", tile)
        block = retrieval._Block(ids, matrix, 5, ["id"])
        names = pa.record_batch({"id": [n for n, _ in clean]})
        block.add(np.array([v for _, v in clean], dtype=np.float64), names)
        schema = pa.schema([("query_id", pa.int64()), ("id", pa.string()), ("distance", pa.float64())])
        return pa.Table.from_batches(list(block.result(schema)), schema).to_pylist()

    assert run(1) == run(37) == run(1 << 20)


def test_large_offsets_do_not_lose_neighbours(spark):
    """Where the matrix product cancels badly, the exact sum decides."""
    vectors = [(f"v{i}", [1e6 + i * 1e-2, -1e6, 3.0]) for i in range(50)]
    v = spark.createDataFrame(vectors, "id string, vector array<double>")
    q = spark.createDataFrame([(0, [1e6 + 0.2, -1e6, 3.0])], "query_id long, vector array<double>")
    assert [r["id"] for r in retrieval.nearest(v, q, 3).orderBy("rank").collect()] == ["v20", "v19", "v21"]


def test_one_vector_form_agrees(spark):
    vectors, queries = _data(300, 3, seed=6)
    v, q = _frames(spark, vectors, queries)
    one = retrieval.nearest_to(v, queries[2][1], 9)
    assert "TakeOrderedAndProject" in plan_of(one)
    many = retrieval.nearest(v, q.filter("query_id = 2"), 9).orderBy("rank")
    assert [(r["id"], r["distance"]) for r in one.collect()] == [
        (r["id"], r["distance"]) for r in many.collect()]


def test_unequal_widths_are_rejected(spark):
    v, q = _frames(spark, [("a", [1.0, 2.0]), ("b", [1.0, 2.0, 3.0])], [(0, [1.0, 2.0])])
    with pytest.raises(Exception, match="all vectors must have 2 values"):
        retrieval.nearest(v, q, 2).collect()


def test_empty_sides(spark):
    v, q = _frames(spark, [("a", [1.0])], [(0, [1.0])])
    assert retrieval.nearest(v, q.filter("query_id > 0"), 2).count() == 0
    assert retrieval.nearest(v.filter("id > 'a'"), q, 2).count() == 0
    assert retrieval.nearest(v, q.withColumn("vector", F.lit(None).cast("array<float>")), 2).count() == 0


def test_no_pair_of_query_and_vector_becomes_a_row(spark):
    vectors, queries = _data(100, 8, seed=8)
    v, q = _frames(spark, vectors, queries)
    for hits in (retrieval.nearest(v, q, 3), retrieval.nearest(v, q, 3, max_block=2)):
        plan = plan_of(hits)
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert "WindowGroupLimit" in plan


def test_report(spark):
    hits = spark.createDataFrame(
        [(0, 1, "a", "s", "x" * 200, 0.5)],
        "query_id long, rank int, id string, source_path string, text string, distance double")
    assert len(retrieval.hit_report(hits, 150).first()["text"]) == 150
    assert len(retrieval.hit_report(hits).first()["text"]) == 200


def test_small_scale_keeps_its_order(spark):
    vectors = [("a", [9e-6]), ("b", [1e-6]), ("c", [5e-6])]
    v, q = _frames(spark, vectors, [(0, [0.0])])
    assert [r[2] for r in _rows(retrieval.nearest(v, q, 2))] == ["b", "c"]
    assert [r["id"] for r in retrieval.nearest_to(v, [0.0], 2).collect()] == ["b", "c"]


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), None])
def test_a_vector_that_is_not_finite_is_named(spark, bad):
    vectors = [(f"v{i}", [float(i), 1.0]) for i in range(50)] + [("odd", [bad, 1.0])]
    v, q = _frames(spark, vectors, [(0, [0.0, 0.0])])
    with pytest.raises(Exception, match="not a finite vector: odd"):
        retrieval.nearest(v, q, 3).collect()
    with pytest.raises(Exception, match="not a finite vector: odd"):
        retrieval.nearest_to(v, [0.0, 0.0], 3).collect()
    with pytest.raises(Exception, match="not a finite vector"):
        retrieval.nearest(*_frames(spark, [("v", [1.0, 1.0])], [(0, [bad, 1.0])]), 3).collect()


def test_a_model_sees_each_query_once(spark, tmp_path):
    def load():
        class Seen:
            def encode(self, texts):
                with open(f"{tmp_path}/seen", "a") as out:
                    out.writelines(f"{t}\n" for t in texts)
                return [[float(len(t))] for t in texts]
        return Seen()

    from docpipe.operators import embedding
    asked = spark.createDataFrame([(i, "x" * i) for i in range(20)], "query_id long, query_text string")
    queries = embedding.embed(asked, "query_text", embedding.model(load)).select("query_id", "vector")
    v, _ = _frames(spark, [("a", [3.0]), ("b", [9.0])], [])
    assert retrieval.nearest(v, queries, 1, max_block=3).count() == 20
    assert len((tmp_path / "seen").read_text().splitlines()) == 20
