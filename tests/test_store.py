import pytest

from docpipe import scratch
from docpipe.operators import pages
from docpipe.schemas import MARKDOWN, VECTORS
from docpipe.sources import page_store, vector_store


def _rows(spark, n, width=2, start=0):
    return spark.createDataFrame(
        [(f"d_{i}", "t", "d", [float(i)] * width) for i in range(start, start + n)], VECTORS)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "vectors")


def test_create_append_open_count(spark, path):
    assert vector_store.count_rows(spark, path) == 0
    assert vector_store.open_table(spark, path).schema == VECTORS
    vector_store.append_rows(_rows(spark, 3), path)
    vector_store.append_rows(_rows(spark, 3), path)      # the same ids again: both copies stay
    assert vector_store.count_rows(spark, path) == 6
    assert vector_store.open_table(spark, path).schema == VECTORS
    row = vector_store.open_table(spark, path).filter("id = 'd_2'").first()
    assert row["vector"] == [2.0, 2.0]


def test_empty_input_changes_nothing(spark, path):
    vector_store.append_rows(_rows(spark, 0), path)
    assert not vector_store.has_table(spark, path)
    vector_store.append_rows(_rows(spark, 1), path)
    vector_store.append_rows(_rows(spark, 0), path)
    assert vector_store.count_rows(spark, path) == 1


def test_reset_and_replace(spark, path):
    vector_store.reset(spark, path)                      # nothing there yet
    vector_store.append_rows(_rows(spark, 4), path)
    vector_store.reset(spark, path)
    assert vector_store.count_rows(spark, path) == 0
    vector_store.append_rows(_rows(spark, 2, width=5), path)   # a new width after a reset
    vector_store.replace_rows(_rows(spark, 3), path)
    vector_store.replace_rows(_rows(spark, 3), path)
    assert vector_store.count_rows(spark, path) == 3


def test_a_failed_replace_keeps_the_old_table(spark, path):
    vector_store.replace_rows(_rows(spark, 3), path)
    bad = _rows(spark, 4).unionByName(spark.createDataFrame([("x", "t", "d", [1.0])], VECTORS))
    with pytest.raises(Exception, match="not a storable row"):
        vector_store.replace_rows(bad, path)
    assert vector_store.count_rows(spark, path) == 3
    assert sorted(r.id for r in vector_store.open_table(spark, path).collect()) == ["d_0", "d_1", "d_2"]
    # No build of the failed write is left beside the table.
    import glob
    assert [p for p in glob.glob(path.rstrip("/") + ".*")] == []


def test_replace_may_read_the_table_it_replaces(spark, path):
    vector_store.replace_rows(_rows(spark, 5), path)
    vector_store.replace_rows(vector_store.open_table(spark, path).filter("id <> 'd_1'"), path)
    assert sorted(r.id for r in vector_store.open_table(spark, path).collect()) == ["d_0", "d_2", "d_3", "d_4"]


@pytest.mark.parametrize("bad", [
    (None, "t", "d", [1.0, 2.0]), ("x", "t", "d", None), ("x", "t", "d", [1.0]),
])
def test_bad_rows_fail_the_write(spark, path, bad):
    vector_store.append_rows(_rows(spark, 2), path)
    with pytest.raises(Exception, match="not a storable row"):
        vector_store.append_rows(spark.createDataFrame([bad], VECTORS), path)
    assert vector_store.count_rows(spark, path) == 2


def test_markdown_table(spark, tmp_path):
    rows = [(i, f"http://h{i % 3}.org/{i}", f"00{i % 3}", f"{i}.md", "x") for i in range(30)]
    rows.append((40, "u", "", "e.md", None))
    df = spark.createDataFrame(rows, MARKDOWN)
    where = str(tmp_path / "markdown")
    page_store.write_markdown(pages.latest_per_path(df), where)
    stored = page_store.read_markdown_table(spark, where)
    assert sorted(tuple(r) for r in stored.collect()) == sorted(rows)
    page_store.write_markdown(df.limit(0), where)
    assert page_store.read_markdown_table(spark, where).count() == 0


@pytest.mark.parametrize("write", [vector_store.append_rows, vector_store.replace_rows])
@pytest.mark.parametrize("vectors", [[None, [1.0], [2.0]], [[1.0], [1.0, 2.0]], [[float("nan")], [1.0]],
                                     [[1.0], [float("inf")]], [None]])
def test_a_bad_vector_fails_the_write(spark, tmp_path, write, vectors):
    rows = [(f"v{i}", "t", "s", v) for i, v in enumerate(vectors)]
    with pytest.raises(Exception, match="not a storable row: v"):
        write(spark.createDataFrame(rows, VECTORS).coalesce(1), str(tmp_path / "t"))


def test_numbered_batches_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", "t", "s", [1.0])], VECTORS)
    for batch in (0, 1, 1):
        vector_store.append_batch(rows, path, batch)
    vector_store.append_rows(rows, path)
    assert vector_store.count_rows(spark, path) == 3
    vector_store.replace_rows(rows, path)
    assert vector_store.count_rows(spark, path) == 1


def test_scratch_is_shared_or_local_and_cleared(spark, tmp_path, monkeypatch):
    path = scratch.scratch_table(spark, "x")
    spark.range(3).write.parquet(path)
    assert scratch.clear(spark) > 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)

    class Cluster:
        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_dir(Cluster)
