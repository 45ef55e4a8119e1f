import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd
import pyarrow as pa

from docpipe.llm import divergence
from docpipe.llm.oracle import ORACLE

ROWS = [
    (1, "The cat sat. THE CAT!", "en", "a"),
    (2, "the dog ran, the cat sat", "en", "a"),
    (3, "Dog dog dog: cat", "en", "b"),
    (4, None, "en", "b"),
    (5, "éclair Éclair éclair the", "en", None),
    (6, "the the the", "en", "c"),
    (7, "", None, "a"),
    (8, "x1y2 z__w", None, None),
    (9, "einmal nur", "de", "a"),
    (10, "the cat dog", "en", "b"),
]


def _oracle(rows):
    docs = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"])
    con = duckdb.connect()
    con.register("documents", docs)
    return con.sql(ORACLE["op13_source_divergence"]).df()


def _sorted(df):
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return df[cols].astype(str).sort_values(cols).reset_index(drop=True)


def test_equals_dense_sql_with_nulls_ties_and_clashing_columns(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    df = df.selectExpr("*", "'x' AS term", "'y' AS part", "0 AS rank").repartition(3)
    got = divergence.audit(df).toPandas()
    want = _oracle(ROWS)
    assert len(want) > 0
    pd.testing.assert_frame_equal(_sorted(got), _sorted(want))
    # A language whose terms are all rare gives no term rows and a single source gives no pair rows.
    assert got[got.lang == "de"].empty
    # Ranks are unique per group and part.
    assert not got.duplicated(["lang", "source", "part", "rank"]).any()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.audit(df).count() == 0


def test_long_text_and_many_repeats(spark):
    rows = [(i, ("alpha beta " * 20000) if i == 0 else "alpha gamma beta", "en", f"s{i % 3}") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    pd.testing.assert_frame_equal(_sorted(divergence.audit(df).toPandas()), _sorted(_oracle(rows)))


LARGE = """
import pyarrow as pa
from docpipe.llm import divergence

texts = [" ".join(f"w{chr(97 + (i + j) % 26)}{chr(97 + j % 7)}" for j in range(1_000)) for i in range(1_000)]
batch = pa.RecordBatch.from_pydict({"lang": ["en", None] * 500, "source": ["a"] * 1_000, "text": texts})
"""


def test_a_large_batch_gives_one_row_per_group_and_term():
    scope = {}
    exec(LARGE, scope)
    want_n, want_docs = Counter(), Counter()
    for i, text in enumerate(scope["texts"]):
        words = text.split()
        want_n.update(("" if i % 2 else "en", w) for w in words)
        want_docs.update(("" if i % 2 else "en", w) for w in set(words))
    rows = [r for part in divergence._partial_counts(iter([scope["batch"]])) for r in part.to_pylist()]
    counts = [r for r in rows if r["term"] is not None]
    assert {(r["lang"], r["term"]): r["n"] for r in counts} == dict(want_n)
    assert {(r["lang"], r["term"]): r["n_docs"] for r in counts} == dict(want_docs)
    assert len(counts) == len(want_n)
    assert sorted(r["lang"] for r in rows if r["term"] is None) == ["", "en"]


def test_terms_of_a_large_batch_are_listed_in_slices():
    # 4 MB of texts in one batch, a million terms, never all of them in memory at once.
    run = LARGE + """
before = pa.total_allocated_bytes()
rows = sum(part.num_rows for part in divergence._partial_counts(iter([batch])))
print(pa.default_memory_pool().max_memory() - before)
"""
    peak = int(subprocess.run([sys.executable, "-c", run], capture_output=True, check=True, text=True,
                              cwd=Path(__file__).parents[2]).stdout)
    assert peak < 32 << 20


def test_sums_and_shares_past_a_long(spark):
    top = 10 ** 18
    rows = spark.createDataFrame([(1, v) for v in [top] * 30 + [-2 * top, -1, 0]] + [(2, -1)], "k int, value long")
    sums = dict(rows.groupBy("k").agg(divergence._exact_sum("value")).collect())
    assert {k: int(v) for k, v in sums.items()} == {1: 28 * top - 1, 2: -1}
    cases = [(0, 1, 0), (9, 100, 7), (8_999_999_999, 9 * 10 ** 9, 5), (10 ** 12, 3 * 10 ** 12, 10)]
    got = spark.createDataFrame(cases, "n long, total long, v long").select(
        "n", divergence._p("n", "total", "v").alias("p"))
    assert {r["n"]: r["p"] for r in got.collect()} == {
        n: 1 + 10 ** 9 * (n + 1) // (total + v) for n, total, v in cases}
