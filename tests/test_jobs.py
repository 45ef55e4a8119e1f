import pytest

from docpipe.operators import embedding
from docpipe.plans import jobs
from docpipe.schemas import PAGES
from docpipe.sources import vector_store
from docpipe.sources.corpus import read_markdown

CORPUS = {
    "alpha/README.md": "# Alpha\nAlpha finds anomalies in time series.\n",
    "alpha/INSTALL.md": "# Install Alpha\nRun the installer, then run the tests.\n",
    "beta/README.md": "# Beta\nBeta draws bar charts and line graphs of large data.\n",
    "beta/live/README.md": "# Live board\nA dashboard that updates in real time.\n",
}


@pytest.fixture
def corpus(spark, tmp_path):
    for name, text in CORPUS.items():
        (tmp_path / "docs" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "docs" / name).write_text(text)
    return read_markdown(spark, str(tmp_path / "docs"))


def test_index_and_ask(spark, corpus, tmp_path):
    path = str(tmp_path / "index")
    n = jobs.build_index(corpus, path, limit=60)
    assert jobs.build_index(corpus, path, limit=60) == n == vector_store.count_rows(spark, path)
    hits = jobs.ask(spark, path, ["run the installer then run the tests", "dashboard that updates in real time"], k=2)
    rows = sorted(hits.collect(), key=lambda r: (r["query_id"], r["rank"]))
    assert [(r["query_id"], r["rank"]) for r in rows] == [(0, 1), (0, 2), (1, 1), (1, 2)]
    assert rows[0]["source_path"].endswith("alpha/INSTALL.md")
    assert rows[2]["source_path"].endswith("beta/live/README.md")
    stored = {r["id"]: r["text"] for r in vector_store.open_table(spark, path).collect()}
    assert all(stored[r["id"]] == r["text"] for r in rows)


def test_same_document_stored_twice_is_found_twice(spark, corpus, tmp_path):
    path = str(tmp_path / "index")
    rows = jobs.index_rows(corpus)
    vector_store.append_rows(rows, path)
    vector_store.append_rows(rows, path)
    hits = jobs.ask(spark, path, ["how do I install alpha"], k=2).collect()
    assert len(hits) == 2 and len({r["id"] for r in hits}) == 1
    assert sorted(r["rank"] for r in hits) == [1, 2]


def test_hit_texts_come_from_the_files_that_hold_them(spark, corpus, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    vector_store.append_rows(jobs.index_rows(corpus).repartition(4, "id"), path)
    want = sorted(map(tuple, jobs.ask(spark, path, ["bar charts"], k=3).collect()))
    monkeypatch.setattr(jobs, "FEW_FILES", 0)       # hits spread over many files
    monkeypatch.setattr(jobs, "FEW_HITS", 0)        # too many hits to broadcast
    assert sorted(map(tuple, jobs.ask(spark, path, ["bar charts"], k=3).collect())) == want


def test_nothing_to_find(spark, corpus, tmp_path):
    path = str(tmp_path / "index")
    assert jobs.ask(spark, path, ["anything"]).count() == 0          # no table
    jobs.build_index(corpus, path)
    assert jobs.ask(spark, path, ["..."]).count() == 0               # no vector for the query
    none = embedding.unavailable()
    assert jobs.ask(spark, path, ["alpha"], backend=none).count() == 0
    assert jobs.build_index(corpus, path, backend=none) == 0


def test_search_reads_two_columns(spark, corpus, tmp_path):
    from docpipe.operators import retrieval
    from tests.conftest import plan_of

    path = str(tmp_path / "index")
    jobs.build_index(corpus, path)
    stored = vector_store.open_table(spark, path)
    queries = embedding.embed(
        spark.createDataFrame([(0, "alpha")], "query_id long, query_text string"), "query_text")
    plan = plan_of(retrieval.nearest(stored, queries, 2))
    assert "ReadSchema: struct<id:string,vector:array<float>>" in plan
    assert "PushedFilters: [IsNotNull(vector)]" in plan


SITE = {
    "http://h.org/docs/": "<main><h1>Home</h1><a href='a'>a</a></main><nav><a href='n'>n</a></nav>",
    "http://h.org/docs/a": "<main><p>Page <b>a</b></p><a href='/blog/x'>x</a></main>",
    "http://h.org/docs/n": "<main>only from navigation</main>",
    "http://h.org/blog/x": "<main>elsewhere</main>",
}


def test_site_to_answers(spark, tmp_path):
    """All three jobs in a row."""
    stored = spark.createDataFrame(
        [(i, u, f"<body>{h}</body>") for i, (u, h) in enumerate(SITE.items())], PAGES)
    everything = jobs.site_to_markdown(stored)
    assert everything.count() == 4
    crawled = jobs.site_to_markdown(stored, "http://h.org/docs/", "/docs/")
    assert {r["output_path"]: r["markdown"] for r in crawled.collect()} == {
        "docs.md": "# Home\n\n[a](a)", "docs/a.md": "Page **a**\n\n[x](/blog/x)"}
    path = str(tmp_path / "index")
    assert jobs.build_index(jobs.markdown_documents(crawled), path) == 2
    best = jobs.ask(spark, path, ["home"], k=1).first()
    assert (best["id"], best["source_path"]) == ("h.org/docs.md_0", "h.org/docs.md")


def test_stored_fragment_does_not_cut_the_site(spark, tmp_path):
    rows = [(1, "http://h.org/a", "<body><a href='b'>b</a></body>"),
            (2, "http://h.org/b#top", "<body>old<a href='gone'>g</a></body>"),
            (3, "http://h.org/b#end", "<body>new<a href='c'>c</a></body>"),
            (4, "http://h.org/c", "<body>end</body>"), (5, "http://h.org/gone", "<body>x</body>")]
    stored = spark.createDataFrame(rows, PAGES)
    found = jobs.store_site(stored, str(tmp_path / "md"), "http://h.org/a#x")
    assert sorted((r["page_id"], r["url"]) for r in found.collect()) == [
        (1, "http://h.org/a"), (3, "http://h.org/b"), (4, "http://h.org/c")]


def test_site_to_answers_in_one_job(spark, tmp_path):
    stored = spark.createDataFrame(
        [(i, f"http://h.org/{i}", f"<body><p>topic{i} words</p><a href='{i + 1}'>n</a></body>") for i in range(5)], PAGES)
    report = jobs.index_site(stored, str(tmp_path / "md"), str(tmp_path / "index"), "http://h.org/0")
    assert {(r["n_stored"], r["n_dropped"]) for r in report.collect()} == {(1, 0)}
    assert jobs.ask(spark, str(tmp_path / "index"), ["topic3 words"], k=1).first()["source_path"] == "h.org/3.md"


def test_index_report_names_dropped_chunks(spark, tmp_path):
    docs = spark.createDataFrame([("a.md", "fine text"), ("b.md", "!!")], "source_path string, text string")
    report = jobs.rebuild(docs, str(tmp_path / "i"), chunker="tokens")
    assert {r["source_path"]: (r["n_stored"], r["n_dropped"]) for r in report.collect()} == {
        "a.md": (1, 0), "b.md": (0, 1)}
