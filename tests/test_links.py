from docpipe.operators import links
from docpipe.schemas import PAGES

SITE = {
    "http://h.org/docs/": "<a href='a'>a</a><a href='b#x'>b</a><a href='#top'>t</a>"
                          "<a href='http://o.org/docs/z'>z</a><nav><a href='hidden'>h</a></nav>",
    "http://h.org/docs/a": "<a href='../docs/'>home</a><a href='a'>self</a><a href='c'>c</a>"
                           "<a href='c'>again</a>",
    "http://h.org/docs/b": "<a href='/blog/1'>out of scope</a><a href='c?v=1'>c1</a>",
    "http://h.org/docs/c": "<a href='missing'>m</a>",
    "http://h.org/docs/c?v=1": "",
    "http://h.org/docs/hidden": "<a href='deep'>d</a>",
}


def _site(spark):
    return spark.createDataFrame(
        [(i, u, f"<body>{h}</body>") for i, (u, h) in enumerate(SITE.items())], PAGES)


def _resolved(spark, prune_first=True):
    return links.resolve_links(links.extract_links(_site(spark), prune_first))


def test_links_come_from_the_pruned_page(spark):
    assert not [r for r in _resolved(spark).collect() if r["href"] == "hidden"]
    assert [r["target"] for r in _resolved(spark, False).collect() if r["href"] == "hidden"] == [
        "http://h.org/docs/hidden"]


def test_fragments_are_skipped_or_cut(spark):
    rows = _resolved(spark).collect()
    assert all("#" not in r["target"] for r in rows)
    assert not [r for r in rows if r["href"] == "#top"]


def test_scope_and_visited(spark):
    scoped = links.in_scope(_resolved(spark), "http://h.org/docs/", "/docs/")
    assert {r["target"] for r in scoped.collect()} == {
        "http://h.org/docs/", "http://h.org/docs/a", "http://h.org/docs/b", "http://h.org/docs/c",
        "http://h.org/docs/c?v=1", "http://h.org/docs/missing", "http://h.org/docs/deep"}
    seen = spark.createDataFrame([("http://h.org/docs/a",), ("http://h.org/docs/a",)], "url string")
    rest = [r["url"] for r in links.unvisited(scoped, seen).collect()]
    assert len(rest) == len(set(rest)) == 6 and "http://h.org/docs/a" not in rest


def test_scope_compares_the_host_as_written(spark):
    df = spark.createDataFrame(
        [("http://h.org:80/docs/",), ("https://h.org/docs/",), ("http://x.org/h.org/docs/",)],
        "target string")
    kept = links.in_scope(df, "http://h.org", "/docs/").collect()
    assert [r["target"] for r in kept] == ["https://h.org/docs/"]


def test_dangling(spark):
    rows = {r["url"]: r["n_links"] for r in links.dangling(_resolved(spark), _site(spark)).collect()}
    assert rows == {"http://o.org/docs/z": 1, "http://h.org/blog/1": 1, "http://h.org/docs/missing": 1,
                    "http://h.org/docs/deep": 1}


def _crawl(spark, edges, seed, path_filter="", **kwargs):
    seeds = spark.createDataFrame([(seed,)], "url string")
    return {r["url"]: r["depth"] for r in links.crawl(edges, seeds, path_filter, **kwargs).collect()}


def test_crawl_is_breadth_first_and_scoped(spark):
    reached = _crawl(spark, _resolved(spark), "http://h.org/docs/", "/docs/")
    base = "http://h.org/docs/"
    assert reached == {base: 0, base + "a": 1, base + "b": 1, base + "c": 2, base + "c?v=1": 2,
                       base + "missing": 3}


def test_seed_is_not_scope_checked(spark):
    edges = spark.createDataFrame(
        [("http://h.org/", "http://h.org/docs/a"), ("http://h.org/", "http://h.org/x")],
        "url string, target string")
    assert _crawl(spark, edges, "http://h.org/", "/docs/") == {
        "http://h.org/": 0, "http://h.org/docs/a": 1}


def test_crawl_agrees_with_plain_search_on_a_long_and_tangled_graph(spark):
    """Deeper than the number of levels kept apart, with one page that everything links to."""
    import random

    rng = random.Random(5)
    n = 60
    url = "http://h.org/{}".format
    pairs = {(i, i + 1) for i in range(24)} | {(i, 0) for i in range(n)}
    pairs |= {(i, rng.randrange(i + 1)) for i in range(n)} | {(rng.randrange(25), i) for i in range(40, n)}
    edges = spark.createDataFrame([(url(a), url(b)) for a, b in pairs], "url string, target string")
    depth, level = {0: 0}, [0]
    while level:
        level = sorted({b for a, b in pairs if a in level} - set(depth))
        depth.update(dict.fromkeys(level, max(depth.values()) + 1))
    assert _crawl(spark, edges, url(0)) == {url(i): d for i, d in depth.items()}
    shallow = _crawl(spark, edges, url(0), max_depth=2)
    assert shallow == {url(i): d for i, d in depth.items() if d <= 2}


def test_crawl_leaves_the_session_as_it_was(spark):
    edges = spark.createDataFrame([("http://h/a", "http://h/b")], "url string, target string")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    _crawl(spark, edges, "http://h/a")
    assert spark.conf.get("spark.sql.adaptive.enabled") == before


def test_own_fragment_does_not_hide_a_page(spark):
    edges = spark.createDataFrame(
        [("http://h/a", "http://h/b"), ("http://h/b#top", "http://h/c")], "url string, target string")
    assert _crawl(spark, edges, "http://h/a#x") == {"http://h/a": 0, "http://h/b": 1, "http://h/c": 2}


def test_large_frontiers_are_joined(spark, monkeypatch):
    monkeypatch.setattr(links, "SENT_URLS", 0)
    edges = spark.createDataFrame(
        [(f"http://h/{i}", f"http://h/{j}") for i in range(20) for j in (2 * i + 1, 2 * i + 2)],
        "url string, target string")
    assert len(_crawl(spark, edges, "http://h/0")) == 41


def test_a_failed_page_answers_no_link(spark):
    found = spark.createDataFrame([("http://h/a",), ("http://h/b",), ("http://h/b",), ("http://h/c",)], "target string")
    stored = spark.createDataFrame([(1, "http://h/a#top", "<p>x"), (2, "http://h/b", None), (3, "http://h/c", "")], PAGES)
    assert sorted(tuple(r) for r in links.dangling(found, stored).collect()) == [("http://h/b", 2), ("http://h/c", 1)]
