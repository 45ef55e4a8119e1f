import pyarrow as pa
import pytest

from docpipe.functions.outline import _outline_batches
from docpipe.operators import pages
from docpipe.schemas import PAGES

KEPT = "<p>kept</p>"


def _pages(spark, htmls, urls=None):
    urls = urls or [f"http://h.org/{i}" for i in range(len(htmls))]
    return spark.createDataFrame(
        [(i, u, h) for i, (u, h) in enumerate(zip(urls, htmls))], PAGES)


def _markdown(spark, html):
    rows = pages.extract_markdown(_pages(spark, [html])).collect()
    return rows[0]["markdown"] if rows else None


def _in_body(inner):
    return f"<html><head><title>t</title></head><body><p>outside</p>{inner}<p>after</p></body></html>"


@pytest.mark.parametrize("inner", [
    f"<article>no</article><main>{KEPT}</main>",            # main wins over an earlier article
    f"<div class='docs-content'>no</div><article>{KEPT}</article>",
    f"<div class='main-content'>no</div><div class='a docs-content b'>{KEPT}</div>",
    f"<div class='content-wrapper'>no</div><div class='main-content'>{KEPT}</div>",
    f"<div class='td-main'>no</div><div class='content-wrapper'>{KEPT}</div>",
    f"<div id='content'>no</div><div class='td-main'>{KEPT}</div>",
    f"<div role='main'>no</div><div id='content'>{KEPT}</div>",
    f"<section class='docs-content'>no</section><div role='main'>{KEPT}</div>",
    f"<article>{KEPT}</article><article>second</article>",  # first of its kind
    f"<div class='docs-content-wide'>no</div><div id=content>{KEPT}</div>",
])
def test_content_choice(spark, inner):
    assert _markdown(spark, _in_body(inner)) == "kept"


def test_falls_back_to_body(spark):
    assert _markdown(spark, _in_body("<p>x</p>")) == "outside\n\nx\n\nafter"


def test_pages_without_content_drop_out(spark):
    df = _pages(spark, ["<p>no body</p>", "", None, "<body>yes</body>"])
    assert [r["page_id"] for r in pages.extract_markdown(df).collect()] == [3]


@pytest.mark.parametrize("junk", [
    "<nav>n</nav>", "<aside>n</aside>", "<ul role='navigation'><li>n</ul>",
    "<div class='left-sidebar x'>n</div>", "<div id='mysidebar'>n</div>",
    "<div class='sidenav'>n</div>", "<div id='sidenav2'>n</div>", "<p class='nav-menu'>n</p>",
    "<p id='nav-menu-1'>n</p>", "<div class='table-of-contents'>n</div>", "<div id='page-toc'>n</div>",
    "<nav>n<nav>inner</nav></nav>", "<nav>n</nav><nav>n</nav>",
])
def test_pruning(spark, junk):
    html = _in_body(f"<main>a {junk} b</main>{junk}")
    assert _markdown(spark, html).replace("\n\n", " ") == "a b"
    row = pages.prune_stats(_pages(spark, [html])).first()
    per_copy = junk.count("<nav") or 1
    assert (row["n_pages"], row["n_removed"]) == (1, 2 * per_copy)


def test_ancestors_and_the_content_itself_stay(spark):
    html = _in_body("<aside class='sidebar'><div id='toc'><main class='sidebar'>a<nav>n</nav></main>"
                    "</div></aside><nav>gone</nav>")
    assert _markdown(spark, html) == "a"
    assert pages.prune_stats(_pages(spark, [html])).first()["n_removed"] == 2
    text = pages.pruned_text(_pages(spark, [html])).first()["page_text"]
    assert "gone" not in text and "outside" in text


def test_only_whole_class_names_and_substrings_as_stated(spark):
    # toc counts in ids only, and table-of-contents in classes only
    html = _in_body("<main><p class='toc'>a</p><p id='table-of-contents'>b</p></main>")
    assert _markdown(spark, html) == "a\n\nb"


@pytest.mark.parametrize("html, want", [
    ("<h1>A</h1><h3>B <b>c</b></h3>", "# A\n\n### B **c**"),
    ("<p>a\n  b</p><div>c</div><section>d</section>", "a b\n\nc\n\nd"),
    ("a<br>b<br/>c", "a  \nb  \nc"),
    ("<strong>a</strong> <em>b</em> <i>c</i> <code>d  e</code>", "**a** _b_ _c_ `d e`"),
    ("<a href='/x' title='T'>l</a> <a href='y'>m</a> <a name='z'>n</a>",
     '[l](/x "T") [m](y) n'),
    ("<img src='i.png' alt='pic'> <img src='j.png'>", "![pic](i.png) ![](j.png)"),
    ("<p>x</p><ul><li>a<li>b</ul>", "x\n\n  * a\n  * b"),
    ("<blockquote>quoted</blockquote><ol start='4'><li>four</li><li>five</li></ol>",
     "> quoted\n\n  4. four\n  5. five"),
    ("a<blockquote><p>one</p><p>two<br>three</p></blockquote><p>b</p>", "a\n\n> one\n> \n> two  \n> three\n\nb"),
    ("<del>old</del> <s>x</s> <kbd>Ctrl</kbd> <samp>out</samp> <tt>t</tt>", "~~old~~ ~~x~~ `Ctrl` `out` `t`"),
    ("<ol><li>a</li><li>b<ul><li>c</li></ul></li><li>d</li></ol>",
     "  1. a\n  2. b\n    * c\n  3. d"),
    ("<pre>if x:\n    y  z\n</pre>end", "    if x:\n        y  z\n\nend"),
    ("<table><tr><th>a</th><th>b</th></tr><tr><td>c</td><td>d</td></tr></table>",
     "a | b\n---|---\nc | d"),
    ("<style>s</style><script>var t='</p>';</script>x<!-- c -->y", "xy"),
    ("&lt;a&gt; &amp;amp; &copy; &#233; &nosuch;", "<a> &amp; © é &nosuch;"),
    ("<p>a<p>b", "a\n\nb"),
    ("<b>a<p>c</b>d</p>", "**a\n\nc\n\n**d"),
    ("a</p></div>b", "ab"),
])
def test_markdown_rules(spark, html, want):
    assert _markdown(spark, f"<body><main>{html}</main></body>") == want


def test_verbatim_break_keeps_its_place(spark):
    assert _markdown(spark, "<body><pre>a\nb</pre></body>") == "    a\n    b"


def test_control_characters_in_a_page_do_not_disturb_the_layout(spark):
    assert _markdown(spark, "<body>a\x01b\x03c</body>") == "abc"


def test_large_page_in_small_batches(spark, monkeypatch):
    html = _in_body("<main>" + "<p>word</p>" * 3000 + "</main>")
    df = _pages(spark, [html] * 50)
    rows = pages.extract_markdown(df).collect()
    assert len(rows) == 50 and {r["markdown"].count("word") for r in rows} == {3000}


def test_last_page_wins_its_path(spark):
    df = _pages(spark, ["<body>old</body>", "<body>new</body>", "<body>other host</body>", "nothing"],
                ["http://h.org/a?v=1", "http://h.org/a?v=2", "http://o.org/a", "http://h.org/a"])
    rows = pages.latest_per_path(pages.extract_markdown(df)).collect()
    assert sorted((r["host"], r["output_path"], r["markdown"]) for r in rows) == [
        ("h.org", "a.md", "new"), ("o.org", "a.md", "other host")]


def test_hot_path_folds_on_the_map_side(spark):
    from tests.conftest import plan_of

    df = spark.range(1000).selectExpr(
        "id AS page_id", "'http://h.org/a' AS url", "concat('h', id % 2) AS host",
        "concat('p', id % 2) AS output_path")
    latest = pages.latest_per_path(df)
    assert sorted(r["page_id"] for r in latest.collect()) == [998, 999]
    assert "Exchange hash" not in plan_of(latest)


def test_no_exchange_holds_markdown(spark):
    from tests.conftest import plan_of

    df = spark.range(100).selectExpr(
        "id AS page_id", "'http://h.org/a' AS url", "'h' AS host",
        "concat('p', id % 50) AS output_path", "'text' AS markdown")
    latest = pages.latest_per_path(df.unionByName(df))
    assert latest.count() == 50 and latest.columns == df.columns
    assert "Exchange hashpartitioning" not in plan_of(latest)


@pytest.mark.parametrize("filler", ["x" * 4_000, "<b>x</b>" * 500])
def test_tokens_of_a_batch_are_handed_on_in_bounded_parts(filler):
    # A worker holds the tokens of a part as Python objects, so a part is about 256 KB or 16,384 tokens.
    html = f"<main>{filler}</main>"
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(300)), "html": [html] * 300})
    parts = list(_outline_batches(iter([batch])))
    assert [i for part in parts for i in part.column("page_id").to_pylist()] == list(range(300))
    assert all(part.num_rows * len(html) < (1 << 18) + len(html) for part in parts)
    assert all(len(part.column("tokens").flatten()) < (1 << 14) + 2_000 for part in parts)
