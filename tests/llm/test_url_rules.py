import itertools
import random

from pyspark.sql import functions as F

from docpipe.llm import url_rules
from docpipe.llm.queries import LISTED
from tests.conftest import plan_of

PAGES = "page_id long, url string, html string, host string, tokens string, verdict string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, None, "h", "t", "v") for r in rows], PAGES).repartition(3)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:end], rest[end:]
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def listed(host, path):
    fit = [r for r in LISTED if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name), default=None)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, page_id string")


def judged(spark, rows, marks, **limits):
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return url_rules.judge(pages(spark, rows), "page_id", "url", labels(spark, marks), "doc_id", bad, LISTED, **limits)


URLS = ["http://a.example.org/en/1", "https://Example.ORG/es/x?y#z", "http://shop.com/de/", "http://x.com/fr/1?utm_source=a",
        "http://com/fr", "http://org", "http://org/", "http://notorg/", "ftp://h.net/x//y?a=1&b=2&a=3#f", "no scheme", "", None,
        "://", "http://?q", "http://ÄÖ.org/É", "x://y://z.org/en/", "http://u:p@h.org:80/", "http://a.org\n/b", "http://" + "l" * 100_000]


def test_listed_rules(spark):
    rows = list(enumerate(URLS)) + [(None, "http://q.org/")]
    got = {r["page_id"]: r for r in judged(spark, rows, []).collect()}
    for i, url in rows:
        host, path = split(url)
        rule = listed(host, path)
        assert (got[i]["host"], got[i]["path"]) == (host, path), url
        assert got[i]["rule"] == (rule.name if rule else None)
        assert got[i]["verdict"] == (rule.verdict if rule else "allow")


def tokens(url):
    host, path = split(url)
    parts = host.split(".")
    out = {"h:" + ".".join(parts[i:]) for i in range(len(parts))}
    import re
    out |= {"p:" + re.sub("[0-9]+", "0", s) for s in path.split("/") if s}
    query = url.split("?", 1)[1].split("#")[0] if "?" in url else ""
    out |= {"q:" + s.split("=", 1)[0] for s in query.split("&") if s}
    return frozenset(out | {"s:" + url.split("://")[0].lower()})


def test_mined_rules_against_plain_python(spark):
    rng = random.Random(7)
    rows, marks = [], []
    for i in range(400):
        host = rng.choice(["bad.net", "good.net", "www.good.net"])
        url = f"http://{host}/{rng.choice(['buy', 'read'])}/{i}" + rng.choice(["", "?ref=1", "?q=2"])
        bad = ("bad" in host and "buy" in url) or ("ref" in url and rng.random() < 0.7)
        rows.append((i, url))
        if i % 4:
            marks.append((i, 0 if bad else 1, 0, "p"))
    limits = {"min_support": 0.02, "min_confidence": 0.6}
    label = {m[0]: m[1] == 0 for m in marks}
    sets = [(tokens(u), label[i]) for i, u in rows if i in label]
    least = max(0.02 * len(sets), url_rules.MIN_ROWS)
    rules = []
    every = sorted(set().union(*(s for s, _ in sets)))
    for size in range(1, 5):
        for combo in itertools.combinations(every, size):
            has = [b for s, b in sets if s.issuperset(combo)]
            if sum(has) >= least and sum(has) >= 0.6 * len(has):
                rules.append(frozenset(combo))
    assert rules
    got = {r["page_id"]: r["verdict"] for r in judged(spark, rows, marks, **limits).collect()}
    assert got == {i: "block" if any(r <= tokens(u) for r in rules) else "allow" for i, u in rows}
    assert "block" in got.values() and "allow" in got.values()


def test_labels_repeat_or_are_null(spark):
    rows = [(1, "http://a.net/"), (1, "http://a.net/"), (2, None)]
    out = judged(spark, rows, [(1, None, None, "p"), (1, 0, 0, "p"), (None, 0, 1, "p")])
    assert [r["verdict"] for r in out.collect()] == ["allow"] * 3


def test_empty_tables(spark):
    assert judged(spark, [], [(1, 0, 0, "p")]).count() == 0


def test_no_python_in_the_plan(spark):
    plan = plan_of(judged(spark, [(1, "http://a.net/")], []))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
