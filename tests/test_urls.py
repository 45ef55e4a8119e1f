from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from docpipe.functions import urls

BASE = "http://a/b/c/d;p?q"

# The examples of RFC 3986, section 5.4, without fragments.
RFC = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/",
    "http:g": "http://a/b/c/g", "HTTP:/g": "http://a/g", "\x0bg\x01": "http://a/b/c/g",
    "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y",
    "#s": "http://a/b/c/d;p?q", "g#s": "http://a/b/c/g", "g?y#s": "http://a/b/c/g?y",
    ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "g;x?y#s": "http://a/b/c/g;x?y",
    "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/",
    "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/", "../../": "http://a/",
    "../../g": "http://a/g", "../../../g": "http://a/g", "../../../../g": "http://a/g",
    "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g",
    "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g", "./../g": "http://a/b/g",
    "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h",
    "g;x=1/./y": "http://a/b/c/g;x=1/y", "g;x=1/../y": "http://a/b/c/y",
    "g?y/./x": "http://a/b/c/g?y/./x", "g?y/../x": "http://a/b/c/g?y/../x",
}


def _resolve(spark, pairs):
    df = spark.createDataFrame(pairs, "base string, href string")
    return [r[0] for r in df.select(urls.resolve(F.col("base"), F.col("href"))).collect()]


def test_rfc_3986_examples(spark):
    assert dict(zip(RFC, _resolve(spark, [(BASE, h) for h in RFC]))) == RFC


def test_agrees_with_the_standard_library(spark):
    bases = ["http://h.org", "https://h.org/", "https://u@h.org:8080/x/y/z.html?k=v#f",
             "https://h.org/x//y/", "https://h.org?only=query"]
    hrefs = ["a", "a/b/", "../a", "../../a/./b", "/a//b/../c", "?q", "?q#f", "", "#f", "//o.org/p",
             "https://o.org/a/../b?x#y", "mailto:me@o.org", "a b/c", "x/../../../..", "a//b",
             " /pad ", "a?b=/../c", "für/é", "./", "..", "a/.."]
    pairs = [(b, h) for b in bases for h in hrefs]
    want = [urljoin(b, h.strip()).split("#")[0] for b, h in pairs]
    assert list(zip(pairs, _resolve(spark, pairs))) == list(zip(pairs, want))


def test_resolving_twice_changes_nothing(spark):
    once = _resolve(spark, [(BASE, h) for h in RFC])
    assert _resolve(spark, [(BASE, u) for u in once]) == once


def test_authority_and_path_follow_the_standard_library(spark):
    cases = ["http://h.org", "http://h.org:80/a?b#c", "https://u:p@h.org/a/b", "mailto:x@y",
             "//h.org/a", "/a/b", "https://h.org?x=/y", "http://h.org/a b/ü"]
    df = spark.createDataFrame([(c,) for c in cases], "u string")
    got = df.select(urls.authority(F.col("u")), urls.url_path(F.col("u"))).collect()
    assert [tuple(r) for r in got] == [(urlparse(c).netloc, urlparse(c).path) for c in cases]


@pytest.mark.parametrize("url, want", [
    ("http://h.org", "index.md"), ("http://h.org/", "index.md"), ("http://h.org/?a=b", "index.md"),
    ("http://h.org/a/b/", "a/b.md"), ("http://h.org/a/b?x=1#y", "a/b.md"),
    ("http://h.org/a/b.html", "a/b.html.md"), ("http://h.org/a//b", "a/b.md"),
    ("http://h.org/a;x/b;v=1", "a;x/b.md"), ("http://h.org/für/é", "für/é.md"),
])
def test_output_path(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(urls.output_path(F.col("u"))).first()[0] == want


def test_random_relative_paths_agree_with_the_standard_library(spark):
    import random

    rng = random.Random(11)
    parts = ["a", "b.html", ".", "..", "c;d=e", "x y", "...", ".h"]

    def path():
        text = "/".join(rng.choice(parts) for _ in range(rng.randrange(1, 6)))
        return rng.choice(["", "/"]) + text + rng.choice(["", "/", "?q=../r", "#frag"])

    pairs = [("https://h.org/" + path().lstrip("/"), path()) for _ in range(400)]
    want = [urljoin(b, h).split("#")[0] for b, h in pairs]
    assert list(zip(pairs, _resolve(spark, pairs))) == list(zip(pairs, want))
