"""URL expressions. They split by pattern, as RFC 3986 appendix B does, so a malformed URL gives
empty parts instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docpipe.functions.columns import let

SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
QUERY = r"^[^?#]*(\?[^#]*)"


def without_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def authority(url: Column) -> Column:
    """host[:port] with any user part, exactly as written; empty when there is none."""
    return F.regexp_extract(url, AUTHORITY, 1)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, PATH, 1)


def output_path(url: Column) -> Column:
    """Relative Markdown path of a page: URL path without outer slashes plus ``.md``."""
    # ``;parameters`` of the last segment are not part of the path.
    path = F.regexp_replace(url_path(url), r";[^/]*$", "")
    path = F.regexp_replace(F.trim(path, F.lit("/")), r"/+", "/")
    return F.when(path == "", F.lit("index.md")).otherwise(F.concat(path, F.lit(".md")))


def fold_dots(segments: Column) -> Column:
    """Path segments after the leading slash -> absolute path without ``.`` and ``..``."""
    def step(kept: Column, segment: Column) -> Column:
        return (
            F.when(segment == ".", kept)
            .when(segment == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
            .otherwise(F.concat(kept, F.array(segment)))
        )

    folded = F.aggregate(segments, F.array().cast("array<string>"), step)
    ends_on_dots = F.element_at(segments, -1).isin(".", "..")
    folded = F.when(ends_on_dots, F.concat(folded, F.array(F.lit("")))).otherwise(folded)
    return F.concat(F.lit("/"), F.array_join(folded, "/"))


def resolve(base: Column, href: Column) -> Column:
    """Absolute URL of ``href`` seen on page ``base``, fragment removed. An href with the page's own
    scheme and no host is relative."""
    stripped = F.regexp_replace(href, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    ref = without_fragment(F.regexp_replace(stripped, r"[\t\r\n]", ""))
    own = F.lower(F.regexp_extract(ref, SCHEME, 1)) == F.lower(F.regexp_extract(base, SCHEME, 1))
    rest = F.regexp_replace(ref, SCHEME, "")
    ref = F.when(ref.rlike(SCHEME) & own & ~rest.startswith("//"), rest).otherwise(ref)
    base_path = url_path(base)
    site = F.concat(F.regexp_extract(base, SCHEME, 0), F.lit("//"), authority(base))

    def relative(ref: Column) -> Column:
        query = F.regexp_extract(ref, QUERY, 1)
        path = F.regexp_extract(ref, r"^[^?]*", 0)
        rooted = F.split(F.substring(path, 2, 1 << 30), "/")
        folder = F.regexp_replace(base_path, r"[^/]*$", "")
        joined = F.split(F.concat(F.ltrim(folder, F.lit("/")), path), "/")
        # A relative path collapses doubled slashes; only the last segment may be empty.
        joined = F.filter(joined, lambda s, i: (s != "") | (i == F.size(joined) - 1))
        return (
            F.when(ref == "", F.concat(site, base_path, F.regexp_extract(base, QUERY, 1)))
            .when(path == "", F.concat(site, base_path, query))
            .when(path.startswith("/"), F.concat(site, fold_dots(rooted), query))
            .otherwise(F.concat(site, fold_dots(joined), query))
        )

    return let(ref, lambda ref: (
        F.when(ref.rlike(SCHEME), ref)
        .when(ref.startswith("//"), F.concat(F.regexp_extract(base, SCHEME, 0), ref))
        .otherwise(relative(ref))
    ))
