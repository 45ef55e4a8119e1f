"""Stored pages -> content, pruned tokens, Markdown and output paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpipe.functions import urls
from docpipe.functions.columns import let, struct_of, with_once
from docpipe.functions.markdown import SILENT, to_markdown
from docpipe.functions.outline import outline
from docpipe.scratch import written

# Output paths that several pages claim are broadcast up to this many.
FEW_PATHS = 200_000


def _has_class(t: Column, name: str) -> Column:
    return t["class"].rlike(rf"(?:^|[ \t\r\n\f]){name}(?:[ \t\r\n\f]|$)")


# Where the content is looked for, in this order, before falling back to body.
CONTENT = (
    lambda t: t["tag"] == "main",
    lambda t: t["tag"] == "article",
    lambda t: (t["tag"] == "div") & _has_class(t, "docs-content"),
    lambda t: (t["tag"] == "div") & _has_class(t, "main-content"),
    lambda t: (t["tag"] == "div") & _has_class(t, "content-wrapper"),
    lambda t: (t["tag"] == "div") & _has_class(t, "td-main"),
    lambda t: (t["tag"] == "div") & (t["id"] == "content"),
    lambda t: (t["tag"] == "div") & (t["role"] == "main"),
    lambda t: t["tag"] == "body",
)


def is_boilerplate(t: Column) -> Column:
    """The tags, roles, classes and ids that mark navigation."""
    def contains(attribute: str, *words: str) -> Column:
        found = F.lit(False)
        for word in words:
            found = found | F.coalesce(F.contains(t[attribute], F.lit(word)), F.lit(False))
        return found

    return (
        t["tag"].isin("nav", "aside")
        | F.coalesce(t["role"] == "navigation", F.lit(False))
        | contains("class", "sidebar", "sidenav", "nav-menu", "table-of-contents")
        | contains("id", "sidebar", "sidenav", "nav-menu", "toc")
    )


def fetched(pages: DataFrame) -> DataFrame:
    """Pages whose fetch gave a body to read."""
    return pages.filter(F.col("html").isNotNull() & (F.col("html") != ""))


def _cut(tokens: Column, start: Column, stop: Column, holes: Column) -> Column:
    """tokens[start:stop] without the intervals in ``holes``, which are in document order."""
    gaps = "array<struct<start:int,stop:int>>"

    def skip(state: Column, hole: Column) -> Column:
        # A hole that begins before ``at`` lies inside the one already left out.
        return F.when(hole["pos"] < state["at"], state).otherwise(struct_of(
            at=hole["stop"],
            gaps=F.concat(state["gaps"], F.array(
                struct_of(start=state["at"], stop=hole["pos"]))),
        ))

    kept = F.aggregate(
        F.filter(holes, lambda hole: (hole["pos"] >= start) & (hole["stop"] <= stop)),
        struct_of(at=start, gaps=F.array().cast(gaps)),
        skip,
        lambda state: F.concat(
            state["gaps"], F.array(struct_of(start=state["at"], stop=stop))),
    )
    return F.flatten(F.transform(kept, lambda gap: F.slice(
        tokens, gap["start"] + 1, gap["stop"] - gap["start"])))


def parse_pages(pages: DataFrame) -> DataFrame:
    """One row per page that has content: ``tokens`` (whole page), ``content`` (pos, stop) and
    ``removed`` (the elements pruning drops). Narrow: nothing is shuffled."""
    parsed = outline(fetched(pages))
    openings = F.filter(
        F.transform("tokens", lambda t, i: F.when(t["kind"] == "open", struct_of(
            pos=i, stop=t["stop"], tag=t["tag"], id=t["id"], role=t["role"], **{"class": t["class"]}
        ))),
        lambda t: t.isNotNull(),
    )
    parsed = with_once(parsed, "openings", openings)
    choices = [F.get(F.filter("openings", rule), F.lit(0)) for rule in CONTENT]
    parsed = with_once(parsed, "content", let(F.coalesce(*choices), lambda t: F.when(
        t.isNotNull(), struct_of(pos=t["pos"], stop=t["stop"]))))
    parsed = parsed.filter(F.col("content").isNotNull())
    # The content element and its ancestors stay even when they look like navigation.
    removed = F.filter("openings", lambda t: is_boilerplate(t) & ~(
        (t["pos"] <= F.col("content.pos")) & (t["stop"] >= F.col("content.stop"))))
    silent = F.filter("openings", lambda t: t["tag"].isin(*SILENT))
    ends = [F.transform(c, lambda t: struct_of(pos=t["pos"], stop=t["stop"]))
            for c in (removed, silent)]
    return parsed.withColumns({"removed": ends[0], "silent": ends[1]}).drop("openings")


def content_tokens(parsed: DataFrame, prune: bool = True) -> Column:
    holes = F.array_sort(F.concat("removed", "silent")) if prune else F.col("silent")
    return _cut(F.col("tokens"), F.col("content.pos"), F.col("content.stop"), holes)


def page_tokens(parsed: DataFrame, prune: bool = True) -> Column:
    """Tokens of the whole page, after pruning by default."""
    if not prune:
        return F.col("tokens")
    return _cut(F.col("tokens"), F.lit(0), F.size("tokens"), F.col("removed"))


def page_content(pages: DataFrame, prune: bool = False) -> DataFrame:
    """Which element holds the content, and its plain text with white space collapsed."""
    parsed = parse_pages(pages)
    text = F.array_join(F.transform(
        content_tokens(parsed, prune),
        lambda t: F.when(t["kind"] == "text", t["text"]).otherwise("")), "")
    return parsed.select(
        "page_id", "url",
        F.get("tokens", F.col("content.pos"))["tag"].alias("content_tag"),
        F.trim(F.regexp_replace(text, r"[ \t\r\n\f]+", " ")).alias("content_text"),
    )


def pruned_text(pages: DataFrame) -> DataFrame:
    """Text of the whole page after pruning, white space collapsed."""
    parsed = parse_pages(pages)
    visible = _cut(F.col("tokens"), F.lit(0), F.size("tokens"),
                   F.array_sort(F.concat("removed", "silent")))
    text = F.array_join(F.transform(
        visible, lambda t: F.when(t["kind"] == "text", t["text"]).otherwise("")), "")
    return parsed.select(
        "page_id", F.size("removed").alias("n_removed"),
        F.trim(F.regexp_replace(text, r"[ \t\r\n\f]+", " ")).alias("page_text"))


def prune_stats(pages: DataFrame) -> DataFrame:
    """Pages and removed elements per host."""
    parsed = parse_pages(pages)
    return (
        parsed.select(urls.authority(F.col("url")).alias("host"), F.size("removed").alias("n"))
        .groupBy("host")
        .agg(F.count("*").alias("n_pages"), F.sum("n").alias("n_removed"))
    )


def output_paths(pages: DataFrame) -> DataFrame:
    return pages.select(
        "page_id", "url", urls.authority(F.col("url")).alias("host"),
        urls.output_path(F.col("url")).alias("output_path"))


def markdown_of(parsed: DataFrame) -> DataFrame:
    """page_id, url, host, output_path, markdown of parsed pages; other columns stay."""
    made = {
        "host": urls.authority(F.col("url")),
        "output_path": urls.output_path(F.col("url")),
        "markdown": to_markdown(content_tokens(parsed)),
    }
    return parsed.withColumns(made).drop("tokens", "content", "removed", "silent")


def extract_markdown(pages: DataFrame) -> DataFrame:
    """page_id, url, host, output_path, markdown for every page that has content."""
    return markdown_of(parse_pages(pages.select("page_id", "url", "html")))


def latest_per_path(documents: DataFrame) -> DataFrame:
    """The page fetched last wins its output path; of rows that repeat a page one stays.

    ``documents`` is written once with row numbers. Only ids, URLs and paths are then compared: paths
    that several pages claim are folded on the map side, and the losing rows are left out of the
    written table, whose texts stay where they are.
    """
    rows = written(documents.withColumn("_row", F.monotonically_increasing_id()), "documents")
    claimed = rows.groupBy("host", "output_path").agg(
        F.max(F.struct("page_id", "url", "_row")).alias("last"), F.count(F.lit(1)).alias("n"))
    claimed = written(claimed.filter("n > 1").select(
        F.col("host").alias("_host"), F.col("output_path").alias("_path"),
        F.col("last._row").alias("_last")), "claimed")
    if claimed.limit(FEW_PATHS + 1).count() <= FEW_PATHS:
        claimed = F.broadcast(claimed)
    same = F.col("host").eqNullSafe(F.col("_host")) & F.col("output_path").eqNullSafe(F.col("_path"))
    met = rows.join(claimed, same, "left")
    return met.filter(F.col("_last").isNull() | (F.col("_last") == F.col("_row"))).select(*documents.columns)
