"""Links between stored pages: extraction, resolution, scope, dedup and breadth-first reach."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpipe.functions import urls
from docpipe.functions.columns import with_once
from docpipe.operators.pages import fetched, page_tokens, parse_pages
from docpipe.scratch import written

# Finished levels are merged into one table whenever this many have piled up.
LEVELS_KEPT_APART = 8
# A frontier of up to this many URLs is sent to the scan of the edges.
SENT_URLS = 100_000


def page_hrefs(parsed: DataFrame, prune_first: bool = True) -> Column:
    """The hrefs of a parsed page in document order."""
    return F.transform(
        F.filter(page_tokens(parsed, prune_first), lambda t: (
            (t["kind"] == "open") & (t["tag"] == "a") & ~t["href"].startswith("#"))),
        lambda t: t["href"],
    )


def extract_links(pages: DataFrame, prune_first: bool = True) -> DataFrame:
    """One row per <a href> that is not a pure fragment. By default links that only occur in pruned
    navigation are not followed; pages without content have none."""
    parsed = parse_pages(pages)
    return parsed.select(
        "page_id", "url", F.explode(page_hrefs(parsed, prune_first)).alias("href"))


def resolve_links(links: DataFrame) -> DataFrame:
    """Adds ``target``, the absolute URL without fragment; unresolvable links drop out."""
    target = urls.resolve(F.col("url"), F.col("href"))
    return with_once(links, "target", target).filter(F.col("target").isNotNull())


def scope(url: Column, base_url: str, path_filter: str) -> Column:
    """Same host[:port] as the base, and ``path_filter`` anywhere in the URL."""
    return (urls.authority(url) == urls.authority(F.lit(base_url))) & F.contains(
        url, F.lit(path_filter))


def in_scope(links: DataFrame, base_url: str, path_filter: str) -> DataFrame:
    return links.filter(scope(F.col("target"), base_url, path_filter))


def unvisited(links: DataFrame, visited: DataFrame) -> DataFrame:
    """Distinct targets not in ``visited(url)``. The distinct comes first: its map-side half folds
    popular targets before the join sees them."""
    targets = links.select(F.col("target").alias("url")).distinct()
    return targets.join(visited.select("url").distinct(), "url", "left_anti")


def dangling(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Targets that no stored page answers, with the number of links to each. A page that could not be
    fetched answers nothing."""
    targets = links.groupBy(F.col("target").alias("url")).agg(F.count("*").alias("n_links"))
    # A page's own fragment is not part of its identity.
    known = fetched(pages).select(urls.without_fragment(F.col("url")).alias("url")).distinct()
    return targets.join(known, "url", "left_anti")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def crawl(
    links: DataFrame,
    seeds: DataFrame,
    path_filter: str = "",
    max_depth: int | None = None,
) -> DataFrame:
    """Breadth-first reach over ``links(url, target)`` from ``seeds(url)``: (url, depth).

    A target counts when it has its seed's host and contains ``path_filter``; seeds are exempt. A
    page's own fragment is not part of its identity. The edges are scoped, reduced to distinct pairs
    and written once, sorted by source; a level reads them without moving them while its frontier is
    small enough to be sent, and shuffles the new targets alone. Every level is written, which keeps
    the plan flat and lets the job outlive lost executors. The loop ends at the first empty level.
    """
    target = F.col("target")
    edges = links.select(urls.without_fragment(F.col("url")).alias("url"), "target").filter(
        (urls.authority(F.col("url")) == urls.authority(target)) & F.contains(target, F.lit(path_filter)))
    edges = written(edges.distinct().sortWithinPartitions("url"), "edges")
    start = seeds.select(urls.without_fragment(F.col("url")).alias("url")).distinct()
    frontier = written(start.withColumn("depth", F.lit(0)), "level")
    levels, depth = [frontier], 0
    while max_depth is None or depth < max_depth:
        depth += 1
        few = frontier.count() <= SENT_URLS
        found = edges.join(F.broadcast(frontier) if few else frontier, "url").select(
            target.alias("url")).distinct()
        found = found.join(_union(levels).select("url"), "url", "left_anti")
        frontier = written(found.withColumn("depth", F.lit(depth)), "level")
        if frontier.isEmpty():
            break
        levels.append(frontier)
        if len(levels) > LEVELS_KEPT_APART:
            levels = [written(_union(levels), "levels")]
    return _union(levels)
