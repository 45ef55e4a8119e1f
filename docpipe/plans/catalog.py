"""Named queries over the given tables, one per operator of the inventory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docpipe.functions import urls
from docpipe.functions import vectors as v
from docpipe.operators import chunking, embedding, links, pages, retrieval
from docpipe.plans import jobs
from docpipe.scratch import scratch_table
from docpipe.session import spread
from docpipe.sources import page_store, vector_store

SCOPE_FILTER = "/t"
CRAWL_FILTER = "/e"


def _page_table(spark: SparkSession, sf: str) -> DataFrame:
    return page_store.read_pages(spark, f"{sf}/pages.parquet")


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    """The page table for jobs that parse it."""
    return spread(_page_table(spark, sf), "page_id")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.select(F.concat(F.lit("doc_"), "doc_id", F.lit(".md")).alias("source_path"), "text")
    return spread(docs, "source_path")


def _embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/embeddings.parquet")


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The embeddings table in the shape of the vector store."""
    return _embeddings(spark, sf).select(
        F.concat(F.lit("vec_"), "vec_id").alias("id"),
        F.concat(F.lit("vector of label "), "label").alias("text"),
        F.concat(F.lit("label_"), "label").alias("source_path"),
        F.col("embedding").alias("vector"),
    )


def _questions(spark: SparkSession, sf: str) -> DataFrame:
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    return items.select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunk_recursive(_documents(spark, sf))


# Sources and sinks

def store_roundtrip(spark, sf):
    path = scratch_table(spark, "vectors")
    vector_store.append_rows(_vectors(spark, sf), path)
    squares = v.dot(F.col("vector"), F.col("vector"))
    return vector_store.open_table(spark, path).select(
        "id", "text", "source_path", F.size("vector").alias("width"),
        F.round(squares, 6).alias("squares"))


def store_count(spark, sf):
    path = scratch_table(spark, "vectors")
    vector_store.append_rows(_vectors(spark, sf), path)
    vector_store.append_rows(_vectors(spark, sf), path)
    return vector_store.open_table(spark, path).agg(F.count("*").alias("n_rows"))


def store_rebuild(spark, sf):
    """Two rebuilds on one path leave the rows of the second."""
    path = scratch_table(spark, "vectors")
    rows = _vectors(spark, sf)
    vector_store.replace_rows(rows, path)
    vector_store.replace_rows(rows.filter("source_path <> 'label_0'"), path)
    n = vector_store.count_rows(spark, path)
    return vector_store.open_table(spark, path).groupBy("source_path").agg(
        F.count("*").alias("n_rows"), F.max(F.size("vector")).alias("width"),
        F.lit(n).cast("long").alias("n_all"))


def page_sink_latest(spark, sf):
    path = scratch_table(spark, "markdown")
    return jobs.store_site(_pages(spark, sf), path).select(
        "host", "output_path", "page_id", "url", "markdown")


def chunk_counts(spark, sf):
    return chunking.chunk_counts(_chunks(spark, sf), _documents(spark, sf))


def corpus_totals(spark, sf):
    return chunking.corpus_totals(_documents(spark, sf), _chunks(spark, sf))


# Pages and links

def page_content(spark, sf):
    return pages.page_content(_pages(spark, sf)).drop("url")


def page_prune(spark, sf):
    return pages.pruned_text(_pages(spark, sf))


def page_markdown(spark, sf):
    return pages.extract_markdown(_pages(spark, sf)).select("page_id", "markdown")


def page_output_path(spark, sf):
    return pages.output_paths(_page_table(spark, sf))


def page_prune_stats(spark, sf):
    return pages.prune_stats(_pages(spark, sf))


def page_links(spark, sf):
    return links.extract_links(_pages(spark, sf), prune_first=False)


def _resolved(stored):
    return links.resolve_links(links.extract_links(stored, prune_first=False))


def links_resolved(spark, sf):
    return _resolved(_pages(spark, sf)).select("page_id", "href", "target")


def links_in_scope(spark, sf):
    """Crawl scope of the site with the most pages."""
    sites = pages.output_paths(_page_table(spark, sf)).groupBy("host").count()
    largest = sites.orderBy(F.desc("count"), "host").first()["host"]
    return links.in_scope(
        _resolved(_pages(spark, sf)), f"https://{largest}/", SCOPE_FILTER).select("page_id", "target")


def links_unvisited(spark, sf):
    """Targets first seen on pages without a query part, given those of the others as visited."""
    stored = _pages(spark, sf)
    with_query = F.contains("url", F.lit("?"))
    visited = _resolved(stored.filter(with_query)).select(F.col("target").alias("url"))
    return links.unvisited(_resolved(stored.filter(~with_query)), visited)


def links_dangling(spark, sf):
    """Links that nothing answers, where pages with a query part could not be fetched."""
    stored = _pages(spark, sf)
    failed = stored.withColumn("html", F.when(~F.contains("url", F.lit("?")), F.col("html")))
    return links.dangling(_resolved(stored), failed)


def _fragment():
    """A page's own fragment, which stays with its stored URL."""
    return F.regexp_extract("url", "#.*$", 0)


def _site(spark, sf):
    """The stored pages as one site: page n links to pages 2n+1 and 2n+2, to the first page and to
    itself."""
    stored = pages.output_paths(_page_table(spark, sf))
    nodes = stored.select("page_id", F.concat(
        F.lit("https://docs.example.org/"), "output_path", F.lit("?page="), "page_id").alias("url"),
        _fragment().alias("fragment"))
    parent = F.floor((F.col("page_id") - 1) / 2)
    down = nodes.filter("page_id > 0").select(parent.alias("page_id"), F.col("url").alias("target"))
    home = nodes.filter("page_id = 0").select(F.col("url").alias("target"))
    edges = nodes.join(down, "page_id").select(F.concat("url", "fragment").alias("url"), "target")
    home_url = home.first()["target"]
    return nodes, (
        edges
        .unionByName(nodes.select(F.concat("url", "fragment").alias("url"), F.lit(home_url).alias("target")))
        .unionByName(nodes.select(F.concat("url", "fragment").alias("url"), F.col("url").alias("target")))
    ), home


def crawl_reach(spark, sf):
    _, edges, home = _site(spark, sf)
    return links.crawl(edges, home.select(F.col("target").alias("url")), CRAWL_FILTER)


def site_crawl(spark, sf):
    """Crawl and conversion in one job, over the stored pages moved to one site: the content of page
    n gets links to pages 2n+1 and 2n+2 as far as they exist."""
    stored = _pages(spark, sf)
    paths = stored.select("page_id", F.concat(
        F.lit("/"), urls.output_path(F.col("url")), F.lit("?page="), "page_id").alias("path"))
    site = stored.withColumn("fragment", _fragment()).drop("url").join(paths, "page_id")
    anchors = []
    for offset in (1, 2):
        child = paths.select(
            ((F.col("page_id") - offset) / 2).alias("at"), F.col("path").alias(f"child{offset}")
        ).filter(F.col("at") == F.floor("at")).select(
            F.col("at").cast("long").alias("page_id"), f"child{offset}")
        site = site.join(child, "page_id", "left")
        anchors.append(F.coalesce(F.concat(
            F.lit('<a href="'), f"child{offset}", F.lit(f'">{offset}</a>')), F.lit("")))
    html = F.replace("html", F.lit("<article>"), F.concat(F.lit("<article>"), *anchors))
    origin = "https://docs.example.org"
    site = site.select("page_id", F.concat(F.lit(origin), "path", "fragment").alias("url"), html.alias("html"))
    first = site.filter("page_id = 0").select("url").first()["url"]
    return jobs.site_to_markdown(site, first, CRAWL_FILTER)


# Chunks

def chunk_recursive(spark, sf):
    return _chunks(spark, sf).select("source_path", "chunk_index", "text")


def chunk_offsets(spark, sf):
    return _chunks(spark, sf).drop("text")


def chunk_tokens(spark, sf):
    return chunking.chunk_tokens(_documents(spark, sf), size=512, overlap=128)


def chunk_semantic(spark, sf):
    return chunking.chunk_semantic(_documents(spark, sf)).withColumn(
        "n_sentences", F.size("sentences")).drop("sentences")


def sentences(spark, sf):
    return chunking.split_sentences(_documents(spark, sf))


def chunk_ids(spark, sf):
    return chunking.with_chunk_id(_chunks(spark, sf)).select("id", "source_path", "chunk_index")


def chunk_token_stats(spark, sf):
    return chunking.token_report(_chunks(spark, sf), _documents(spark, sf))


# Embeddings

def embed_hashed(spark, sf):
    embedded = embedding.embed(_documents(spark, sf))
    return embedded.select(
        "source_path", F.posexplode("vector").alias("bucket", "weight")
    ).filter("weight > 0").withColumn("weight", F.round(F.col("weight").cast("double"), 6))


class LetterCounts:
    """A stand-in for a user's model."""

    def encode(self, texts):
        return [[len(t), t.count("e"), t.count(" ")] if t.strip() else None for t in texts]


def embed_model(spark, sf):
    chunks = chunking.with_chunk_id(_chunks(spark, sf)).select("id", "text")
    embedded = embedding.embed(chunks, backend=embedding.model(LetterCounts))
    return embedding.valid_only(embedded).select("id", *[
        F.get("vector", F.lit(i)).cast("double").alias(name)
        for i, name in enumerate(("chars", "letters_e", "spaces"))])


class FailsOnThree(LetterCounts):
    """A model that breaks on some texts."""

    def encode(self, texts):
        if any(t.endswith("3") for t in texts):
            raise RuntimeError("this text cannot be encoded")
        return super().encode(texts)


def _with_failures(spark, sf):
    """Texts sent to the model one by one, so that the layout does not decide which of them fail."""
    return embedding.embed(_vectors(spark, sf).drop("vector"),
                           backend=embedding.model(FailsOnThree, batch_size=1))


def embed_valid_only(spark, sf):
    return embedding.valid_only(_with_failures(spark, sf)).select("id", "source_path")


def embed_failures(spark, sf):
    return embedding.failure_report(_with_failures(spark, sf))


# Retrieval

def _mean_vectors(spark, sf, *keys):
    """Mean vector per key, rounded so that it does not depend on the order of summation."""
    parts = _embeddings(spark, sf).select(*keys, F.posexplode("embedding").alias("at", "x"))
    means = parts.groupBy(*keys, "at").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda p: p["x"])
    return means.groupBy(*keys).agg(ordered.alias("vector"))


def _shown(hits):
    return hits.withColumn("distance", F.round("distance", 6))


def knn_top_k(spark, sf):
    centre = _mean_vectors(spark, sf).first()["vector"]
    vectors = _embeddings(spark, sf).withColumnRenamed("embedding", "vector")
    return _shown(retrieval.nearest_to(vectors, centre, k=10, keep=("vec_id", "label")))


def knn_batch(spark, sf):
    """The stored vectors nearest to the centre of each label."""
    centres = _mean_vectors(spark, sf, "label").withColumnRenamed("label", "query_id")
    vectors = _embeddings(spark, sf).withColumnRenamed("embedding", "vector")
    return _shown(retrieval.nearest(vectors, centres, k=5, keep=("vec_id",)))


def knn_small_scale(spark, sf):
    """As ``knn_batch`` at a millionth of the size; distances are given relative to the nearest one."""
    centres = _mean_vectors(spark, sf, "label").select(F.col("label").alias("query_id"), _scaled("vector"))
    vectors = _embeddings(spark, sf).select("vec_id", _scaled("embedding"))
    hits = retrieval.nearest(vectors, centres, k=5, keep=("vec_id",))
    first = F.min("distance").over(Window.partitionBy("query_id"))
    return hits.withColumn("distance", F.round(F.col("distance") / first, 6))


def _scaled(column):
    return F.transform(column, lambda x: x.cast("double") * 1e-6).alias("vector")


def knn_report(spark, sf):
    path = scratch_table(spark, "index")
    jobs.build_index(_documents(spark, sf), path)
    return retrieval.hit_report(jobs.retrieve(spark, path, _questions(spark, sf), k=3), chars=150)


# Jobs

def site_to_markdown(spark, sf):
    return jobs.site_to_markdown(_pages(spark, sf))


def index_build(spark, sf):
    path = scratch_table(spark, "index")
    jobs.build_index(_documents(spark, sf), path)
    stored = vector_store.open_table(spark, path)
    used = F.size(F.filter("vector", lambda x: x > 0))
    return stored.select("id", "source_path", "text", used.alias("n_buckets"))


def index_semantic(spark, sf):
    """Index of semantic chunks."""
    path = scratch_table(spark, "index")
    jobs.build_index(_documents(spark, sf), path, chunker="semantic")
    return vector_store.open_table(spark, path).select("id", "source_path", "text")


def retrieve(spark, sf):
    path = scratch_table(spark, "index")
    jobs.build_index(_documents(spark, sf), path)
    return _shown(jobs.retrieve(spark, path, _questions(spark, sf), k=5))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        store_roundtrip, store_count, store_rebuild, page_sink_latest, chunk_counts, corpus_totals,
        page_content, page_prune, page_markdown, page_output_path, page_prune_stats,
        page_links, links_resolved, links_in_scope, links_unvisited, links_dangling, crawl_reach, site_crawl,
        chunk_recursive, chunk_offsets, chunk_tokens, chunk_semantic, sentences, chunk_ids,
        chunk_token_stats, embed_hashed, embed_model, embed_valid_only, embed_failures,
        knn_top_k, knn_batch, knn_small_scale, knn_report, site_to_markdown, index_build, index_semantic,
        retrieve,
    )
}
