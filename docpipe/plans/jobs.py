"""The user-facing jobs: site -> Markdown, Markdown -> vector table, queries -> ranked chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.functions import urls
from docpipe.functions.text import DEFAULT_LIMIT
from docpipe.operators import chunking, embedding, links, pages, retrieval
from docpipe.schemas import HITS
from docpipe.scratch import cut_lineage, written
from docpipe.sources import page_store, vector_store

# Up to this many files are named in the scan of the hits' texts, and up to this many hits (ids and
# places, no texts) are broadcast to it; beyond, the hits are joined by shuffle.
FEW_FILES = 1000
FEW_HITS = 100_000


def site_to_markdown(
    stored: DataFrame, base_url: str | None = None, path_filter: str = "", prune_first: bool = True
) -> DataFrame:
    """Markdown of the stored pages, the last page per output path.

    With ``base_url`` only the pages a crawl from there reaches: links followed from page to page,
    on the same host, through URLs that contain ``path_filter``. No page outside that scope can be
    reached, so none is parsed; those inside are parsed once, for links and text together. A page is
    known by its URL without the fragment; of several rows of one URL the last ``page_id`` counts.
    ``prune_first`` leaves links in pruned navigation aside.
    """
    if base_url is None:
        return pages.latest_per_path(pages.extract_markdown(stored))
    spark = stored.sparkSession
    base_url = base_url.split("#", 1)[0]
    stored = stored.withColumn("url", urls.without_fragment(F.col("url")))
    scope = links.scope(F.col("url"), base_url, path_filter) | (F.col("url") == base_url)
    parsed = pages.parse_pages(stored.filter(scope))
    parsed = pages.markdown_of(parsed.withColumn("hrefs", links.page_hrefs(parsed, prune_first)))
    site = written(parsed, "site")
    last = site.groupBy("url").agg(F.max("page_id").alias("page_id"))
    found = site.select("url", "page_id", "hrefs").join(last, ["url", "page_id"], "left_semi")
    found = links.resolve_links(found.select("url", F.explode("hrefs").alias("href")))
    seeds = spark.createDataFrame([(base_url,)], "url string")
    reached = links.crawl(found, seeds, path_filter).select("url")
    return pages.latest_per_path(site.drop("hrefs").join(reached, "url", "left_semi"))


def store_site(
    stored: DataFrame, path: str, base_url: str | None = None, path_filter: str = "",
    prune_first: bool = True,
) -> DataFrame:
    """``site_to_markdown`` stored as the Markdown table at ``path``; returns the stored rows."""
    page_store.write_markdown(site_to_markdown(stored, base_url, path_filter, prune_first), path)
    return page_store.read_markdown_table(stored.sparkSession, path)


def index_site(
    stored: DataFrame, markdown_path: str, index_path: str, base_url: str | None = None,
    path_filter: str = "", backend: embedding.Backend | None = None,
) -> DataFrame:
    """Pages to Markdown table to vector table, ready for ``retrieve``; returns the index report."""
    markdown = store_site(stored, markdown_path, base_url, path_filter)
    return rebuild(markdown_documents(markdown), index_path, backend=backend)


def markdown_documents(markdown: DataFrame) -> DataFrame:
    """Rows of the Markdown table as documents: source_path = host/output_path."""
    return markdown.select(
        F.concat_ws("/", "host", "output_path").alias("source_path"),
        F.col("markdown").alias("text"))


CHUNKERS = {
    "recursive": chunking.chunk_recursive,
    "semantic": chunking.chunk_semantic,
    "tokens": chunking.chunk_tokens,
}


def embedded_chunks(
    documents: DataFrame, limit: int = DEFAULT_LIMIT, backend: embedding.Backend | None = None,
    chunker: str = "recursive",
) -> DataFrame:
    """(id, text, source_path, vector) of every chunk, the vector null where embedding failed. ``limit``
    is the recursive chunker's. No shuffle."""
    docs = documents.select("source_path", "text")
    chunks = CHUNKERS[chunker](docs, limit) if chunker == "recursive" else CHUNKERS[chunker](docs)
    return embedding.vector_rows(embedding.embed(chunking.with_chunk_id(chunks), "text", backend))


def index_rows(
    documents: DataFrame, limit: int = DEFAULT_LIMIT, backend: embedding.Backend | None = None,
    chunker: str = "recursive",
) -> DataFrame:
    """The chunks that could be embedded."""
    return embedding.valid_only(embedded_chunks(documents, limit, backend, chunker))


def rebuild(
    documents: DataFrame, path: str, limit: int = DEFAULT_LIMIT,
    backend: embedding.Backend | None = None, chunker: str = "recursive",
) -> DataFrame:
    """Full rebuild of the vector table at ``path``. The chunks are written once before they are sorted
    out, so a model sees each of them once. Returns the report: stored and dropped chunks per source."""
    chunks = written(embedded_chunks(documents, limit, backend, chunker), "chunks")
    vector_store.replace_rows(embedding.valid_only(chunks), path)
    return embedding.failure_report(chunks)


def build_index(
    documents: DataFrame, path: str, limit: int = DEFAULT_LIMIT,
    backend: embedding.Backend | None = None, chunker: str = "recursive",
) -> int:
    """``rebuild`` that returns the number of stored rows."""
    rebuild(documents, path, limit, backend, chunker)
    return vector_store.count_rows(documents.sparkSession, path)


def retrieve(
    spark: SparkSession, path: str, queries: DataFrame, k: int = 3,
    backend: embedding.Backend | None = None,
) -> DataFrame:
    """The k nearest stored chunks per row of ``queries(query_id, query_text)``.

    The search reads only ids and vectors and carries each row's place in its file. Its result, at
    most k rows per query, is kept; text and source are then fetched for those rows alone, from the
    files that hold them where these are few. A missing table or an unembeddable query gives no
    rows.
    """
    if not vector_store.has_table(spark, path):
        return spark.createDataFrame([], HITS)
    stored = vector_store.open_table(spark, path)
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    asked = embedding.embed(queries, "query_text", backend).select("query_id", "vector")
    hits = cut_lineage(retrieval.nearest(
        stored.select("id", "vector", *place), asked, k, keep=("id", "_file", "_row")))
    rows = stored
    files = [r["_file"] for r in hits.select("_file").distinct().limit(FEW_FILES + 1).collect()]
    if len(files) <= FEW_FILES:
        rows = rows.filter(F.col("_metadata.file_path").isin(files))
    rows = rows.select("text", "source_path", *place)
    if hits.limit(FEW_HITS + 1).count() <= FEW_HITS:
        hits = F.broadcast(hits)
    return rows.join(hits, ["_file", "_row"]).select(
        "query_id", "rank", "id", "source_path", "text", "distance")


def ask(
    spark: SparkSession, path: str, texts: Sequence[str], k: int = 5,
    backend: embedding.Backend | None = None,
) -> DataFrame:
    """``retrieve`` for a handful of query strings, numbered from 0."""
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id long, query_text string")
    return retrieve(spark, path, queries, k, backend)
