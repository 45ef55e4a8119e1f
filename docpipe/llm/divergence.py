"""Source divergence audit: how far each source's term distribution is from the other sources of its
language, and which terms it over-uses against its language.

Method: an Arrow compute pipeline inside ``mapInArrow`` (``ascii_lower``, ``split_pattern_regex``,
``dictionary_encode`` and a hash ``group_by``) turns each batch of texts into partial counts per
(lang, source, term): occurrences and documents. Spark merges the partial counts (partial aggregation
before the shuffle, so a hot source or a frequent term is combined map-side) into columnar counts per
group and language, and the divergences are joins and aggregates over those counts.

Definitions (all arithmetic exact, in integers):

- null text, lang and source read as ''. Terms are the matches of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``
  (runs of ASCII letters and non-ASCII characters) after A-Z, and only A-Z, are lower-cased.
- a language keeps the V terms that occur in at least ``MIN_DOCS`` of its documents (rows).
- for a group (a (lang, source) that occurs, even without terms) and for a whole language, each kept
  term gets ``p = 1 + floor(1e9 * (count + 1) / (N + V))``, N the group's count summed over kept terms.
- ``f(p, q) = floor((p - q)^2 / q)``.
- part ``pair``: for group g and each other source h of the language, ``value = sum over kept terms of
  f(p_g, p_h)`` (0 when V = 0); all ranks are returned.
- part ``term``: for each kept term with a count above 0 in g and ``p_g > q``, q the language's p,
  ``value = f(p_g, q)``; ranks up to ``TOP_TERMS``.
- rank: from 1 per (lang, source, part), value descending, then item ascending in UTF-8 byte order
  (ties are broken by the item, so ranks are unique).

Only kept terms that occur in g or h are touched: a pair's sum is taken over the terms that occur in
either side, plus the terms that occur in neither, which all have the two sides' zero-count p and are
counted, not listed. Empty tables give no rows; a language whose terms are all rare gives pair rows of
value 0 and no term rows; a single source gives no pair rows. Extra columns of ``docs`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docpipe.llm.tables import stored
from docpipe.llm.words import by_size

# Fixed values of the contract.
TERM_SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200

# Bytes of text whose terms are listed at a time.
SLICE_BYTES = 1 << 19

PARTIAL = "lang string, source string, term string, n_docs long, n long"


def _slice_counts(batch: pa.RecordBatch) -> pa.Table:
    """Documents and occurrences per (lang, source, term) of a few texts."""
    pieces = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), pattern=TERM_SEPARATORS)
    flat = pc.list_flatten(pieces)
    row = pc.list_parent_indices(pieces)
    real = pc.not_equal(flat, "")
    terms = pc.dictionary_encode(pc.filter(flat, real))
    rows = pc.filter(row, real)
    # Occurrences of each term in each document, then documents and occurrences per group and term.
    per_doc = pa.table({"row": rows, "term": terms.indices}).group_by(["row", "term"], use_threads=False).aggregate(
        [([], "count_all")])
    doc_rows = per_doc.column("row")
    per_group = pa.table({
        "lang": pc.take(batch.column("lang"), doc_rows), "source": pc.take(batch.column("source"), doc_rows),
        "term": per_doc.column("term"), "n": per_doc.column("count_all"),
    }).group_by(["lang", "source", "term"], use_threads=False).aggregate([([], "count_all"), ("n", "sum")])
    return pa.table({
        "lang": per_group.column("lang"), "source": per_group.column("source"),
        "term": pc.take(terms.dictionary, per_group.column("term")),
        "n_docs": per_group.column("count_all").cast(pa.int64()), "n": per_group.column("n_sum").cast(pa.int64())})


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (lang, source, term) of one batch of texts; each (lang, source)
    of the batch also gives one row with a null term and zero counts, so groups without terms are seen.

    A text's terms take many times its size while they are counted, so a batch is split ``SLICE_BYTES``
    at a time and only the slices' counts are held until its end."""
    names = ["lang", "source", "term", "n_docs", "n"]
    for batch in batches:
        if batch.num_rows == 0:
            continue
        filled = pa.RecordBatch.from_arrays(
            [pc.fill_null(batch.column(name), "") for name in ("lang", "source", "text")],
            names=["lang", "source", "text"])
        counted = pa.concat_tables([_slice_counts(part) for part in by_size(filled, 2, SLICE_BYTES)])
        merged = counted.group_by(["lang", "source", "term"], use_threads=False).aggregate(
            [("n_docs", "sum"), ("n", "sum")]).select(
            ["lang", "source", "term", "n_docs_sum", "n_sum"]).rename_columns(names)
        yield from merged.to_batches()
        groups = filled.select(["lang", "source"])
        groups = pa.Table.from_batches([groups]).group_by(["lang", "source"], use_threads=False).aggregate([])
        zeros = pa.array([0] * groups.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays([
            groups.column("lang").combine_chunks(), groups.column("source").combine_chunks(),
            pa.nulls(groups.num_rows, pa.string()), zeros, zeros,
        ], names=names)
        del counted, merged, filled
        pa.default_memory_pool().release_unused()


def _p(count: str, total: str, v: str):
    """``1 + floor(SCALE * (count + 1) / (total + v))`` by integer division: in longs while the product
    fits one, else in decimals, which do not overflow at any corpus size; p is at most SCALE + 1."""
    return F.expr(f"1 + CASE WHEN {count} < 9000000000 THEN "
                  f"(CAST({SCALE} AS BIGINT) * CAST({count} + 1 AS BIGINT)) div CAST({total} + {v} AS BIGINT) "
                  f"ELSE (CAST({SCALE} AS DECIMAL(38,0)) * CAST({count} + 1 AS DECIMAL(38,0))) "
                  f"div CAST({total} + {v} AS DECIMAL(38,0)) END")


def _f_long(p: str, q: str):
    """``floor((p - q)^2 / q)`` as a long: with p and q from 1 to SCALE + 1 it is at most SCALE squared,
    so three of them still fit one."""
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def _f(p: str, q: str):
    """The same as a decimal, to be summed or weighted without overflow."""
    return _f_long(p, q).cast("decimal(38,0)")


def _exact_sum(value: str):
    """Sum of a long column as a decimal: its upper and lower parts are summed as longs, which is much
    cheaper per row than a sum of decimals and as exact."""
    upper, lower = F.sum(F.shiftright(value, 30)), F.sum(F.col(value).bitwiseAND(F.lit((1 << 30) - 1)))
    return upper.cast("decimal(27,0)") * F.lit(1 << 30).cast("decimal(10,0)") + lower.cast("decimal(38,0)")


def _ranked(df: DataFrame, keep: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source", "part").orderBy(
        F.col("value").desc(), F.col("item").cast("binary"))
    ranked = df.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= keep) if keep else ranked


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Divergences of every (lang, source) group of ``docs``: rows of lang, source, part ('pair' or
    'term'), item (the other source, or the term), value long and rank int, as the module describes."""
    texts = docs.select(F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"),
                        F.col(text).cast("string").alias("text"))
    partial = texts.mapInArrow(_partial_counts, PARTIAL)
    counts = stored(partial.groupBy("lang", "source", "term").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n")), "divergence-counts")

    groups = counts.select("lang", "source").distinct()
    terms = counts.where(F.col("term").isNotNull())
    kept = terms.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n_lang")) \
        .where(F.col("n_docs") >= MIN_DOCS).drop("n_docs")
    vocab = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("total_lang"))

    # Counts of kept terms per group, with the group's total N and the language's V.
    used = terms.join(kept.select("lang", "term"), ["lang", "term"]).select("lang", "source", "term", "n")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sized = groups.join(totals, ["lang", "source"], "left").join(vocab.select("lang", "v"), "lang", "left") \
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"),
                F.coalesce("v", F.lit(0)).alias("v"))
    sized = stored(sized.withColumn(
        "zero", F.when(F.col("v") > 0, _p("0", "total", "v"))), "divergence-groups")
    cells = stored(used.join(sized, ["lang", "source"]).select(
        "lang", "source", "term", "n", "zero", _p("n", "total", "v").alias("p")),
        "divergence-cells")

    # Part term: the group's p against the language's.
    langs = kept.join(vocab, "lang").select("lang", "term", _p("n_lang", "total_lang", "v").alias("q"))
    term_part = cells.join(langs, ["lang", "term"]).where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f("p", "q").alias("value"))

    # Part pair. Terms in both g and h ...
    g, h = cells.alias("g"), cells.alias("h")
    both = g.join(h, (F.col("g.lang") == F.col("h.lang")) & (F.col("g.term") == F.col("h.term"))
                  & (F.col("g.source") != F.col("h.source"))).select(
        F.col("g.lang").alias("lang"), F.col("g.source").alias("source"), F.col("h.source").alias("item"),
        (_f_long("g.p", "h.p") - _f_long("g.p", "h.zero") - _f_long("g.zero", "h.p")).alias("value"))
    # Summed as longs; only the sums, one per pair, meet the other parts as decimals.
    both = both.groupBy("lang", "source", "item").agg(
        _exact_sum("value").cast("decimal(38,0)").alias("value"), F.count("*").alias("common"))
    # ... terms of g against h's zero p, in both directions (g's side for (g, h), h's side for (h, g)) ...
    # Terms of equal count in a group have equal p, so each distinct p of g meets h's zero p once,
    # weighted by how many terms have it (a group has far fewer distinct counts than terms).
    alike = cells.groupBy("lang", "source", "p").agg(F.count("*").alias("k"))
    others = sized.select("lang", F.col("source").alias("other"), F.col("zero").alias("other_zero"))
    spread = alike.join(others, "lang").where(F.col("source") != F.col("other"))
    sides_of = F.explode(F.array(
        F.struct(F.col("source").alias("source"), F.col("other").alias("item"),
                 (F.col("k") * _f("p", "other_zero")).alias("value")),
        F.struct(F.col("other").alias("source"), F.col("source").alias("item"),
                 (F.col("k") * _f("other_zero", "p")).alias("value"))))
    one_sided = spread.select("lang", sides_of.alias("s")).select(
        "lang", "s.source", "s.item", "s.value", F.lit(0).cast("long").alias("common"))
    listed = both.unionByName(one_sided).groupBy("lang", "source", "item").agg(
        F.sum("value").alias("listed"), F.sum("common").alias("common"))
    # ... and the terms in neither, each worth f(zero_g, zero_h).
    sides = sized.select("lang", "source", F.col("zero").alias("zero_g"), "v")
    item_sides = sized.select("lang", F.col("source").alias("item"), F.col("zero").alias("zero_h"))
    used_count = cells.groupBy("lang", "source").agg(F.count("*").alias("nnz"))
    pairs = sides.join(item_sides, "lang").where(F.col("source") != F.col("item")) \
        .join(used_count, ["lang", "source"], "left") \
        .join(used_count.select("lang", F.col("source").alias("item"), F.col("nnz").alias("nnz_h")), ["lang", "item"], "left") \
        .join(listed, ["lang", "source", "item"], "left")
    neither = F.col("v") - F.coalesce("nnz", F.lit(0)) - F.coalesce("nnz_h", F.lit(0)) + F.coalesce("common", F.lit(0))
    pair_value = F.when(F.col("v") == 0, F.lit(0).cast("decimal(38,0)")).otherwise(
        F.coalesce("listed", F.lit(0)) + neither.cast("decimal(38,0)") * _f("zero_g", "zero_h"))
    pair_part = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", pair_value.alias("value"))

    out = _ranked(pair_part, None).unionByName(_ranked(term_part, TOP_TERMS))
    return out.select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"),
                      F.col("rank").cast("int").alias("rank"))
