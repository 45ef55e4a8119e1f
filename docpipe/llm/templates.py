"""Benchmark decontamination by template canonicalisation.

Texts become token sequences in two forms. In the first every word is literal (lower-cased); in the
second a stretch of capitalised words is one ``name`` placeholder, so a question with other names keeps
its template. In both, numbers are placeholders, and so are units behind a number. Punctuation is left
out, so decorated copies have the same template. Every window of ``WINDOW`` tokens with enough literal
ones is hashed; windows of documents and of benchmark items meet in a hash join.

A match counts with its shift (place in the document less place in the item). Within a shift, each slot
value of the item must always stand against the same value of the document: a re-parameterised question
keeps its slots consistent, a chance meeting of templates does not. A document is contaminated by an item
when consistent windows cover ``COVER`` of the item's windows in one of the forms.

Documents' windows are held against the item hashes in the scan, so only hits are shuffled; the hashes are
sent to tasks up to ``SENT_HASHES`` (32 MB). Beyond that, all windows go to the join.

Defined results: a null or empty text has no window; an item with fewer than ``WINDOW`` tokens has none
either and contaminates nothing. Rows that share an id are one document; null ids too. Equal items are all
reported. Empty tables give no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpipe.llm.tables import stored
from docpipe.llm.words import by_size, cut_texts, mix, runs

WINDOW = 5
LITERALS = 3
COVER = 0.75
SENT_HASHES = 4_000_000
BROADCAST_IDS = 2_000_000
PIECE = 1 << 20

#: Unit words; they count as such directly behind a number.
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles",
    "mg", "g", "kg", "gram", "grams", "kilogram", "kilograms", "ton", "tons", "pound", "pounds", "ounce", "ounces",
    "ml", "cl", "l", "litre", "litres", "liter", "liters", "gallon", "gallons",
    "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours", "day", "days", "week",
    "weeks", "month", "months", "year", "years",
    "dollar", "dollars", "cent", "cents", "euro", "euros", "percent", "degree", "degrees", "mph", "kmh",
)

WORD, NAME, NUMBER, UNIT = range(4)
_SLOT = mix(np.arange(101, 105, dtype=np.uint64))


@lru_cache(1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Class of each code point (0 other, 1 letter, 2 capital, 3 digit) and the value of its small form."""
    kinds = {"Lu": 2, "Lt": 2, "Nd": 3}
    kind, small = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint64)
    for c in range(0x110000):
        category = unicodedata.category(chr(c))
        kind[c] = kinds.get(category, 1 if category[0] in "LM" else 0)
        if category in ("Lu", "Lt") and len(low := chr(c).lower()) == 1:
            small[c] = ord(low)
    return kind, mix(small * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))


_BASE = 0x9E3779B97F4A7C15


@lru_cache(4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    tables = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        table = np.full(size, base, np.uint64)
        table[0] = 1
        tables.append(np.multiply.accumulate(table))
    return tables[0], tables[1]


def _piece_tokens(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Literal hash and kind of every token of the pieces, and the bounds of each piece in them."""
    points = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
    ends_of = np.cumsum([len(p) for p in pieces]).astype(np.int64)
    bounds = np.concatenate([[0], ends_of])
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(len(bounds), np.int64)
    kinds, values = _characters()
    kind = kinds[points]
    edge = np.zeros(len(points) + 1, bool)
    edge[bounds] = True
    digit = kind == 3
    inner = np.flatnonzero(((points == 46) | (points == 44)) & ~edge[:-1] & ~edge[1:])
    inner = inner[digit[inner - 1] & digit[inner + 1]]
    group = np.array([0, 1, 1, 2], np.uint8)[kind]
    group[inner] = 2
    inside = group > 0
    change = np.empty(len(group) + 1, bool)
    change[0] = change[-1] = True
    change[1:-1] = group[1:] != group[:-1]
    change |= edge
    starts = np.flatnonzero(inside & change[:-1])
    ends = np.flatnonzero(inside & change[1:]) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(len(bounds), np.int64)
    step = 1 << 18
    power, inverse = _powers(step)
    parts = np.where(inside, values[points], np.uint64(0))
    for a in range(0, len(points), step):
        parts[a:a + step] *= power[:len(parts[a:a + step])]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(parts, dtype=np.uint64)])
    first_block, last_block = starts // step, (ends - 1) // step
    hashes = (sums[ends] - sums[starts]) * inverse[starts % step]
    for i in np.flatnonzero(first_block != last_block):  # a token that spans blocks is summed by itself
        own = values[points[starts[i]:ends[i]]]
        hashes[i] = (own * _powers(len(own))[0]).sum(dtype=np.uint64)
    lengths = ends - starts
    hashes = mix(hashes + lengths.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    capitals = np.concatenate([[0], np.cumsum(kind == 2)])
    name = (kind[starts] == 2) & ((capitals[ends] - capitals[starts] < lengths) | (lengths == 1))
    number = group[starts] == 2
    out = np.where(number, NUMBER, np.where(name, NAME, WORD)).astype(np.uint8)
    return hashes, out, np.searchsorted(starts, bounds)


@lru_cache(1)
def _unit_hashes() -> np.ndarray:
    return np.sort(_piece_tokens([" ".join(UNITS)])[0])


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Literal hash and kind of every token of all texts, and the bounds of each text."""
    pieces, counts = cut_texts(texts, PIECE)
    found = [_piece_tokens(run) for run in runs(pieces)]
    hashes = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.uint64)
    kind = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.uint8)
    sizes = np.concatenate([np.diff(f[2]) for f in found]) if found else np.zeros(0, np.int64)
    of_piece = np.concatenate([[0], np.cumsum(sizes)])
    bounds = of_piece[np.concatenate([[0], np.cumsum(counts)])]
    behind = np.zeros(len(hashes), bool)
    behind[1:] = kind[:-1] == NUMBER
    behind[bounds[:-1][bounds[:-1] < len(hashes)]] = False
    maybe = np.flatnonzero(behind & (kind != NUMBER))
    kind[maybe[np.isin(hashes[maybe], _unit_hashes())]] = UNIT
    return hashes, kind, bounds


def _form(hashes: np.ndarray, kind: np.ndarray, bounds: np.ndarray, names: bool):
    """Template tokens of one form: template hash, value, whether literal, and the bounds of each text."""
    if not names:
        literal = (kind == WORD) | (kind == NAME)
        return np.where(literal, hashes, _SLOT[kind]), hashes, literal, bounds
    begins = np.ones(len(kind), bool)
    begins[1:] = ~((kind[1:] == NAME) & (kind[:-1] == NAME))
    begins[bounds[:-1][bounds[:-1] < len(kind)]] = True
    at = np.flatnonzero(begins)
    if not len(at):
        return hashes, hashes, np.zeros(0, bool), bounds
    # A stretch of names is one slot; its value is made of all its words, in order.
    place = (np.arange(len(kind)) - np.repeat(at, np.diff(np.append(at, len(kind))))).astype(np.uint64)
    value = np.add.reduceat(mix(hashes + place * np.uint64(_BASE)), at)
    literal = kind[at] == WORD
    return (np.where(literal, hashes[at], _SLOT[kind[at]]), np.where(literal, hashes[at], value), literal,
            np.searchsorted(at, bounds))


_FACTORS = mix(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)


def windows(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per form: form, row of the text, place and hash of each usable window, the token values and
    whether each is literal (all tokens of the form), and where each window's tokens begin."""
    hashes, kind, bounds = tokens(texts)
    for form in (0, 1):
        template, value, literal, cuts = _form(hashes, kind, bounds, form == 1)
        n = len(template) - WINDOW + 1
        if n <= 0:
            continue
        total = np.zeros(n, np.uint64)
        fixed = np.zeros(n, np.uint8)
        for i in range(WINDOW):
            total += template[i:i + n] * _FACTORS[i]
            fixed += literal[i:i + n]
        row = np.repeat(np.arange(len(texts)), np.diff(cuts))
        usable = np.flatnonzero((row[:n] == row[WINDOW - 1:]) & (fixed >= LITERALS))
        keys = mix(total[usable] + np.uint64(form + 1)).view(np.int64)
        yield form, row[usable], usable - cuts[row[usable]], keys, value, literal, usable


def _rows(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None, names: list[str]) -> Iterator[pa.RecordBatch]:
    """One row per window (of those wanted): owner, form, place, key, slots."""
    if wanted is not None:
        seen = np.zeros(1 << 22, bool)
        seen[wanted & ((1 << 22) - 1)] = True
    for whole in batches:
        for batch in by_size(whole, 1):
            owners = batch.column(0)
            for form, row, place, key, value, literal, at in windows([t or "" for t in batch.column(1).to_pylist()]):
                if wanted is not None:
                    hit = np.flatnonzero(seen[key & ((1 << 22) - 1)])
                    near = np.minimum(np.searchsorted(wanted, key[hit]), max(len(wanted) - 1, 0))
                    hit = hit[wanted[near] == key[hit]] if len(wanted) else hit[:0]
                    row, place, key, at = row[hit], place[hit], key[hit], at[hit]
                inside = at[:, None] + np.arange(WINDOW)
                slot = ~literal[inside]
                ends = np.concatenate([[0], np.cumsum(slot.sum(axis=1))]).astype(np.int32)
                slots = pa.ListArray.from_arrays(pa.array(ends), pa.array(value[inside][slot].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [owners.take(pa.array(row)), pa.array(np.full(len(row), form, np.int32)),
                     pa.array(place.astype(np.int64)), pa.array(key), slots],
                    names=names)


_NAMES = ["owner", "form", "place", "key", "slots"]
_SCHEMA = "owner long, form int, place long, key long, slots array<bigint>"


def matches(docs: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str,
            cover: float = COVER) -> DataFrame:
    """(doc_id, item_id, coverage, shared windows, reparameterised) of contaminated documents."""
    context = docs.sparkSession.sparkContext
    asked = items.select(F.col(item_id).cast("long"), F.col(item_text))
    item_rows = stored(asked.mapInArrow(lambda b: _rows(b, None, _NAMES), _SCHEMA), "item-windows")
    if item_rows.count() <= SENT_HASHES:
        keys = item_rows.select("key").distinct().toArrow().column(0).to_numpy()
        shared = context.broadcast(np.sort(keys))

        def found(batches):
            return _rows(batches, shared.value, _NAMES)
    else:
        def found(batches):
            return _rows(batches, None, _NAMES)

    hits = docs.select(F.col(doc_id).cast("long"), F.col(doc_text)).mapInArrow(found, _SCHEMA).select(
        F.col("owner").alias("doc"), "key", F.col("place").alias("at"), F.col("slots").alias("theirs"))
    totals = item_rows.groupBy(F.col("owner").alias("of_item"), F.col("form").alias("of_form")).agg(
        F.countDistinct("place").alias("windows"))
    sides = item_rows.select(F.col("owner").alias("item"), "form", "place", "key", F.col("slots").alias("ours"))
    met = hits.join(sides, "key")
    pairs = F.arrays_zip("ours", "theirs")
    shifts = met.groupBy("doc", "item", "form", (F.col("at") - F.col("place")).alias("shift")).agg(
        F.collect_set("place").alias("places"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"))
    # One value of the document for each value of the item.
    shifts = shifts.where(F.size("pairs") == F.size(F.array_distinct(F.col("pairs.ours"))))
    changed = F.exists("pairs", lambda p: p["ours"] != p["theirs"])
    covered = shifts.select("doc", "item", "form", changed.alias("changed"), F.explode("places").alias("place"))
    covered = covered.groupBy("doc", "item", "form").agg(
        F.countDistinct("place").alias("shared"), F.max("changed").alias("changed"))
    same = F.col("item").eqNullSafe(F.col("of_item")) & (F.col("form") == F.col("of_form"))
    scored = covered.join(totals, same).select("doc", "item", "shared", "changed",
                                               (F.col("shared") / F.col("windows")).alias("coverage"))
    best = scored.where(F.col("coverage") >= cover).groupBy("doc", "item").agg(
        F.max("coverage").alias("coverage"), F.max("shared").alias("shared_windows"),
        F.min("changed").alias("reparameterised"))
    return best.withColumnsRenamed({"doc": doc_id, "item": item_id})


def clean(docs: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    found = matches(docs, doc_id, doc_text, items, item_id, item_text).select(F.col(doc_id).alias("leaked")).distinct()
    found = stored(found, "leaked")
    if found.count() <= BROADCAST_IDS:
        found = F.broadcast(found)
    return docs.join(found, docs[doc_id].eqNullSafe(found["leaked"]), "left_anti")
