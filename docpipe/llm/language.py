"""Language identification by cross-parsing entropy.

For each language a suffix automaton of bounded labelled text is built. A text is parsed from left to
right into the longest phrases that occur in a language's training text; the entropy estimate is
``phrases * log2(training length) / text length``, and the language with the smallest one wins.

Training is the only bounded step: ``CHARS`` symbols a language, from the labelled rows with the
smallest row hash, of the ``LANGUAGES`` most frequent labels. Prediction parses every whole text. Texts run in lockstep: one table look-up takes a
step in every text and every language. Long texts are cut into ``BLOCK`` symbols that are parsed side by
side, which adds at most one phrase a block to every language alike.

Defined results: a null text, or one without a letter, is ``und`` with score 0. Ties go to the first
language name. The score is ``second / (best + second)`` of the two smallest estimates (0.5: a tie), 1
where a single language was learned. Letters that no language has count as phrases of their own. An
empty or unlabelled training table leaves nothing to choose from: every text is ``und``.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docpipe.llm.tables import fresh
from docpipe.llm.words import by_size, cut_texts, runs

CHARS = 24_000
ROWS = 400
LANGUAGES = 1000
BLOCK = 2048
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def _symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased letters with one blank for every stretch of other characters, texts joined;
    where each text ends; how many letters each has."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) for t in lowered])
    letter = _letters()[points]
    before = np.empty_like(letter)
    before[:1], before[1:] = False, letter[:-1]
    starts = np.concatenate([[0], ends])[:-1]
    before[starts[starts < len(points)]] = False  # no blank in front of a text
    keep = letter | before
    kept = np.concatenate([[0], np.cumsum(keep)])
    count = np.concatenate([[0], np.cumsum(letter)])
    bounds = np.concatenate([[0], ends])
    return np.where(letter, points, 32)[keep], kept[ends], np.diff(count[bounds])


def _automaton(text: np.ndarray) -> list[dict[int, int]]:
    """Suffix automaton of a symbol sequence: transitions by state, state 0 is the root."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in text.tolist():
        state = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and symbol not in moves[p]:
            moves[p][symbol] = state
            p = link[p]
        if p >= 0:
            q = moves[p][symbol]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(symbol) == q:
                    moves[p][symbol] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return moves


@dataclass
class Model:
    """Parsing tables of all languages. ``tables[i][state * width + class]`` is the next state's row
    times four plus the phrases that the step ends."""

    names: list[str]
    points: np.ndarray  # code points that have a class, ascending; class 0 is any other
    tables: list[np.ndarray]
    log_size: list[float]

    @property
    def width(self) -> int:
        return len(self.points) + 1


def learn(samples: dict[str, list[str]], chars: int = CHARS) -> Model:
    """Builds the tables from labelled texts; at most ``chars`` symbols a language are used."""
    texts = {}
    for name in sorted(samples):
        symbols, _, _ = _symbols([" ".join(samples[name])])
        if len(symbols := symbols[:chars]):
            texts[name] = symbols
    points = np.unique(np.concatenate(list(texts.values()))) if texts else np.zeros(0, np.uint32)
    model = Model(list(texts), points, [], [])
    for symbols in texts.values():
        model.tables.append(_table(_automaton(np.searchsorted(points, symbols) + 1), model.width))
        model.log_size.append(math.log2(len(symbols) + 1))
    return model


def _table(moves: list[dict[int, int]], width: int) -> np.ndarray:
    """Every (state, class) step: a missing transition ends the phrase and starts anew at the root."""
    root = np.full(width, -1, np.int64)
    root[list(moves[0])] = list(moves[0].values())
    fallback = np.where(root >= 0, root * width * 4 + 1, 2)  # a class unknown at the root is a phrase
    table = np.tile(fallback, (len(moves), 1))
    for state, out in enumerate(moves):
        table[state, list(out)] = np.fromiter(out.values(), np.int64, len(out)) * width * 4
    table[0] = np.where(root >= 0, root * width * 4, 1)
    return table.astype(np.int32 if len(moves) * width * 4 + 4 < 1 << 31 else np.int64).ravel()


def phrases(model: Model, classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Phrases of each stretch of ``classes`` in each language: shape (stretches, languages)."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    out = np.zeros((len(sizes), len(model.tables)), np.int64)
    active = np.searchsorted(-sizes, -np.arange(int(sizes.max(initial=0))), side="left")
    for i, table in enumerate(model.tables):
        state = np.zeros(len(sizes), table.dtype)
        count = np.zeros(len(sizes), np.int32)
        for step, n in enumerate(active.tolist()):
            value = table.take(state[:n] + classes.take(starts[:n] + step))
            count[:n] += value & 3
            np.right_shift(value, 2, out=state[:n])
        out[order, i] = count + (state > 0)
    return out


def _parse(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of each text in each language, and its number of letters."""
    symbols, ends, letters = _symbols(texts)
    total = np.zeros((len(texts), len(model.names)), np.int64)
    if not len(symbols) or not model.names:
        return total, letters
    starts = np.concatenate([[0], ends])[:-1]
    sizes = ends - starts
    at = np.searchsorted(model.points, symbols)
    known = model.points[np.minimum(at, len(model.points) - 1)] == symbols
    classes = np.where(known, at + 1, 0).astype(np.int32)
    blocks = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(texts)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    first = starts[owner] + nth * BLOCK
    np.add.at(total, owner, phrases(model, classes, first, np.minimum(ends[owner] - first, BLOCK)))
    return total, letters


def predict(model: Model, texts: list[str]) -> tuple[list[str], list[float]]:
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not texts or not model.names:
        return names, scores
    pieces, counts = cut_texts(texts)
    parsed = [_parse(model, run) for run in runs(pieces)]
    firsts = np.cumsum(counts) - counts
    estimate = np.add.reduceat(np.concatenate([p[0] for p in parsed]), firsts) * np.array(model.log_size)
    letters = np.add.reduceat(np.concatenate([p[1] for p in parsed]), firsts)
    best = estimate.argmin(axis=1)
    for i in np.flatnonzero(letters > 0).tolist():
        names[i] = model.names[best[i]]
        if len(model.names) == 1:
            scores[i] = 1.0
        else:
            low, next_low = np.partition(estimate[i], 1)[:2]
            scores[i] = float(next_low / (low + next_low))
    return names, scores


def training_rows(labelled: DataFrame, row_id: str, text: str, lang: str, rows: int = ROWS) -> DataFrame:
    """(lang, text) of at most ``rows`` labelled rows a language, those with the smallest row hash.
    A counting pass first thins the rows, so that about twice as many are ranked however many there are."""
    found = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    found = found.select(F.col(row_id).alias("row"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = found.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    share = (F.lit(2.0 * rows) + 20) / F.col("n")
    # At most LANGUAGES rows.
    drawn = found.withColumn("draw", F.xxhash64(F.lit(17), F.col("row").cast("string"))).join(
        F.broadcast(counts), "lang")
    drawn = drawn.where((F.col("draw").bitwiseAND(0x7FFFFFFF) / float(1 << 31)) < share)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(
        F.col("draw").bitwiseAND(0x7FFFFFFF), "draw", F.xxhash64("text")))
    return drawn.withColumn("nth", nth).where(F.col("nth") <= rows).select("lang", "text", "nth")


def fit(labelled: DataFrame, row_id: str, text: str, lang: str, chars: int = CHARS,
        rows: int = ROWS) -> Model:
    """Learns from the bounded sample; at most ``rows`` texts, cut at ``chars``, a language reach the
    driver."""
    sample = training_rows(labelled, row_id, text, lang, rows)
    sample = sample.select("lang", "nth", F.substring("text", 1, 2 * chars).alias("text"))
    before = F.sum(F.length("text")).over(
        Window.partitionBy("lang").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1))
    sample = sample.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < 2 * chars)
    texts: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", "nth").select("lang", "text").collect():
        texts.setdefault(row["lang"], []).append(row["text"])
    return learn(texts, chars)


def identify(df: DataFrame, text: str, model: Model, keep: list[str] | None = None,
             lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` (or its columns ``keep``) with the predicted language and its score added. Narrow: nothing
    is shuffled."""
    context = df.sparkSession.sparkContext
    shared = context.broadcast(model)  # languages * chars * alphabet, bounded by the fit
    kept = df.columns if keep is None else keep
    input_text, = fresh(df, "text_to_parse")
    schema = df.select(*kept, F.lit("").alias(lang_pred), F.lit(0.0).alias(score)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, len(kept)):
                texts = [t or "" for t in part.column(len(kept)).to_pylist()]
                names, scores = predict(shared.value, texts)
                arrays = [part.column(i) for i in range(len(kept))]
                arrays += [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, lang_pred, score])

    return df.select(*[df[c] for c in kept], F.col(text).alias(input_text)).mapInArrow(run, schema)



def keep_known(df: DataFrame, text: str, model: Model) -> DataFrame:
    """The rows of ``df`` whose language is recognised, with all their columns. With no language learned,
    those with a letter."""
    if not model.names:
        return df.where(F.col(text).rlike(r"\p{L}"))
    lang_pred, score = fresh(df, "lang_pred", "score")
    named = identify(df, text, model, lang_pred=lang_pred, score=score)
    return named.where(F.col(lang_pred) != UNKNOWN).select(*[named[c] for c in df.columns])
