"""Roles and turns of chat transcripts by a hidden Markov model.

A state is a role together with "begins a turn" or "goes on". Each line is seen through its speaker marker
(``User:``, ``### Assistant``, ``Q:``, a name and a colon, none), its length, its last sign and how it
begins; the features are independent given the state. Counts come from labelled transcripts, and Viterbi
finds the most likely states. Turns are then rendered in one form: ``<|role|>`` and a line break, then the
lines without their marker, up to the next such tag.

Transcripts are range-partitioned and sorted by transcript and order, and cut into blocks of about
``BLOCK`` lines, so one transcript may be spread over any number of tasks. Max-plus products are
associative: each piece of a transcript that another block continues is first reduced to the best score
between any two states, these small matrices are chained per transcript, which fixes the states at every
cut, and then each block is decoded by itself.

Defined results: a row's role is that of its first line; null or empty text is one empty line. Rows of one
transcript with equal order are taken in the order of their text's hash. A null transcript id is a
transcript of its own; null orders come first. Ties go to the first state in the order of role names.
Without labelled rows there are no roles and nothing is returned. Fitting counts line to line within a
block, so it passes over one step in a block.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpipe.llm.tables import stored

BLOCK = 4096
ROLES = 16
MARKERS = {
    "user": 1, "human": 1, "question": 1, "q": 1, "me": 1, "you": 1, "prompter": 1, "customer": 1,
    "assistant": 2, "ai": 2, "bot": 2, "answer": 2, "a": 2, "model": 2, "agent": 2, "response": 2,
    "system": 3, "instruction": 3, "instructions": 3, "context": 3,
}
MARKER = re.compile(r"^\s*(?:#{1,4}\s*|\*\*|<\|?|\[)?([A-Za-z]{1,20})(?:\s?\d{0,2})(?:\*\*\s*:|:\s*\*\*|\|?>|\]\s*:?|\s*:)\s*")
FEATURES = 4
VALUES = 8  # of a feature, at most


def features(line: str) -> tuple[int, int, int, int]:
    """Marker class, length class, last sign, beginning."""
    found = MARKER.match(line)
    marker = MARKERS.get(found[1].lower(), 4) if found else 0
    size = len(line)
    length = 0 if not size else 1 + sum(size >= s for s in (20, 60, 120, 200, 400))
    last = line.rstrip()[-1:]
    end = {"": 0, "?": 1, ".": 2, "!": 3, ":": 4, ",": 5}.get(last, 6)
    first = line[:1]
    begin = (0 if not first else 1 if first in "-*•>" else 2 if first in "`{}#<[" else 3 if first.isspace()
             else 4 if first.isdigit() else 5 if first.isupper() else 6)
    return marker, length, end, begin


@dataclass
class Model:
    """Log probabilities; state ``2 * role + (line goes on)``."""

    roles: list[str]
    start: np.ndarray
    step: np.ndarray
    emission: np.ndarray  # features, values, states

    def seen(self, lines: list[str]) -> np.ndarray:
        table = np.array([features(line) for line in lines], np.int64).reshape(-1, FEATURES)
        return sum(self.emission[i][table[:, i]] for i in range(FEATURES))


def _lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


def _blocks(size: int):
    """Numbers the rows of a sorted partition and gives every ``size`` lines a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        place = lines = 0
        for batch in batches:
            blocks, places = [], []
            for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                blocks.append(base + lines // size)
                places.append(base + place)
                place += 1
                lines += (text or "").count("\n") + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(blocks, pa.int64()), pa.array(places, pa.int64())],
                names=[*batch.schema.names, "block", "place"])

    return run


def ordered(df: DataFrame, conv: str, order: str, text: str, role: str | None = None) -> DataFrame:
    """(conv, ord, text, role, block, place) sorted by transcript and order, in blocks."""
    rows = df.select(
        F.col(conv).cast("long").alias("conv"), F.col(order).cast("long").alias("ord"), F.col(text).alias("text"),
        (F.col(role) if role else F.lit(None)).cast("string").alias("role"))
    keys = ["conv", "ord", F.xxhash64("text")]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = "conv long, ord long, text string, role string, block long, place long"
    return stored(rows.mapInArrow(_blocks(BLOCK), schema), "transcript-blocks")


def _count(roles: list[str]):
    number = {role: i for i, role in enumerate(roles)}

    def run(block: pd.DataFrame) -> pd.DataFrame:
        counts: Counter = Counter()
        before, before_conv = None, None
        for row in block.sort_values("place").itertuples():
            conv = None if pd.isna(row.conv) else row.conv
            if row.role not in number:
                before = None
                continue
            for i, line in enumerate(_lines(row.text)):
                state = 2 * number[row.role] + (i > 0)
                for kind, value in enumerate(features(line)):
                    counts["seen", kind, value, state] += 1
                if before is not None and (i or conv == before_conv):
                    counts["step", 0, before, state] += 1
                elif before is not None:
                    counts["start", 0, 0, state] += 1
                before, before_conv = state, conv
        rows = [(*key, n) for key, n in counts.items()]
        return pd.DataFrame(rows, columns=["kind", "feature", "a", "state", "n"])

    return run


def fit(blocks: DataFrame) -> Model:
    """Smoothed counts of the labelled rows of ``ordered``; the most frequent ``ROLES`` labels are roles."""
    named = blocks.where("role is not null")
    most = named.groupBy("role").count().orderBy(F.desc("count"), "role").limit(ROLES).collect()
    roles = sorted(row["role"] for row in most)
    counts = named.groupBy("block").applyInPandas(
        _count(roles), "kind string, feature int, a int, state int, n long")
    states = 2 * len(roles)
    start, step = np.ones(states), np.full((states, states), 0.1)
    emission = np.ones((FEATURES, VALUES, states))
    # At most (features * values + states + 1) * states rows.
    for row in counts.groupBy("kind", "feature", "a", "state").agg(F.sum("n").alias("n")).collect():
        if row["kind"] == "seen":
            emission[row["feature"], row["a"], row["state"]] += row["n"]
        elif row["kind"] == "step":
            step[row["a"], row["state"]] += row["n"]
        else:
            start[row["state"]] += row["n"]
    start[1::2] = 1e-12  # a transcript begins with a turn
    for i in range(states):  # what goes on is the turn that is there
        step[i, [s for s in range(1, states, 2) if s // 2 != i // 2]] = 1e-12
    return Model(roles, np.log(start / start.sum()) if states else start,
                 np.log(step / step.sum(axis=1, keepdims=True)) if states else step,
                 np.log(emission / emission.sum(axis=1, keepdims=True)) if states else emission)


def reduced(seen: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best score from any state before the lines to any state at their end."""
    best = step + seen[0]
    for line in seen[1:]:
        best = (best[:, :, None] + step).max(axis=1) + line
    return best


def decoded(seen: np.ndarray, step: np.ndarray, entry: np.ndarray, last: int | None = None) -> list[int]:
    """Viterbi states of the lines; ``entry`` scores each state for the first line before it is seen."""
    score = entry + seen[0]
    back = np.zeros(seen.shape, np.int64)
    for i in range(1, len(seen)):
        ways = score[:, None] + step
        back[i] = ways.argmax(axis=0)
        score = ways.max(axis=0) + seen[i]
    state = int(score.argmax()) if last is None else last
    out = [state]
    for i in range(len(seen) - 1, 0, -1):
        state = int(back[i][state])
        out.append(state)
    return out[::-1]


def _pieces(block: pd.DataFrame) -> list[tuple[int | None, pd.DataFrame]]:
    """The stretches of one transcript each, in order."""
    block = block.sort_values("place")
    conv = block["conv"].astype("Int64")
    change = (conv != conv.shift()).fillna(True) & ~(conv.isna() & conv.shift().isna())
    change.iloc[0] = True
    return [(None if pd.isna(piece["conv"].iloc[0]) else int(piece["conv"].iloc[0]), piece)
            for _, piece in block.groupby(change.cumsum().to_numpy(), sort=False)]


def _edges(model: Model):
    """Of a block's first and last transcript: conv, block and the matrix of its lines here."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        pieces = _pieces(block)
        rows = []
        for conv, piece in [pieces[0], *pieces[1:][-1:]]:
            lines = [line for text in piece["text"] for line in _lines(text)]
            seen = model.seen(lines)
            first = (model.start + seen[0])[None].repeat(len(model.start), 0)
            for line in seen[1:]:
                first = (first[:, :, None] + model.step).max(axis=1) + line
            rows.append((conv, int(piece["block"].iloc[0]), reduced(seen, model.step).ravel(), first[0]))
        return pd.DataFrame(rows, columns=["conv", "block", "matrix", "opening"])

    return run


def _chain(model: Model):
    """The states at the cuts of one transcript: per block the state before its lines (-1: it begins here)
    and the state of its last line. One row per block comes in."""
    states = len(model.start)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        score, back = None, []
        for row in rows.itertuples():
            if score is None:
                score = np.array(row.opening)
                back.append(np.full(states, -1))
            else:
                ways = score[:, None] + np.array(row.matrix).reshape(states, states)
                back.append(ways.argmax(axis=0))
                score = ways.max(axis=0)
        state = int(score.argmax())
        out = []
        for before in back[::-1]:
            out.append((int(before[state]), state))
            state = int(before[state])
        conv = rows["conv"].iloc[0]
        return pd.DataFrame([(None if pd.isna(conv) else int(conv), block, *cut) for block, cut in
                             zip(rows["block"], out[::-1], strict=True)], columns=["conv", "block", "entry", "exit"])

    return run


def _decode(model: Model):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, piece in _pieces(block):
            texts = [_lines(text) for text in piece["text"]]
            seen = model.seen([line for lines in texts for line in lines])
            entry, last = model.start, None
            cut = piece.iloc[0]
            if not pd.isna(cut["exit"]):
                last = int(cut["exit"])
                if cut["entry"] >= 0:
                    entry = model.step[int(cut["entry"])]
            states = decoded(seen, model.step, entry, last)
            at = 0
            for row, lines in zip(piece.itertuples(), texts, strict=True):
                own = states[at:at + len(lines)]
                at += len(lines)
                parts = []
                for line, state in zip(lines, own, strict=True):
                    if state % 2 == 0:
                        found = MARKER.match(line)
                        stripped = line[found.end():] if found and features(line)[0] else line
                        parts.append(f"<|{model.roles[state // 2]}|>\n{stripped}")
                    else:
                        parts.append(line)
                rows.append((row.conv, row.ord, model.roles[own[0] // 2], own[0] % 2 == 0,
                             sum(s % 2 == 0 for s in own), "\n".join(parts)))
        out = pd.DataFrame(rows, columns=["conv", "ord", "role_pred", "begins_turn", "turns", "rendered"])
        return out.astype({"conv": "Int64", "ord": "Int64"})

    return run


def parse(blocks: DataFrame, model: Model) -> DataFrame:
    """(conv, ord, role_pred, begins_turn, turns, rendered) of every row of ``ordered``."""
    result = "conv long, ord long, role_pred string, begins_turn boolean, turns int, rendered string"
    if not model.roles:
        return blocks.sparkSession.createDataFrame([], result)
    rows = blocks.drop("role")
    edges = stored(rows.groupBy("block").applyInPandas(
        _edges(model), "conv long, block long, matrix array<double>, opening array<double>"), "transcript-edges")
    cuts = edges.groupBy("conv").applyInPandas(_chain(model), "conv long, block long, entry int, exit int")
    cuts = stored(cuts, "transcript-cuts").toDF("cut_conv", "cut_block", "entry", "exit")
    same = (rows["block"] == cuts["cut_block"]) & rows["conv"].eqNullSafe(cuts["cut_conv"])
    known = rows.join(cuts, same, "left").drop("cut_conv", "cut_block")
    return known.groupBy("block").applyInPandas(_decode(model), result)
