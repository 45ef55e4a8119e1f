"""Words and word shingles of many texts at once, as 64-bit hashes (numpy over UTF-8 bytes).

A word is a stretch of bytes other than space and 0x09-0x0D; A-Z count as a-z. Work runs over slices of
about ``SLICE`` bytes that are cut between words, so memory does not grow with a text's length (a single
word longer than that is taken whole).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 18

_M = np.uint64
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all bits of ``x``."""
    x = x ^ (x >> _M(32))
    x = x * _M(0xD6E8FEB86659FD93)
    x = x ^ (x >> _M(32))
    x = x * _M(0xD6E8FEB86659FD93)
    return x ^ (x >> _M(32))


def unmix(x: np.ndarray) -> np.ndarray:
    """What ``mix`` made ``x`` of."""
    back = _M(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
    x = (x ^ (x >> _M(32))) * back
    x = (x ^ (x >> _M(32))) * back
    return x ^ (x >> _M(32))


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * _M(_BASE))
    values[65:91] = values[97:123]
    values[[32, *range(9, 14)]] = 0
    return values


_VALUES = _byte_values()
_IN_WORD = np.ones(256, bool)
_IN_WORD[[32, *range(9, 14)]] = False
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < size:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers[0][:size], _powers[1][:size]


def by_size(batch: pa.RecordBatch, column: int, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``size`` bytes in one column; one row at least. What Arrow holds for
    reuse goes back to the system with the batch."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    pa.default_memory_pool().release_unused()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; a null row is empty."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets.astype(np.int64)


def _cuts(data: np.ndarray, first: int, last: int) -> list[int]:
    """Slice bounds that do not part a word."""
    cuts = [first]
    while cuts[-1] + SLICE < last:
        at = cuts[-1] + SLICE
        while at < last and _IN_WORD[data[at]]:
            step = data[at:at + 4096]
            gap = np.flatnonzero(~_IN_WORD[step])
            at += int(gap[0]) if len(gap) else len(step)
        cuts.append(at)
    return [*cuts, last] if cuts[-1] < last else cuts


def word_hashes(data: np.ndarray, offsets: np.ndarray, places: bool = False):
    """Hash of every word of all rows, and the bounds of each row in them (rows + 1 values). With
    ``places`` also the byte place where each word starts and ends."""
    first, last = int(offsets[0]), int(offsets[-1])
    hashes, starts_of, ends_of = [], [], []
    cuts = _cuts(data, first, last)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        piece = data[a:b]
        inside = _IN_WORD[piece]
        edge = np.zeros(len(piece) + 1, bool)  # where a row begins
        edge[offsets[(offsets >= a) & (offsets <= b)] - a] = True
        before = np.concatenate([[False], inside[:-1]])
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        if not len(starts):
            continue
        after = np.concatenate([inside[1:], [False]])
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        power, inverse = _power_tables(len(piece))
        sums = np.add.reduceat(_VALUES[piece] * power, starts) * inverse[starts]
        hashes.append(mix(sums + (ends - starts).astype(np.uint64) * _M(0xA0761D6478BD642F)))
        starts_of.append(starts + a)
        ends_of.append(ends + a)
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    starts = np.concatenate(starts_of) if hashes else np.zeros(0, np.int64)
    bounds = np.searchsorted(starts, offsets)
    if places:
        return flat, bounds, starts, (np.concatenate(ends_of) if hashes else starts)
    return flat, bounds


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each row, with their bounds; a row with fewer words has
    its whole sequence as one, a row without words none. Repeats are kept."""
    rows = len(bounds) - 1
    lengths = np.diff(bounds)
    counts = np.where(lengths >= size, lengths - size + 1, (lengths > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(counts)])
    factors = mix(np.arange(1, size + 1, dtype=np.uint64) * _M(0xE7037ED1A0B428DB)) | _M(1)
    out = np.zeros(int(out_bounds[-1]), np.uint64)
    if not len(out):
        return out, out_bounds
    total = np.zeros(len(words), np.uint64)
    for i in range(min(size, len(words))):
        total[:len(words) - i] += words[i:] * factors[i]
    owner = np.repeat(np.arange(rows), counts)
    start = bounds[:-1][owner] + np.arange(len(out)) - out_bounds[:-1][owner]
    out = total[start] + _M(size)
    for row in np.flatnonzero((lengths > 0) & (lengths < size)):
        own = words[bounds[row]:bounds[row + 1]]
        out[out_bounds[row]] = (own * factors[:len(own)]).sum(dtype=np.uint64) + _M(len(own))
    return mix(out), out_bounds


_BLANK_AFTER_WORD = re.compile(r"(?<=\S)[ \n\t]")


def cut_texts(texts: list[str], size: int = 1 << 20) -> tuple[list[str], np.ndarray]:
    """Texts cut in front of the first blank after a word past every ``size`` characters, so that long
    ones are worked on in bounded pieces; with the number of pieces of each text."""
    pieces, counts = [], []
    for text in texts:
        start, before = 0, len(pieces)
        while len(text) - start > size and (found := _BLANK_AFTER_WORD.search(text, start + size)):
            pieces.append(text[start:found.start()])
            start = found.start()
        pieces.append(text[start:] if start else text)
        counts.append(len(pieces) - before)
    return pieces, np.array(counts, np.int64)


def runs(pieces: list[str], size: int = 1 << 20) -> Iterator[list[str]]:
    """Stretches of ``pieces`` with about ``size`` characters together; one piece at least."""
    start = total = 0
    for i, piece in enumerate(pieces):
        if i > start and total + len(piece) > size:
            yield pieces[start:i]
            start, total = i, 0
        total += len(piece)
    if start < len(pieces):
        yield pieces[start:]
