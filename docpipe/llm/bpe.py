"""Byte-level BPE encoding and decoding over whole texts.

Pre-tokenisation uses no regular expression. Every code point has a class (letter, number, white space,
space, apostrophe, other), which with its neighbours gives a symbol; a symbol is a function between the
eight states of the splitting rule, and composing functions is associative. The functions of all
characters of a slice are composed by a blocked prefix scan over the (small) table of all their products,
so the state before each character, and with it every boundary, is found by a few look-ups a character.
Texts are scanned together; a first character's function forgets what came before it.

The slices go through a cache of merged pieces; those not in it are merged in lockstep, the lowest rank
and leftmost pair of every piece at a time. ``encode`` keeps the byte offset of every token, so that any
range of tokens can be cut from the text, and ``decode`` turns ids back into bytes.

Memory: slices of ``SLICE_BYTES``, a cache that starts anew past ``CACHE_PIECES`` pieces or
``CACHE_LONG_BYTES`` of long ones (some 40 MB), and pieces of ``SLICE_BYTES`` of longer texts.

Defined results: a null text is encoded as empty; an empty text has no ids. Null ids decode to empty
bytes. An id outside the vocabulary is an error. Text that spells a special token is ordinary text.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpipe.llm.tables import fresh
from docpipe.llm.words import by_size, cut_texts, runs

SLICE_BYTES = 1 << 19
CACHE_BITS = 20
CACHE_PIECES = 500_000
CACHE_LONG_BYTES = 8_000_000
LOCKSTEP_BYTES = 64
DECODE_TOKENS = 1 << 15
SCAN_BLOCK = 256
CLASS_BLOCK = 0x800

OTHER, LETTER, NUMBER, SPACE, BLANK, APOSTROPHE = range(6)
# What a character does: letter, number, other; the blank that joins the next word; a single white
# space that stands alone; white space inside a run; an apostrophe before one or two suffix letters.
L, N, O, JOIN, ALONE, RUN, SUFFIX1, SUFFIX2 = range(8)  # noqa: E741
# State after a character: inside a stretch of letters, numbers, others or white space; after a joining
# blank; a new piece must begin; one or two suffix letters left.
IN_L, IN_N, IN_O, IN_RUN, JOINED, FRESH, LEFT1, LEFT2 = range(8)
STATES = SYMBOLS = 8


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """State after the symbol, and whether a piece begins with it."""
    if state in (LEFT1, LEFT2):
        return (FRESH if state == LEFT1 else LEFT1), False
    plain = {L: IN_L, N: IN_N, O: IN_O, JOIN: JOINED, ALONE: FRESH, RUN: IN_RUN}
    if symbol in (SUFFIX1, SUFFIX2):
        if state in (JOINED, IN_O):
            return IN_O, False
        return (LEFT1 if symbol == SUFFIX1 else LEFT2), True
    after = plain[symbol]
    joins = state == JOINED and symbol in (L, N, O)
    goes_on = state == after and after in (IN_L, IN_N, IN_O, IN_RUN)
    return after, not (joins or goes_on)


@lru_cache(1)
def _scan_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All products of symbol functions: the function of each symbol (and of each symbol that begins a
    text), the product table, each function's states, and where pieces begin."""
    base = [tuple(_step(s, x)[0] for s in range(STATES)) for x in range(SYMBOLS)]
    base += [(f[FRESH],) * STATES for f in base]
    known = {f: i for i, f in enumerate(dict.fromkeys(base))}
    queue = list(known)
    for f in queue:
        for g in list(dict.fromkeys(base)):
            both = tuple(g[s] for s in f)
            if both not in known:
                known[both] = len(known)
                queue.append(both)
    functions = np.array(list(known), np.uint8)
    size = len(known)
    product = np.empty((size, size), np.uint16)
    for i, f in enumerate(known):
        product[i] = [known[tuple(g[s] for s in f)] for g in known]
    begins = np.array([[_step(s, x)[1] for x in range(SYMBOLS)] for s in range(STATES)])
    return np.array([known[f] for f in base], np.uint16), product, functions, begins


@lru_cache(1)
def _shifted_products() -> np.ndarray:
    """Products by (first << bits) + second, themselves shifted."""
    _, product, _, _ = _scan_tables()
    bits = product.shape[0].bit_length()
    table = np.zeros((product.shape[0], 1 << bits), np.int32)
    table[:, :product.shape[0]] = product.astype(np.int32) << bits
    return table.ravel()


def _prefix(functions: np.ndarray) -> np.ndarray:
    """Inclusive prefix products. Rows of the grid hold every block's j-th function; products are kept
    shifted, so that the next look-up is one addition away."""
    _, product, _, _ = _scan_tables()
    n, bits = len(functions), product.shape[0].bit_length()
    flat = _shifted_products()
    blocks = -(-n // SCAN_BLOCK)
    grid = np.zeros(blocks * SCAN_BLOCK, np.int32)
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(blocks, SCAN_BLOCK).T)
    grid[0] <<= bits
    for j in range(1, SCAN_BLOCK):
        np.add(grid[j], grid[j - 1], out=grid[j])
        grid[j] = flat.take(grid[j])
    if blocks > 1:
        before = _prefix(grid[-1][:-1] >> bits)
        grid[:, 1:] = flat.take((before.astype(np.int32) << bits) + (grid[:, 1:] >> bits))
    return (grid >> bits).T.ravel()[:n]


@lru_cache(1)
def _classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    # Block by block: every code point at once would take each worker some 120 MB for a moment.
    for start in range(0, len(table), CLASS_BLOCK):
        if 0xD800 <= start < 0xE000:
            continue
        every = "".join(map(chr, range(start, start + CLASS_BLOCK)))
        for pattern, name in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
            for found in regex.finditer(pattern, every):
                table[start + found.start():start + found.end()] = name
    # Not white space to the splitting rule, though this library's \s has them.
    table[0x1C:0x20] = OTHER
    table[ord(" ")], table[ord("'")] = BLANK, APOSTROPHE
    return table


#: What characters do by their class, context aside; an apostrophe is an ordinary sign.
_PLAIN = np.array([O, L, N, ALONE, JOIN, O], np.uint8)


def boundaries(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces begin in code points of joined texts; ``first`` marks each text's first one."""
    if not len(points):
        return np.zeros(0, np.int64)
    kind = _classes().take(points)
    end = np.empty(len(points), bool)
    end[:-1], end[-1] = first[1:], True
    space = (kind == SPACE) | (kind == BLANK)
    run = space & end
    run[:-1] |= space[:-1] & space[1:]
    symbol = _PLAIN.take(kind)
    symbol[run] = RUN
    quotes = np.flatnonzero((kind == APOSTROPHE) & ~end)
    if len(quotes):
        one = points[quotes + 1]
        symbol[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = SUFFIX1
        wide = quotes[~end[quotes + 1]]
        pair = points[wide + 1].astype(np.int64) << 32 | points[wide + 2]
        symbol[wide[np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]] = SUFFIX2
    of_symbol, _, states, begins = _scan_tables()
    done = _prefix(of_symbol.take(symbol + first * np.uint8(SYMBOLS)))
    before = np.empty(len(points), np.uint8)
    before[1:] = states[:, FRESH].take(done[:-1])
    before[first] = FRESH
    return np.flatnonzero(begins.ravel().take(before * np.uint8(SYMBOLS) + symbol))


class Table:
    """Numbers by 128-bit keys, looked up many at a time (open addressing). The second half of a key is
    never 0."""

    def __init__(self, bits: int):
        self.mask = (1 << bits) - 1
        self.first = np.zeros(1 << bits, np.uint64)
        self.second = np.zeros(1 << bits, np.uint64)
        self.number = np.zeros(1 << bits, np.int32)

    def _slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        h = (first ^ (second * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        return ((h ^ (h >> np.uint64(32))) & np.uint64(self.mask)).astype(np.int64)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for those not held."""
        slots = self._slots(first, second)
        held = self.second.take(slots)
        hit = (held == second) & (self.first.take(slots) == first)
        out = np.where(hit, self.number.take(slots), -1)
        rest = np.flatnonzero(~hit & (held != 0))
        while len(rest):
            slots[rest] = at = (slots[rest] + 1) & self.mask
            held = self.second[at]
            hit = (held == second[rest]) & (self.first[at] == first[rest])
            out[rest[hit]] = self.number[at[hit]]
            rest = rest[~hit & (held != 0)]
        return out

    def add(self, first: np.ndarray, second: np.ndarray, numbers: np.ndarray) -> None:
        """Distinct keys that are not held yet."""
        slots, rest = self._slots(first, second), np.arange(len(first))
        while len(rest):
            at = slots[rest]
            free = np.flatnonzero(self.second[at] == 0)
            _, one = np.unique(at[free], return_index=True)
            won = free[one]
            self.first[at[won]], self.second[at[won]] = first[rest[won]], second[rest[won]]
            self.number[at[won]] = numbers[rest[won]]
            rest = np.delete(rest, won)
            slots[rest] = (slots[rest] + 1) & self.mask


#: Pieces of up to 15 bytes are their own key: eight bytes, then seven with the length on top.
KEY_BYTES = 15
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _keys(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of short pieces; ``data`` has 16 bytes to spare behind its last piece."""
    eight = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))
    first = eight[starts] & _LOW_BYTES.take(np.minimum(sizes, 8))
    second = eight[starts + 8] & _LOW_BYTES.take(np.maximum(sizes - 8, 0))
    return first, second | sizes.astype(np.uint64) << np.uint64(56)


class Vocabulary:
    """Token bytes by id, with what encoding and decoding look up."""

    def __init__(self, tokens: dict[bytes, int]):
        self.ids = tokens
        self.size = max(tokens.values()) + 1
        by_id = [b""] * self.size
        for token, i in tokens.items():
            by_id[i] = token
        self.known = np.array([bool(t) for t in by_id])
        self.lengths = np.array([len(t) for t in by_id], np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        missing = [b for b in range(256) if bytes([b]) not in tokens]
        if missing:
            raise ValueError(f"the vocabulary has no token for the bytes {missing[:5]}")
        self.single = np.array([tokens[bytes([b])] for b in range(256)], np.int64)
        # Made by the first text to encode: a worker that only decodes does without them.
        self.count: np.ndarray | None = None

    @cached_property
    def pairs(self) -> dict[int, int]:
        """The token that two tokens merge to."""
        tokens, pairs = self.ids, {}
        for token, i in tokens.items():
            for cut in range(1, len(token)):
                left, right = tokens.get(token[:cut]), tokens.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        return pairs

    @cached_property
    def pair_table(self) -> Table:
        pairs = self.pairs
        keys = np.fromiter(pairs, np.uint64, len(pairs))
        table = Table(max(4, (4 * len(pairs)).bit_length()))
        table.add(keys, np.ones_like(keys), np.fromiter(pairs.values(), np.int32, len(pairs)))
        return table

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a file of lines ``base64 token, rank``."""
        with open(path, "rb") as lines:
            found = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in found})

    def __reduce__(self):
        return Vocabulary, (self.ids,)

    def _empty_cache(self) -> None:
        self.short = Table(CACHE_BITS)
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def merge_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32 | right).astype(np.uint64)
        found = self.pair_table.find(keys, np.ones_like(keys))
        return np.where(found >= 0, found, self.size)

    def _merge_long(self, piece: bytes) -> list[int]:
        """One long piece: a heap of mergeable pairs over a linked list."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self.pairs

        def ranked(i: int):
            j = after[i]
            if j < n and (rank := pairs.get(ids[i] << 32 | ids[j])) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        heap: list[tuple[int, int, int, int]] = []
        for i in range(n - 1):
            ranked(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            ranked(i)
            if before[i] >= 0:
                ranked(before[i])
        return [i for i in ids if i >= 0]

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece (none of them empty)."""
        out: list[list[int]] = [[]] * len(pieces)
        short = []
        for i, piece in enumerate(pieces):
            whole = self.ids.get(piece)
            if whole is not None:
                out[i] = [whole]
            elif len(piece) > LOCKSTEP_BYTES:
                out[i] = self._merge_long(piece)
            else:
                short.append(i)
        if short:
            sizes = np.array([len(pieces[i]) for i in short])
            ids, counts = self._lockstep(np.frombuffer(b"".join([pieces[i] for i in short]), np.uint8), sizes)
            ends = np.cumsum(counts)
            for i, a, b in zip(short, (ends - counts).tolist(), ends.tolist(), strict=True):
                out[i] = ids[a:b].tolist()
        return out

    def _lockstep(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces (their bytes in a row, none of them empty) in a row, and how many each has."""
        ids, owner = self.single[data], np.repeat(np.arange(len(sizes)), sizes)
        done_ids, done_owner = [ids[:0]], [owner[:0]]

        def ranked(at: np.ndarray) -> np.ndarray:
            """The rank of the pair that begins at each place; ``self.size`` if there is none."""
            found = self.merge_rank(ids[at], ids[np.minimum(at + 1, len(ids) - 1)])
            return np.where((at + 1 < len(ids)) & (owner[np.minimum(at + 1, len(ids) - 1)] == owner[at]),
                            found, self.size)

        rank = ranked(np.arange(len(ids)))
        while len(ids):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            width = np.diff(np.append(starts, len(ids)))
            low = np.minimum.reduceat(rank, starts)
            done = np.repeat(low == self.size, width)
            done_ids.append(ids[done])
            done_owner.append(owner[done])
            at = np.flatnonzero((rank == np.repeat(low, width)) & ~done)
            at = at[np.flatnonzero(np.diff(owner[at], prepend=-1))]
            ids[at] = rank[at]
            keep = ~done
            keep[at + 1] = False
            place = np.cumsum(keep)[at] - 1
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            # Only the pairs that a merged one is part of have changed.
            before = place[place > 0] - 1
            changed = np.concatenate([place, before[owner[before] == owner[before + 1]]])
            rank[changed] = ranked(changed)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(sizes))

    @cached_property
    def token_table(self) -> Table:
        """The id of every token that is its own key."""
        tokens = [t for t in self.ids if 0 < len(t) <= KEY_BYTES]
        lengths = np.array([len(t) for t in tokens], np.int64)
        table = Table(max(4, (2 * len(tokens)).bit_length()))
        table.add(*_keys(np.frombuffer(b"".join(tokens) + bytes(16), np.uint8), np.cumsum(lengths) - lengths, lengths),
                  np.array([self.ids[t] for t in tokens], np.int32))
        return table

    def _merge_keyed(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, first: np.ndarray,
                     second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that are their own keys, in a row, and how many each has."""
        whole = self.token_table.find(first, second).astype(np.int64)
        rest = np.flatnonzero(whole < 0)
        counts = np.ones(len(starts), np.int64)
        lengths = sizes[rest]
        ends = np.cumsum(lengths)
        places = np.repeat(starts[rest] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        ids, counts[rest] = self._lockstep(data[places], lengths)
        out = np.repeat(whole, counts)
        out[out < 0] = ids
        return out, counts

    def _hold(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Adds merged pieces to the cache; their numbers."""
        numbers = len(self.count) + np.arange(len(counts))
        self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(counts) - counts])
        self.count = np.concatenate([self.count, counts])
        self.pool = np.concatenate([self.pool, ids.astype(np.int32)])
        return numbers

    def _pieces(self, text: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The cache number of every piece of ``text``; pieces not held yet are merged first."""
        if self.count is None or len(self.count) > CACHE_PIECES or self.long_bytes > CACHE_LONG_BYTES:
            self._empty_cache()
        at = np.full(len(starts), -1, np.int64)
        data = np.frombuffer(text + bytes(16), np.uint8)
        short = np.flatnonzero(sizes <= KEY_BYTES)
        first, second = _keys(data, starts[short], sizes[short])
        at[short] = found = self.short.find(first, second)
        if len(missed := np.flatnonzero(found < 0)):
            # Equal keys side by side; should two keys share a hash, one may be held twice, with the same ids.
            missed = missed[np.argsort(first[missed] ^ second[missed] * np.uint64(0x9E3779B97F4A7C15))]
            a, b = first[missed], second[missed]
            new = np.ones(len(missed), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            one = short[missed[new]]
            numbers = self._hold(*self._merge_keyed(data, starts[one], sizes[one], a[new], b[new]))
            at[short[missed]] = numbers[np.cumsum(new) - 1]
            self.short.add(a[new], b[new], numbers.astype(np.int32))
        long = np.flatnonzero(sizes > KEY_BYTES)
        names = [text[a:a + n] for a, n in zip(starts[long].tolist(), sizes[long].tolist(), strict=True)]
        at[long] = np.fromiter(map(self.long.get, names, repeat(-1)), np.int64, len(names))
        new = [name for name in dict.fromkeys(names) if name not in self.long]
        if new:
            merged = self.merge(new)
            numbers = self._hold(np.array([i for m in merged for i in m], np.int64), np.array([len(m) for m in merged]))
            self.long.update(zip(new, numbers.tolist(), strict=True))
            self.long_bytes += sum(map(len, new))
            at[long] = np.fromiter(map(self.long.get, names), np.int64, len(names))
        return at

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the bounds of each text in them. A piece always begins at a
        blank behind a word, so long texts are cut there."""
        pieces, counts = cut_texts(texts, SLICE_BYTES)
        found = [self._encode(run) for run in runs(pieces, SLICE_BYTES)]
        ids = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int32)
        sizes = np.concatenate([np.diff(f[1]) for f in found]) if found else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        first = np.zeros(len(points), bool)
        first[bounds[:-1][bounds[:-1] < len(points)]] = True
        starts = boundaries(points, first)
        wide = np.ones(len(points), np.uint8)
        for least in (0x80, 0x800, 0x10000):
            wide += points >= least
        places = np.zeros(len(points) + 1, np.int64)
        np.cumsum(wide, out=places[1:])
        cuts = places[np.append(starts, len(points))]
        text = joined.encode()
        at = self._pieces(text, cuts[:-1], np.diff(cuts))
        counts = self.count[at]
        ends_of = np.cumsum(counts)
        total = int(ends_of[-1]) if len(ends_of) else 0
        ids = self.pool[np.repeat(self.first[at] - (ends_of - counts), counts) + np.arange(total)]
        before = np.concatenate([[0], ends_of])
        return ids, before[np.searchsorted(starts, bounds)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in a row, and the bounds of each id in them."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        ends = np.cumsum(self.lengths[ids])
        # A place is kept for every byte of a stretch, eight times its size.
        out = [np.zeros(0, np.uint8)]
        for start in range(0, len(ids), DECODE_TOKENS):
            some = ids[start:start + DECODE_TOKENS]
            lengths = self.lengths[some]
            stops = np.cumsum(lengths)
            out.append(self.bytes[np.repeat(self.places[some] - (stops - lengths), lengths) + np.arange(stops[-1])])
        return np.concatenate(out), np.concatenate([[0], ends])


def encode(df: DataFrame, text: str, path: str, keep: list[str] | None = None, ids: str = "ids",
           offsets: str = "offsets") -> DataFrame:
    """``df`` (or its columns ``keep``) with token ids and the byte offset of each token in the text."""
    kept = df.columns if keep is None else keep
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.read(path))  # the size of the file
    source, = fresh(df, "text_to_encode")
    empty = F.array().cast("array<int>")
    schema = df.select(*kept, empty.alias(ids), empty.alias(offsets)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for whole in batches:
            for batch in by_size(whole, len(kept), SLICE_BYTES):
                found, bounds = vocabulary.encode([t or "" for t in batch.column(len(kept)).to_pylist()])
                lengths = vocabulary.lengths[found]
                ends = np.concatenate([[0], np.cumsum(lengths)])
                own = ends[:-1] - np.repeat(ends[bounds[:-1]], np.diff(bounds))
                lists = [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(v.astype(np.int32)))
                         for v in (found, own)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(len(kept))), *lists], names=[*kept, ids, offsets])

    return df.select(*[df[c] for c in kept], F.col(text).alias(source)).mapInArrow(run, schema)


def decode(df: DataFrame, ids: str, path: str, keep: list[str] | None = None, decoded: str = "decoded") -> DataFrame:
    """``df`` (or its columns ``keep``) with the bytes that the ids stand for."""
    kept = df.columns if keep is None else keep
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.read(path))
    # Ids that are kept are sent to Python once.
    source = ids if ids in kept else fresh(df, "ids_to_decode")[0]
    sent = [df[c] for c in kept] + ([] if source in kept else [F.col(ids).alias(source)])
    at = [*kept, source].index(source)
    schema = df.select(*kept, F.lit(b"").alias(decoded)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                lists = batch.column(at)
                sizes = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                found, ends = vocabulary.decode(flat.astype(np.int64))
                cuts = ends[np.concatenate([[0], np.cumsum(sizes)])].tolist()
                data = found.tobytes()
                column = pa.array([data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(len(kept))), column], names=[*kept, decoded])

    return df.select(*sent).mapInArrow(run, schema)
