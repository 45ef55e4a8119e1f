"""Chunk, token and sentence expressions. All are per-row, so none of them shuffles.

The greedy merge of a level is one regular expression: the longest run of at most ``limit``
characters that ends on a boundary, else the single piece up to the next boundary. That equals
appending pieces while the total stays within the limit, and scans the text once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from docpipe.functions.columns import let, struct_of

DEFAULT_LIMIT = 2048
RUN = 256

# Zero-width places where a level may cut, coarsest first, each with a string that a text must hold to
# have such a place (a search for it is far cheaper than the pattern). A run of # stays with the text
# after it, every other separator with the text before it.
MARKDOWN_LEVELS = (
    ("#", r"(?<!#)(?=#)"),              # heading marks
    ("\n\n", r"(?<=\n\n)(?!\n)"),       # blank lines
    ("\n", r"(?<=\n)"),                 # lines
    (" ", r"(?<=[.!?] )"),              # sentences
    ("", r"(?<=[ \t\r\n\f])"),          # words
)
SENTENCE_END = r"(?<=[.!?][ \t\r\n\f])"
TOKEN = r"\s*\S+\s*"


def split_at(text: Column, boundary: str) -> Column:
    """Cut at every boundary; the pieces concatenate to the text."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).+?(?:{boundary}|\z)"), F.lit(0))


def merge_up_to(text: Column, boundary: str, limit: int) -> Column:
    """Pieces of one level, neighbours merged while they fit ``limit`` characters."""
    pattern = rf"(?s).{{1,{limit}}}(?:{boundary}|\z)|.+?(?:{boundary}|\z)"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def recursive_chunks(
    text: Column, limit: int = DEFAULT_LIMIT, levels: Sequence[tuple[str, str]] = MARKDOWN_LEVELS
) -> Column:
    """Array of chunk texts: each level recuts only what is still over the limit."""
    def recut(chunks: Column, mark: str, cut) -> Column:
        return F.flatten(F.transform(chunks, lambda chunk: F.when(
            (F.char_length(chunk) > limit) & F.contains(chunk, F.lit(mark)), cut(chunk)
        ).otherwise(F.array(chunk))))

    chunks = F.array(F.coalesce(text, F.lit("")))
    for mark, boundary in levels:
        chunks = recut(chunks, mark, lambda chunk, at=boundary: merge_up_to(chunk, at, limit))
    chunks = recut(chunks, "", lambda chunk: F.regexp_extract_all(
        chunk, F.lit(rf"(?s).{{1,{limit}}}"), F.lit(0)))
    return F.filter(chunks, lambda chunk: chunk != "")


def with_offsets(chunks: Column) -> Column:
    """Contiguous chunk texts -> array of (text, start_index, end_index).

    Running lengths are folded within runs of chunks and once over the runs, because a fold that
    appends copies what it has: one fold over a very long document would be quadratic.
    """
    span = "array<struct<text:string,start_index:int,end_index:int>>"

    def add(state: Column, chunk: Column) -> Column:
        stop = state["at"] + F.char_length(chunk)
        return struct_of(
            at=stop,
            spans=F.concat(state["spans"], F.array(
                struct_of(text=chunk, start_index=state["at"], end_index=stop))),
        )

    def place(run: Column, at: Column) -> Column:
        start = struct_of(at=at, spans=F.array().cast(span))
        return F.aggregate(run, start, add, lambda state: state["spans"])

    def place_runs(runs: Column) -> Column:
        lengths = F.transform(runs, lambda run: F.aggregate(
            run, F.lit(0), lambda total, chunk: total + F.char_length(chunk)))
        starts = F.aggregate(lengths, F.array(F.lit(0)), lambda starts, length: F.concat(
            starts, F.array(F.element_at(starts, -1) + length)))
        return F.flatten(F.zip_with(runs, F.slice(starts, F.lit(1), F.size(runs)), place))

    def cut(chunks: Column) -> Column:
        first = F.sequence(F.lit(1), F.greatest(F.size(chunks), F.lit(1)), F.lit(RUN))
        runs = F.transform(first, lambda i: F.slice(chunks, i, F.lit(RUN)))
        return let(runs, place_runs)

    return let(chunks, cut)


def tokens(text: Column) -> Column:
    """Default tokenizer: words with the white space around them, nothing lost."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def token_windows(words: Column, size: int, overlap: int = 0) -> Column:
    """Token array -> array of (text, start_index, end_index, token_count)."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and smaller than the window")
    step = size - overlap

    def build(words: Column) -> Column:
        n = F.size(words)
        last = F.greatest(F.ceil((n - size) / F.lit(step)), F.lit(0)).cast("int")
        windows = F.sequence(F.lit(0), last)
        # Steps tile the text, so their running lengths are the window starts.
        tiles = with_offsets(F.transform(
            windows, lambda i: F.array_join(F.slice(words, i * step + 1, F.lit(step)), "")))

        def window(tile: Column, i: Column) -> Column:
            part = F.slice(words, i * step + 1, F.lit(size))
            return let(F.array_join(part, ""), lambda body: struct_of(
                text=body,
                start_index=tile["start_index"],
                end_index=tile["start_index"] + F.char_length(body),
                token_count=F.size(part),
            ))

        return F.when(n > 0, F.transform(tiles, window))

    return let(words, build)


def sentences(text: Column) -> Column:
    return split_at(text, SENTENCE_END)


def sentences_within(text: Column, max_tokens: int) -> Column:
    """Sentences, those over ``max_tokens`` cut into token windows."""
    return F.flatten(F.transform(sentences(text), lambda sentence: F.when(
        token_count(sentence) > max_tokens,
        F.transform(token_windows(tokens(sentence), max_tokens), lambda w: w["text"]),
    ).otherwise(F.array(sentence))))


def group_sentences(
    parts: Column, likeness: Callable[[Column], Column], min_tokens: int, max_tokens: int, threshold: float
) -> Column:
    """Greedy semantic grouping -> array of (text, token_count, sentences).

    ``likeness`` compares the sentence at a 0-based place with the one before it; it is asked only
    where the answer counts. A chunk closes when the next sentence would pass ``max_tokens``, or when
    it holds at least ``min_tokens`` and the next sentence is less like the one before it than
    ``threshold``. An unknown likeness never cuts.

    The fold keeps the places where chunks begin, no texts, and appends them run by run.
    """
    def begins(counts: Column) -> Column:
        def add(state: Column, at: Column) -> Column:
            return let(F.get(counts, at), lambda n: F.when(
                (at == 0) | (state["n"] + n > max_tokens)
                | ((state["n"] >= min_tokens)
                   & F.coalesce(F.round(likeness(at), 6) < threshold, F.lit(False))),
                struct_of(n=n, starts=F.concat(state["starts"], F.array(at))),
            ).otherwise(struct_of(n=state["n"] + n, starts=state["starts"])))

        def add_run(state: Column, first: Column) -> Column:
            last = F.least(first + (RUN - 1), F.size(counts) - 1)
            start = struct_of(n=state["n"], starts=F.array().cast("array<int>"))
            return let(F.aggregate(F.sequence(first, last), start, add), lambda run: struct_of(
                n=run["n"], starts=F.concat(state["starts"], run["starts"])))

        runs = F.sequence(F.lit(0), F.size(counts) - 1, F.lit(RUN))
        none = struct_of(n=F.lit(0), starts=F.array().cast("array<int>"))
        return F.aggregate(runs, none, add_run, lambda state: state["starts"])

    def group(parts: Column, counts: Column) -> Column:
        def chunk(at: Column, size: Column) -> Column:
            return struct_of(
                text=F.array_join(F.slice(parts, at + 1, size), ""),
                token_count=F.aggregate(F.slice(counts, at + 1, size), F.lit(0), lambda total, n: total + n),
                sentences=F.slice(parts, at + 1, size),
            )

        return let(begins(counts), lambda starts: F.transform(starts, lambda at, k: chunk(
            at, F.coalesce(F.get(starts, k + 1), F.size(parts)) - at)))

    chunks = "array<struct<text:string,token_count:int,sentences:array<string>>>"
    return let(parts, lambda parts: F.when(F.size(parts) == 0, F.array().cast(chunks)).when(
        parts.isNotNull(), let(F.transform(parts, token_count), lambda counts: group(parts, counts))))
