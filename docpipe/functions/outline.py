"""The one place where HTML is read outside the JVM: each page becomes a flat token array.

A token is an element opening, an element closing or a run of text, in document order. An opening
carries ``stop``, the position just past its element, so an element is the interval [pos, stop) and
everything after this step - content choice, pruning, links, Markdown - is array work in Spark.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

OPEN, CLOSE, TEXT = "open", "close", "text"

# Elements without content in HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
# Attributes the page operators look at.
ATTRIBUTES = ("class", "id", "role", "href", "title", "src", "alt")

ABSENT = (None,) * len(ATTRIBUTES)

FIELDS = [
    ("stop", pa.int32()), ("kind", pa.string()), ("tag", pa.string()), ("text", pa.string()),
    *((name, pa.string()) for name in ATTRIBUTES),
    ("nest", pa.int32()),       # lists around this token
    ("number", pa.int32()),     # li: place in its ordered list, 0 in an unordered one; cell: place in row
    ("cells", pa.int32()),      # closing of a table's first row: its number of cells
    ("verbatim", pa.bool_()),   # inside pre
]
TOKEN_DDL = (
    "array<struct<stop:int,kind:string,tag:string,text:string,"
    + ",".join(f"{name}:string" for name in ATTRIBUTES)
    + ",nest:int,number:int,cells:int,verbatim:boolean>>"
)
# Output batches are cut at about this much markup or this many tokens, whatever the size of the input
# batch: until then the tokens are Python objects, some ten times the size of their markup.
BATCH_CHARS = 1 << 18
BATCH_TOKENS = 1 << 14


class _Outline(HTMLParser):
    """Nesting as written: an end tag closes up to the nearest open element of that name, a stray
    end tag is ignored, and elements still open at the end close there."""

    def __init__(self, rows: list[tuple], stops: list[int]):
        super().__init__(convert_charrefs=True)
        self.tokens, self.stops = rows, stops   # shared by the pages of a batch
        self.first = len(stops)
        self.stack: list[tuple[int, str, tuple]] = []
        self.names: Counter[str] = Counter()
        self.lists: list[list] = []
        self.tables: list[list[int]] = []       # per open table: rows closed, cells in this row

    def add(self, kind, tag=None, text=None, attrs=ABSENT, number=0, cells=0) -> int:
        at = len(self.stops)
        self.tokens.append((kind, tag, text, *attrs, len(self.lists), number, cells,
                            self.names["pre"] > 0))
        self.stops.append(at - self.first + 1)
        return at

    def handle_starttag(self, tag, attrs):
        number = 0
        if tag in ("ul", "ol"):
            start = dict(attrs).get("start") if tag == "ol" and attrs else None
            begins = bool(start) and start.strip().isascii() and start.strip().isdigit() and len(start) < 10
            self.lists.append([tag, int(start) - 1 if begins else 0])
        elif tag == "li" and self.lists and self.lists[-1][0] == "ol":
            self.lists[-1][1] += 1
            number = self.lists[-1][1]
        elif tag == "table":
            self.tables.append([0, 0])
        elif tag in ("td", "th") and self.tables:
            self.tables[-1][1] += 1
            number = self.tables[-1][1]
        kept = ABSENT
        if attrs:
            found = dict(attrs)
            kept = tuple((found[n] or "") if n in found else None for n in ATTRIBUTES)
        at = self.add(OPEN, tag, attrs=kept, number=number)
        if tag not in VOID:
            self.stack.append((at, tag, kept))
            self.names[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.close_top()

    def handle_endtag(self, tag):
        if self.names[tag]:
            while self.close_top() != tag:
                pass

    def handle_data(self, data):
        self.add(TEXT, text=data)

    def close_top(self) -> str:
        at, tag, attrs = self.stack.pop()
        self.names[tag] -= 1
        cells = 0
        if tag in ("tr", "table") and self.tables:
            row = self.tables[-1]
            if tag == "table":
                self.tables.pop()
            else:
                cells = row[1] if row[0] == 0 else 0
                row[:] = [row[0] + 1, 0]
        closing = self.add(CLOSE, tag, attrs=attrs, cells=cells)
        if tag in ("ul", "ol") and self.lists:
            self.lists.pop()
        self.stops[at] = closing - self.first + 1
        return tag

    def finish(self):
        self.close()
        while self.stack:
            self.close_top()


def _outline_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(batch: pa.RecordBatch, start: int, ends: list[int], rows, stops) -> pa.RecordBatch:
        columns = [stops, *(zip(*rows) if rows else [()] * (len(FIELDS) - 1))]
        tokens = pa.ListArray.from_arrays(
            pa.array([0, *ends], pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array(column, kind) for column, (_, kind) in zip(columns, FIELDS)],
                fields=[pa.field(name, kind) for name, kind in FIELDS],
            ),
        )
        kept = batch.slice(start, len(ends)).drop_columns(["html"])
        return pa.RecordBatch.from_arrays(
            [*kept.columns, tokens], names=[*kept.schema.names, "tokens"])

    for batch in batches:
        start, size, ends, rows, stops = 0, 0, [], [], []
        for i, html in enumerate(batch.column("html")):
            markup = html.as_py()
            parser = _Outline(rows, stops)
            parser.feed(markup)
            parser.finish()
            ends.append(len(stops))
            size += len(markup)
            if size >= BATCH_CHARS or len(stops) >= BATCH_TOKENS:
                yield flush(batch, start, ends, rows, stops)
                start, size, ends, rows, stops = i + 1, 0, [], [], []
        if ends:
            yield flush(batch, start, ends, rows, stops)
        # What Arrow holds for reuse goes back to the system with the batch.
        pa.default_memory_pool().release_unused()


def outline(pages: DataFrame) -> DataFrame:
    """Replaces ``html`` by ``tokens``; pages without html must be filtered before."""
    kept = [f for f in pages.schema.fields if f.name != "html"]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return pages.mapInArrow(_outline_batches, f"{ddl}, tokens {TOKEN_DDL}")
