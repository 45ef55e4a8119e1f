"""Token array -> Markdown text, as one column expression.

Pieces carry control characters until the end, so that layout white space stays apart from the
page's own: \\x01 paragraph break, \\x02 line break, \\x03 a space that must stay, \\x04 a line
break inside preformatted text, \\x05 and \\x06 around a quotation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARA, LINE, SPACE, PRE_LINE, QUOTE, UNQUOTE = "\x01", "\x02", "\x03", "\x04", "\x05", "\x06"
INDENT = SPACE * 4

# Elements set off by blank lines, emphasis marks, elements without visible text.
BLOCKS = ("p", "div", "section", "article", "main", "body", "header", "footer", "table",
          "figure", "dl", "h1", "h2", "h3", "h4", "h5", "h6")
HEADINGS = {"h1": 1, "h2": 2, "h3": 3, "h4": 4, "h5": 5, "h6": 6}
MARKS = {"b": "**", "strong": "**", "em": "_", "i": "_", "del": "~~", "s": "~~", "strike": "~~"}
TYPED = ("code", "kbd", "samp", "tt")
SILENT = ("script", "style", "head")


def _opening(t: Column) -> Column:
    piece = F.when(t["tag"].isin(*HEADINGS), F.concat(
        F.lit(PARA), F.repeat(F.lit("#"), F.substring(t["tag"], 2, 1).cast("int")), F.lit(SPACE)))
    piece = piece.when(t["tag"].isin(*BLOCKS), F.lit(PARA))
    for tag, mark in MARKS.items():
        piece = piece.when(t["tag"] == tag, F.lit(mark))
    bullet = F.when(t["number"] > 0, F.concat(t["number"].cast("string"), F.lit("."))).otherwise("*")
    return (
        piece
        .when(t["tag"] == "br", F.lit(SPACE * 2 + LINE))
        .when(t["tag"].isin(*TYPED) & ~t["verbatim"], F.lit("`"))
        .when(t["tag"] == "blockquote", F.lit(PARA + QUOTE))
        .when((t["tag"] == "a") & t["href"].isNotNull(), F.lit("["))
        .when(t["tag"] == "img", F.concat(
            F.lit("!["), F.coalesce(t["alt"], F.lit("")),
            F.lit("]("), F.coalesce(t["src"], F.lit("")), F.lit(")")))
        .when(t["tag"].isin("ul", "ol"), F.when(t["nest"] > 1, "").otherwise(PARA))
        .when(t["tag"] == "li", F.concat(
            F.lit(LINE), F.repeat(F.lit(SPACE * 2), F.greatest(t["nest"], F.lit(1))),
            bullet, F.lit(SPACE)))
        .when(t["tag"] == "pre", F.lit(PARA + INDENT))
        .when(t["tag"].isin("td", "th") & (t["number"] > 1), F.lit(f"{SPACE}|{SPACE}"))
        .when(t["tag"].isin("tr", "dt", "dd"), F.lit(LINE))
        .when(t["tag"] == "hr", F.lit(f"{PARA}* * *{PARA}"))
        .otherwise("")
    )


def _closing(t: Column) -> Column:
    piece = F.when(t["tag"].isin(*BLOCKS, "pre"), F.lit(PARA))
    for tag, mark in MARKS.items():
        piece = piece.when(t["tag"] == tag, F.lit(mark))
    title = F.when(t["title"].isNotNull(), F.concat(F.lit(' "'), t["title"], F.lit('"')))
    return (
        piece
        .when(t["tag"].isin(*TYPED) & ~t["verbatim"], F.lit("`"))
        .when(t["tag"] == "blockquote", F.lit(UNQUOTE + PARA))
        .when((t["tag"] == "a") & t["href"].isNotNull(), F.concat(
            F.lit("]("), t["href"], F.coalesce(title, F.lit("")), F.lit(")")))
        .when(t["tag"].isin("ul", "ol"), F.when(t["nest"] > 1, LINE).otherwise(PARA))
        .when((t["tag"] == "tr") & (t["cells"] > 0), F.concat(
            F.lit(LINE), F.array_join(F.array_repeat(F.lit("---"), t["cells"]), "|"), F.lit(LINE)))
        .when(t["tag"] == "tr", F.lit(LINE))
        .otherwise("")
    )


def _text(t: Column) -> Column:
    clean = F.regexp_replace(t["text"], r"[\x00-\x08]", "")
    verbatim = F.regexp_replace(clean, r"\r\n?", "\n")
    verbatim = F.translate(verbatim, "\n ", PRE_LINE + SPACE)
    return F.when(t["verbatim"], verbatim).otherwise(F.regexp_replace(clean, r"[ \t\r\n\f]+", " "))


def _quoted(text: Column) -> Column:
    """Marks the lines of quotations; a quotation in another one ends it."""
    def part(piece: Column, i: Column) -> Column:
        halves = F.split(piece, UNQUOTE, 2)
        inside = F.regexp_replace(F.trim(F.get(halves, 0), F.lit(" \n")), "\n", "\n> ")
        after = F.coalesce(F.get(halves, 1), F.lit(""))
        return F.when(i == 0, piece).otherwise(F.concat(
            F.lit("> "), inside, F.replace(after, F.lit(UNQUOTE), F.lit(""))))

    marked = F.array_join(F.transform(F.split(text, QUOTE), part), "")
    return F.when(F.contains(text, F.lit(QUOTE)), marked).otherwise(text)


def to_markdown(tokens: Column) -> Column:
    pieces = F.transform(tokens, lambda t: (
        F.when(t["kind"] == "text", _text(t))
        .when(t["kind"] == "open", _opening(t))
        .otherwise(_closing(t))
    ))
    text = F.array_join(pieces, "")
    blank = rf"[ {LINE}{SPACE}{PRE_LINE}]*{PARA}[ {PARA}{LINE}{PRE_LINE}]*"
    text = F.regexp_replace(text, blank, "\n\n")
    text = F.regexp_replace(text, " {2,}", " ")
    text = F.regexp_replace(text, rf" *{LINE}[ {LINE}]*", "\n")
    text = _quoted(text)
    text = F.regexp_replace(text, r"^[ \n]+|[ \n]+$", "")
    text = F.regexp_replace(text, PRE_LINE, "\n" + INDENT)
    return F.translate(text, SPACE, " ")
