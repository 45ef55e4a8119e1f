import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docpipe.functions import text as t
from docpipe.operators import chunking


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "source_path string, text string")


def _chunks(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["source_path"], r["chunk_index"])):
        out.setdefault(r["source_path"], []).append(r)
    return out


def _greedy(text, limit):
    """Plain restatement of the recursive rule, piece by piece."""
    cuts = [r"(?<!#)(?=#)", r"(?<=\n\n)(?!\n)", r"(?<=\n)", r"(?<=[.!?] )", r"(?<=[ \t\r\n\f])"]

    def run(piece, level):
        if len(piece) <= limit:
            return [piece] if piece else []
        if level == len(cuts):
            return [piece[i:i + limit] for i in range(0, len(piece), limit)]
        merged = []
        for part in re.split(cuts[level], piece):
            if merged and len(merged[-1]) + len(part) <= limit:
                merged[-1] += part
            else:
                merged.append(part)
        return [c for m in merged for c in run(m, level + 1)]

    return run(text, 0)


def test_shape_of_a_real_document(spark):
    """Section and paragraph lengths of a saved chunking run, filled with text of our own: its nine
    chunks must come out."""
    sections = [[143], [1589], [166], [353], [26], [39, 270, 665, 666, 390, 393],
                [48, 409, 576, 98, 747, 458], [1899], [1977], [1267], [535], [12]]
    # The first section opens the document, every later one starts with a mark.
    text = "".join(
        ("#" + body if n else body)
        for n, parts in enumerate(sections)
        for body in ["".join("x" * (size - 2) + "\n\n" for size in parts)[1 if n else 0:]])
    assert len(text) == 12726
    chunks = _chunks(chunking.chunk_recursive(_docs(spark, [text])))["0"]
    assert [(c["start_index"], c["end_index"]) for c in chunks] == [
        (0, 1898), (1898, 2277), (2277, 4307), (4307, 4700), (4700, 6578), (6578, 7036),
        (7036, 8935), (8935, 10912), (10912, 12726)]
    assert "".join(c["text"] for c in chunks) == text
    assert all(c["token_count"] == len(c["text"]) for c in chunks)


def test_levels_by_hand(spark):
    texts = [
        "intro # one two\n# three",               # heading marks cut first, inside text too
        "[a](x#b) tail tail",                     # a mark inside a link also cuts
        "aaaa\n\nbbbb\n\ncccc cccc",              # blank lines
        "aaaa aa\nbbbb bb\ncccc",                 # lines
        "One. Two! Three? Four",                  # sentences
        "one two three four",                     # words
        "abcdefghijklmnopqrstuvwxyz",             # hard cut
        "",
    ]
    want = [
        ["intro ", "# one two\n", "# three"],
        ["[a](x", "#b) tail ", "tail"],
        ["aaaa\n\n", "bbbb\n\n", "cccc cccc"],
        ["aaaa aa\n", "bbbb bb\n", "cccc"],
        ["One. Two! ", "Three? ", "Four"],
        ["one two ", "three four"],
        ["abcdefghij", "klmnopqrst", "uvwxyz"],
        None,
    ]
    got = _chunks(chunking.chunk_recursive(_docs(spark, texts), limit=10))
    assert [
        [c["text"] for c in got[str(i)]] if str(i) in got else None for i in range(len(texts))
    ] == want


def test_null_text_has_no_chunks(spark):
    assert chunking.chunk_recursive(_docs(spark, [None])).count() == 0


def test_code_points_not_utf16_units(spark):
    text = "a\U0001F600" * 3000
    chunks = _chunks(chunking.chunk_recursive(_docs(spark, [text])))["0"]
    assert [len(c["text"]) for c in chunks] == [2048, 2048, 1904]
    assert "".join(c["text"] for c in chunks) == text


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="ab #\n.!é\U0001F600\t", max_size=200), min_size=20, max_size=60))
def test_lossless_bounded_contiguous(spark, texts):
    got = _chunks(chunking.chunk_recursive(_docs(spark, texts), limit=16))
    for i, text in enumerate(texts):
        chunks = got.get(str(i), [])
        assert [c["text"] for c in chunks] == _greedy(text, 16)
        assert "".join(c["text"] for c in chunks) == text
        at = 0
        for c in chunks:
            assert c["start_index"] == at and len(c["text"]) <= 16
            at = c["end_index"]
        assert at == len(text)


def test_token_windows(spark):
    texts = ["  a b  c\nd e f g", "one", " \n ", ""]
    got = _chunks(chunking.chunk_tokens(_docs(spark, texts), size=3, overlap=1))
    assert [(c["text"], c["start_index"], c["end_index"], c["token_count"]) for c in got["0"]] == [
        ("  a b  c\n", 0, 9, 3), ("c\nd e ", 7, 13, 3), ("e f g", 11, 16, 3)]
    assert [c["text"] for c in got["1"]] == ["one"]
    assert set(got) == {"0", "1"}


def test_token_windows_tile_the_text(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab \n") for _ in range(rng.randrange(200))) for _ in range(40)]
    got = _chunks(chunking.chunk_tokens(_docs(spark, texts), size=4))
    for i, text in enumerate(texts):
        assert "".join(c["text"] for c in got.get(str(i), [])) == (text if text.strip() else "")


def test_token_windows_with_a_vocabulary(spark):
    """A tokenizer of the user's, as a pandas UDF, fits in place of the default."""
    import pandas as pd

    @F.pandas_udf("array<string>")
    def letters(texts: pd.Series) -> pd.Series:
        return texts.map(list)

    docs = _docs(spark, ["abcdefg"])
    got = _chunks(chunking.chunk_tokens(docs, size=3, tokenizer=letters))
    assert [c["text"] for c in got["0"]] == ["abc", "def", "g"]


def test_sentences(spark):
    rows = chunking.split_sentences(_docs(spark, ["Hi. You?\nv1.2 is out! Bye"])).collect()
    assert [r["sentence"] for r in rows] == ["Hi. ", "You?\n", "v1.2 is out! ", "Bye"]
    assert [r["sentence_index"] for r in rows] == [0, 1, 2, 3]


def test_semantic_cuts_where_the_subject_changes(spark):
    text = "cats purr softly. cats purr loudly. tax law binds. tax law rules."
    got = _chunks(chunking.chunk_semantic(
        _docs(spark, [text]), min_tokens=1, max_tokens=20, threshold=0.5))["0"]
    assert [c["text"] for c in got] == [
        "cats purr softly. cats purr loudly. ", "tax law binds. tax law rules."]
    assert [len(c["sentences"]) for c in got] == [2, 2]
    assert [c["start_index"] for c in got] == [0, 36]


def test_semantic_bounds_hold(spark):
    rng = random.Random(3)
    words = ["red", "blue", "green", "tree", "sea"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", ". ", "\n"]) for _ in range(rng.randrange(120)))
             for _ in range(30)]
    got = _chunks(chunking.chunk_semantic(
        _docs(spark, texts), min_tokens=3, max_tokens=9, threshold=0.9))
    for i, text in enumerate(texts):
        chunks = got.get(str(i), [])
        assert "".join(c["text"] for c in chunks) == text
        for c in chunks:
            assert c["token_count"] == len(c["text"].split()) <= 9
            assert "".join(c["sentences"]) == c["text"]


def test_semantic_with_a_model(spark):
    import pandas as pd

    @F.pandas_udf("array<array<float>>")
    def by_first_letter(parts: pd.Series) -> pd.Series:
        return parts.map(lambda sentences: [
            [1.0, 0.0] if s[:1] == "a" else [0.0, 1.0] for s in sentences])

    got = _chunks(chunking.chunk_semantic(
        _docs(spark, ["ab c. ad e. fg h. ai j."]), 1, 50, 0.5, embed_sentences=by_first_letter))["0"]
    assert [c["text"] for c in got] == ["ab c. ad e. ", "fg h. ", "ai j."]


def test_reports(spark):
    docs = _docs(spark, ["one two three four five", "six"])
    chunks = chunking.chunk_recursive(docs, limit=10)
    assert {r["source_path"]: r["n_chunks"] for r in chunking.chunk_counts(chunks).collect()} == {
        "0": 3, "1": 1}
    assert chunking.corpus_totals(docs, chunks).first().asDict() == {
        "n_documents": 2, "n_chunks": 4}
    assert sorted(r["id"] for r in chunking.with_chunk_id(chunks).collect()) == [
        "0_0", "0_1", "0_2", "1_0"]
    report = {r["source_path"]: r for r in chunking.token_report(chunks).collect()}
    assert (report["0"]["min_tokens"], report["0"]["max_tokens"]) == (1, 2)


def test_token_count_column(spark):
    df = _docs(spark, ["a  b\nc", " "])
    assert [r[0] for r in df.select(t.token_count(F.col("text"))).collect()] == [3, 0]


def test_word_likeness_is_the_cosine_of_the_hashed_vectors(spark):
    from docpipe.functions import vectors as v

    df = spark.createDataFrame([(["a b a", "b c", "...", "c", "c d e c", "c d e c"],)], "s array<string>")
    dense = F.transform("s", lambda t: v.hashed_vector(t))
    row = df.select(
        F.transform(v.neighbour_word_cosine(F.col("s")), lambda x: F.round(x, 6)).alias("a"),
        F.transform(v.neighbour_cosine(dense), lambda x: F.round(x, 6)).alias("b")).first()
    assert row["a"] == row["b"] and row["a"][0] is None and row["a"][2] is None and row["a"][5] == 1.0


def test_offsets_of_many_chunks(spark):
    """More chunks than one run of the offset fold, and runs that end exactly on a chunk."""
    texts = ["word " * n for n in (511, 512, 513, 3000)]
    got = _chunks(chunking.chunk_recursive(_docs(spark, texts), limit=10))
    for i, text in enumerate(texts):
        assert len(got[str(i)]) == (len(text) + 9) // 10
        assert all(text[c["start_index"]:c["end_index"]] == c["text"] for c in got[str(i)])
        assert got[str(i)][-1]["end_index"] == len(text)


def test_likeness_is_asked_only_where_it_counts(spark):
    """Below the least size and over the largest one the answer is known; a fold keeps places, not texts."""
    parts = F.array(*[F.lit(f"a{i} b{i}. ") for i in range(600)])
    like = lambda at: F.when(at % 3 == 0, 0.0).otherwise(
        F.raise_error(F.concat(F.lit("asked at "), at.cast("string"))).cast("double"))
    grouped = t.group_sentences(parts, like, 6, 100, 0.5)
    got = spark.range(1).select(F.explode(grouped)).select("col.*").collect()
    assert [r.token_count for r in got] == [6] * 200
    assert "".join(r.text for r in got) == "".join(f"a{i} b{i}. " for i in range(600))
    never = lambda at: F.raise_error(F.lit("asked")).cast("double")
    full = spark.range(1).select(t.group_sentences(parts, never, 11, 10, 0.5).alias("g")).first().g
    assert [len(g.sentences) for g in full] == [5] * 120
    none = spark.range(1).select(
        t.group_sentences(F.array().cast("array<string>"), never, 1, 2, 0.5).alias("empty"),
        t.group_sentences(F.lit(None).cast("array<string>"), never, 1, 2, 0.5).alias("null")).first()
    assert none.empty == [] and none.null is None
