import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docpipe.llm import bpe
from tests.conftest import plan_of

ALPHABET = "ab s t'  \n\t\r1290é'rvelmd!?.,— 　\x1c\x85中文١Ⅷ'sS😀"


@pytest.fixture(scope="module")
def vocabulary(vocabulary_path):
    return bpe.Vocabulary.read(vocabulary_path)


def encoded(vocabulary, texts):
    ids, bounds = vocabulary.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def test_like_the_library(vocabulary, tokenizer):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", "a" * 500, " " * 900, "'s" * 100, "!" * 1000, "it's they're we've 'Street' ''s", " 's", "\n's don't"]
    assert encoded(vocabulary, texts) == [tokenizer.encode_ordinary(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(vocabulary, tokenizer, texts):
    assert encoded(vocabulary, texts) == [tokenizer.encode_ordinary(t) for t in texts]


def test_every_code_point_has_the_librarys_class(vocabulary, tokenizer):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 40_000):
        texts = [f"a{chr(c)}A 1{chr(c)}1 {chr(c)}A" for c in points[start:start + 40_000]]
        assert encoded(vocabulary, texts) == tokenizer.encode_ordinary_batch(texts, num_threads=4)


def test_long_texts_are_cut_without_effect(vocabulary, tokenizer, monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choice(ALPHABET + " word's ") for _ in range(5000))
    monkeypatch.setattr(bpe, "SLICE_BYTES", 64)
    assert encoded(vocabulary, ["x", text, ""]) == [tokenizer.encode_ordinary(t) for t in ("x", text, "")]


def test_full_cache_starts_anew(vocabulary_path, tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 20)
    small = bpe.Vocabulary.read(vocabulary_path)
    for i in range(5):
        texts = [f"word{i}x{j} another" for j in range(30)]
        assert encoded(small, texts) == [tokenizer.encode_ordinary(t) for t in texts]


def test_decode_refuses_unknown_ids(vocabulary):
    with pytest.raises(ValueError):
        vocabulary.decode(np.array([5, vocabulary.size + 3]))


def test_round_trip_in_spark(documents, vocabulary_path, tokenizer):
    rows = [(1, "Hello wörld's"), (2, ""), (3, None), (4, "<|endoftext|> x"), (5, "zu " * 50_000), (None, "n"), (1, "again")]
    done = bpe.encode(documents(rows), "text", vocabulary_path)
    done = bpe.decode(done, "ids", vocabulary_path)
    assert len(done.columns) == 13 + 3
    found = done.collect()
    assert len(found) == len(rows)
    for row in found:
        text = row["text"] or ""
        assert row["ids"] == tokenizer.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()
        data, at = text.encode(), row["offsets"] + [len(text.encode())]
        assert all(tokenizer.decode_single_token_bytes(i) == data[a:b]
                   for i, a, b in zip(row["ids"][:200], at, at[1:], strict=False))
        assert row["score"] == "mine"


def test_empty_and_null(spark, documents, vocabulary_path):
    assert bpe.encode(documents([]), "text", vocabulary_path).count() == 0
    ids = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert {bytes(r["decoded"]) for r in bpe.decode(ids, "ids", vocabulary_path).collect()} == {b""}


def test_decoding_needs_no_merge_tables():
    # Encoding and decoding run in workers of their own; only the first holds merges and merged pieces.
    tokens = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abab": 257}
    vocabulary = bpe.Vocabulary(tokens)
    ids = np.array([257, 256, 99] * (bpe.DECODE_TOKENS // 2))
    data, ends = vocabulary.decode(ids)
    assert data.tobytes() == b"abababc" * (bpe.DECODE_TOKENS // 2)
    assert len(ends) == len(ids) + 1 and ends[-1] == len(data)
    assert not {"pairs", "pair_table", "short", "pool"} & set(vars(vocabulary))
    found, bounds = vocabulary.encode(["ababab", "", "c"])
    assert found.tolist() == [257, 256, 99] and bounds.tolist() == [0, 2, 2, 3]


def test_classes_are_made_in_little_memory():
    tracemalloc.start()
    try:
        table = bpe._classes.__wrapped__()
        assert tracemalloc.get_traced_memory()[1] < 8_000_000
    finally:
        tracemalloc.stop()
    assert [table[ord(c)] for c in "aZé1 '\t\x1c.中😀\ud800"] == [
        bpe.LETTER, bpe.LETTER, bpe.LETTER, bpe.NUMBER, bpe.BLANK, bpe.APOSTROPHE, bpe.SPACE, bpe.OTHER,
        bpe.OTHER, bpe.LETTER, bpe.OTHER, bpe.OTHER]


def test_kept_ids_are_sent_once(spark, vocabulary_path, vocabulary):
    ids = vocabulary.encode(["two words"])[0].tolist()
    df = spark.createDataFrame([(1, ids), (2, None), (3, [])], "k long, ids array<int>")
    for keep in (["k", "ids"], ["ids", "k"], ["k"]):
        out = bpe.decode(df, "ids", vocabulary_path, keep=keep)
        assert out.columns == [*keep, "decoded"]
        assert ("ids_to_decode" in plan_of(out)) == ("ids" not in keep)
        got = {r["k"]: bytes(r["decoded"]) for r in out.collect()}
        assert got == {1: b"two words", 2: b"", 3: b""}


def test_workers_and_scans_hold_little(spark):
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "4m"
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "512"
    texts = spark.range(64).selectExpr("repeat('x', 1000000) AS text").coalesce(1)
    rows = texts.mapInArrow(lambda batches: (
        pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]}) for batch in batches), "bytes long").collect()
    assert max(r.bytes for r in rows) < 8_000_000


def test_new_short_pieces_are_merged_together(tokenizer, vocabulary_path, monkeypatch):
    # Pieces that are their own keys take no step in Python each; only longer ones are listed.
    rng = random.Random(11)
    words = ["".join(rng.choice("aeiouthnré") for _ in range(rng.randrange(1, 8))) for _ in range(2000)]
    texts = [" ".join(words[i:i + 50] + words[:7]) for i in range(0, 2000, 50)]
    vocabulary = bpe.Vocabulary.read(vocabulary_path)
    listed = []
    merge = vocabulary.merge
    monkeypatch.setattr(vocabulary, "merge", lambda pieces: listed.extend(pieces) or merge(pieces))
    ids, bounds = vocabulary.encode([*texts, " incomprehensibilities " * 3])
    wanted = [tokenizer.encode_ordinary(t) for t in [*texts, " incomprehensibilities " * 3]]
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == wanted
    assert sorted(set(listed)) == sorted(listed) and all(len(piece) > bpe.KEY_BYTES for piece in listed)
