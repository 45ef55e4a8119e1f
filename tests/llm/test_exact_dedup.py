import hashlib
import random
from collections import defaultdict

from docpipe.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept = False
        for doc_id in ids:
            first = doc_id == keep and not kept
            kept = kept or first
            out.append((doc_id, keep, len(ids), first, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def marked(df):
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted((tuple(r[n] for n in names) for r in exact_dedup.mark(df, "doc_id", "text").collect()), key=repr)


def test_against_plain_python(documents):
    rng = random.Random(3)
    rows = [(i, "w" * rng.randint(0, 30)) for i in range(300)] + [(900 + i, f"own {i}") for i in range(200)]
    rows += [(7, "w"), (7, "w"), (None, "own 3"), (None, None), (5000, None), (5001, ""), (6000, "x" * 300_000)]
    assert marked(documents(rows)) == brute(rows)


def test_small_filter_changes_nothing(documents):
    rows = [(i, f"text {i % 1500}") for i in range(2000)]
    df = documents(rows)
    small = exact_dedup.mark(df, "doc_id", "text", filter_bytes=exact_dedup.SEGMENT_BITS // 8)
    assert small.where("kept").count() == 1500
    assert marked(df) == brute(rows)


def test_keeps_rows_and_columns(documents):
    rows = [(1, "a"), (2, "a"), (3, "b"), (3, "b"), (4, None), (5, ""), (None, "c"), (6, "d")]
    df = documents(rows)
    kept = exact_dedup.keep_one(df, "doc_id", "text")
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id is not null").collect()) == [
        (2, "a"), (3, "b"), (5, ""), (6, "d")]
    assert kept.where("doc_id is null").count() == 1
    assert {r["text_sha256"] for r in kept.collect()} == {"mine"}


def test_empty_table(documents):
    assert marked(documents([]).limit(0)) == []
    assert exact_dedup.keep_one(documents([]), "doc_id", "text").count() == 0
