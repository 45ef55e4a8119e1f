import numpy as np
import pytest

from docpipe.llm import training_order


@pytest.mark.parametrize("domain", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(domain):
    out = training_order.permuted(np.arange(domain), domain, 9)
    assert sorted(out.tolist()) == list(range(domain))
    if domain > 60:
        assert out.tolist() != training_order.permuted(np.arange(domain), domain, 10).tolist()


def sequences(rows, tokenizer, length=16):
    out = []
    for doc_id, text in rows:
        ids = [*tokenizer.encode_ordinary(text or ""), 50256]
        out += [(doc_id, i // length, ids[i:i + length]) for i in range(0, len(ids), length)]
    return out


def materialised(df, path, tmp_path, key=1):
    return training_order.materialise(df, "doc_id", "text", path, f"file://{tmp_path}/s", key=key, length=16)


def read(manifest, first=0):
    rows = training_order.read(manifest, first, length=16).collect()
    return sorted((r["slot"], r["doc"], r["window"], np.frombuffer(r["ids"], "<u2").tolist()) for r in rows)


def test_round_trip_and_resume(documents, tokenizer, vocabulary_path, tmp_path, monkeypatch):
    monkeypatch.setattr(training_order, "SHARD_BYTES", 400)
    rows = [(i, f"text number {i} " * (i % 9)) for i in range(-3, 60)] + [(70, None), (71, "long " * 20_000)]
    df = documents(rows)
    manifest = materialised(df, vocabulary_path, tmp_path)
    got = read(manifest)
    assert [r[0] for r in got] == list(range(len(got)))
    assert sorted(r[1:] for r in got) == sorted(sequences(rows, tokenizer))
    assert read(manifest, 77) == got[77:]
    assert max(r["records"] for r in manifest.collect()) == 400 // (16 + 32)
    # The order depends on the key, not on how the rows are dealt.
    again = read(materialised(df.repartition(7), vocabulary_path, tmp_path))
    assert again == got
    assert [r[1:3] for r in read(materialised(df, vocabulary_path, tmp_path, key=2))] != [r[1:3] for r in got]


def test_repeated_and_null_ids(documents, tokenizer, vocabulary_path, tmp_path):
    rows = [(5, "one text"), (5, "one text"), (5, "another"), (None, "no id")]
    got = read_nulls(materialised(documents(rows), vocabulary_path, tmp_path))
    assert got == sorted(((d, w, ids) for d, w, ids in sequences(rows, tokenizer)), key=repr)


def read_nulls(manifest):
    rows = training_order.read(manifest, 0, length=16).collect()
    return sorted(((r["doc"], r["window"], np.frombuffer(r["ids"], "<u2").tolist()) for r in rows), key=repr)


def test_empty_table(documents, vocabulary_path, tmp_path):
    assert read(materialised(documents([]), vocabulary_path, tmp_path)) == []


def test_ids_too_far_apart(documents, vocabulary_path, tmp_path):
    with pytest.raises(ValueError):
        materialised(documents([(-(1 << 62), "a"), (1 << 62, "b")]), vocabulary_path, tmp_path)
