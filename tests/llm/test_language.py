import random

import numpy as np

from docpipe.llm import language


def plain_phrases(text, train):
    """Longest matches one after another."""
    count = at = 0
    while at < len(text):
        stop = at + 1
        while stop <= len(text) and text[at:stop] in train:
            stop += 1
        at = max(at + 1, stop - 1)
        count += 1
    return count


def test_phrases_are_longest_matches():
    rng = np.random.default_rng(1)
    train = "".join(rng.choice(list("abcd"), 300))
    model = language.learn({"x": [train], "y": [train[::-1]]})
    for size in (1, 2, 7, 50, 400):
        text = "".join(rng.choice(list("abcde"), size))
        symbols = np.array([ord(c) for c in text], np.uint32)
        at = np.searchsorted(model.points, symbols)
        known = model.points[np.minimum(at, len(model.points) - 1)] == symbols
        classes = np.where(known, at + 1, 0).astype(np.int32)
        got = language.phrases(model, classes, np.array([0]), np.array([size]))[0].tolist()
        assert got == [plain_phrases(text, train), plain_phrases(text, train[::-1])]


def test_blocks_and_pieces_add_up(monkeypatch):
    model = language.learn({"en": ["the cat sat on the mat and the dog ran"], "de": ["der hund und die katze auf dem dach"]})
    text = "the dog and the cat " * 3000
    whole = language.predict(model, [text, "die katze " * 10])
    monkeypatch.setattr(language, "BLOCK", 64)
    assert language.predict(model, [text, "die katze " * 10])[0] == whole[0] == ["en", "de"]


def _fitted(documents):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([
        ("the cat sat on the mat with the other cat", "en"), ("this and that and those", "en"),
        ("der hund lag unter dem tisch und schlief", "de"), ("und das ist nicht alles was wir haben", "de"),
        (None, "fr"), ("sans langue", None)])]
    return language.fit(documents(rows), "doc_id", "text", "lang")


def test_defined_results(documents):
    model = _fitted(documents)
    assert model.names == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, "the mat and that"), (5, "UND DAS HAUS unter dem"), (6, "漢字"), (None, "this cat")]
    df = documents(rows)
    got = {(r["doc_id"], r["text"]): (r["guess"], r["certainty"]) for r in
           language.identify(df, "text", model, lang_pred="guess", score="certainty").collect()}
    assert got[1, None] == got[2, ""] == got[3, "12 34 !!"] == ("und", 0.0)
    assert got[4, "the mat and that"][0] == "en" and got[5, "UND DAS HAUS unter dem"][0] == "de"
    assert got[6, "漢字"][0] in ("de", "en") and got[None, "this cat"][0] == "en"
    assert all(0 <= score <= 1 for _, score in got.values())


def test_keep_known(documents):
    model = _fitted(documents)
    df = documents([(1, None), (2, "123"), (3, "the cat"), (4, "漢字")])
    for m in (model, language.learn({})):
        kept = language.keep_known(df, "text", m)
        assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4]


def test_nothing_to_learn_from(documents):
    model = language.fit(documents([]), "doc_id", "text", "lang")
    assert model.names == []
    assert [r["guess"] for r in language.identify(
        documents([(1, "text")]), "text", model, lang_pred="guess", score="certainty").collect()] == ["und"]
    assert language.identify(documents([]), "text", model, keep=["doc_id"]).count() == 0


def test_one_language():
    assert language.predict(language.learn({"en": ["some text"]}), ["more text"]) == (["en"], [1.0])


def test_the_sample_is_24000_symbols_a_language():
    rng = random.Random(12)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(6000))
    assert language.learn({"en": [text]}).log_size == language.learn({"en": [text]}, 24_000).log_size
    assert language.learn({"en": [text]}).log_size != language.learn({"en": [text]}, 12_000).log_size
