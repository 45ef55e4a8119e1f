import random

import pytest

from docpipe.llm import templates

BENCH = "item_id long, text string, leaked string, doc string"


@pytest.fixture
def items(spark):
    def make(texts):
        return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], BENCH)
    return make


QUESTION = ("Tom has 12 apples and gives 5 apples to Mary Jones. After that Tom drives 30 km to the market, "
            "where Mary Jones sells what she was given. How many apples are left with Tom in the end?")


def hits(df, items):
    return {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in
            templates.matches(df, "doc_id", "text", items, "item_id", "text").collect()}


def test_copies_in_any_dress(documents, items):
    filler = "some words of another kind stand here before and after it "
    rows = [(1, filler * 3 + QUESTION + filler), (2, QUESTION.upper()), (3, QUESTION.replace(" ", " ** ")),
            (4, filler * 9), (5, None), (6, ""), (7, QUESTION[:60]), (None, QUESTION)]
    assert hits(documents(rows), items([QUESTION])) == {(1, 0): False, (2, 0): False, (3, 0): False, (None, 0): False}


def test_other_names_and_numbers(documents, items):
    changed = QUESTION.replace("Tom", "Peter Bell").replace("Mary Jones", "Ann").replace("12", "40").replace("30 km", "7 miles")
    one = changed.replace("Peter Bell to the", "Carla to the").replace("left with Peter Bell", "left with Carla")
    mixed = changed.replace("After that Peter Bell", "After that Carla")
    assert hits(documents([(1, changed), (2, one)]), items([QUESTION]))[1, 0] is True
    # The person who drives is not the one with the apples: the slots contradict each other.
    assert (3, 0) not in hits(documents([(3, mixed)]), items([QUESTION]))


def test_edge_tables(documents, items):
    assert hits(documents([]), items([QUESTION])) == {}
    assert hits(documents([(1, QUESTION)]), items([])) == {}
    assert hits(documents([(1, "too few words"), (2, QUESTION)]), items(["too few words", None, "", QUESTION, QUESTION])) == {
        (2, 3): False, (2, 4): False}


def test_beyond_the_sent_hashes(documents, items, monkeypatch):
    rows = [(1, "before " * 40 + QUESTION), (2, "nothing of it " * 30)]
    monkeypatch.setattr(templates, "SENT_HASHES", 3)
    assert hits(documents(rows), items([QUESTION])) == {(1, 0): False}


def test_clean(documents, items):
    df = documents([(1, QUESTION), (2, "a clean text"), (3, None), (2, "a clean text"), (None, "free")])
    kept = templates.clean(df, "doc_id", "text", items([QUESTION]), "item_id", "text")
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect() if r["text"]) == [
        (0, "free"), (2, "a clean text"), (2, "a clean text")]


def test_against_plain_windows(documents, items):
    """Texts without capitals or numbers: a document is found where it holds three quarters of an item's
    five-word windows."""
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "klmnprst" for b in ("a", "o", "ei", "u")]
    bench = [" ".join(rng.choice(words) for _ in range(rng.randint(6, 30))) for _ in range(15)]
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(50)]
        if i % 2:
            own = rng.choice(bench).split()
            own[rng.randrange(len(own))] = rng.choice(words)
            text[10:10] = own
        rows.append((i, " ".join(text)))

    def windows(text):
        w = text.split()
        return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]

    want = set()
    for i, text in rows:
        have = set(windows(text))
        for j, item in enumerate(bench):
            own = windows(item)
            if own and sum(w in have for w in own) >= 0.75 * len(own):
                want.add((i, j))
    assert set(hits(documents(rows), items(bench))) == want and len(want) > 10


def test_pieces_of_a_long_text_meet(monkeypatch):
    text = "alpha beta 1,200.5 km gamma Delta Epsilon zeta eta theta iota " * 30
    whole = [part.tolist() for part in templates.tokens([text, "x", text])]
    monkeypatch.setattr(templates, "PIECE", 50)
    assert [part.tolist() for part in templates.tokens([text, "x", text])] == whole
