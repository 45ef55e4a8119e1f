import itertools

import numpy as np

from docpipe.llm import transcripts

TURNS = "conv_id long, turn long, role string, text string, block string, place string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS).repartition(3)


def conversations(count, marked=True):
    rows = []
    for c in range(count):
        for t in range(c % 5 + 2):
            role = "user" if t % 2 == 0 else "assistant"
            body = f"what is {t}?" if role == "user" else f"It is so, as told before in many words {t}.\nA second line of it."
            rows.append((c, t, role, (f"{role.title()}: " if marked else "") + body))
    return rows


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5):
        seen, step, start = rng.normal(size=(n, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)

        def score(path, seen=seen, step=step, start=start):
            return start[path[0]] + sum(seen[i][s] for i, s in enumerate(path)) + sum(step[a][b] for a, b in itertools.pairwise(path))

        best = max(itertools.product(range(3), repeat=n), key=score)
        assert tuple(transcripts.decoded(seen, step, start)) == best


def parsed(spark, rows, train=None):
    model = transcripts.fit(transcripts.ordered(turns(spark, train or rows), "conv_id", "turn", "text", "role"))
    blocks = transcripts.ordered(turns(spark, rows), "conv_id", "turn", "text")
    names = ("conv", "ord", "role_pred", "begins_turn", "turns", "rendered")
    return sorted((tuple(r[n] for n in names) for r in transcripts.parse(blocks, model).collect()), key=repr)


def test_roles_and_rendering(spark):
    rows = conversations(30)
    got = parsed(spark, rows)
    assert len(got) == len(rows)
    role = {(c, t): r for c, t, r, _ in rows}
    assert all(role[c, t] == r and begins and n == 1 for c, t, r, begins, n, _ in got)
    text = next(r[5] for r in got if r[:2] == (0, 1))
    assert text == "<|assistant|>\nIt is so, as told before in many words 1.\nA second line of it."


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    rows = conversations(40, marked=False)
    rows += [(900, t, "user" if t % 2 == 0 else "assistant", f"what is {t}?" if t % 2 == 0 else "So it is, in many more words.\nAnd a line.")
             for t in range(120)]
    train = conversations(50)
    whole = parsed(spark, rows, train)
    monkeypatch.setattr(transcripts, "BLOCK", 7)
    model_rows = transcripts.ordered(turns(spark, rows), "conv_id", "turn", "text")
    assert model_rows.select("block").distinct().count() > 20
    monkeypatch.setattr(transcripts, "BLOCK", 4096)
    model = transcripts.fit(transcripts.ordered(turns(spark, train), "conv_id", "turn", "text", "role"))
    names = ("conv", "ord", "role_pred", "begins_turn", "turns", "rendered")
    assert sorted((tuple(r[n] for n in names) for r in transcripts.parse(model_rows, model).collect()), key=repr) == whole


def test_nulls_repeats_and_long_texts(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (None, 0, None, "User: hi?"), (None, None, "user", "x"),
            (1, 1, "assistant", ""), (2, 0, "user", "line\n" * 20_000), (2, 0, "user", "line\n" * 20_000)]
    got = parsed(spark, rows, conversations(20))
    assert len(got) == len(rows)
    assert all(r[2] in ("user", "assistant") for r in got)


def test_nothing_to_learn_from(spark):
    assert parsed(spark, conversations(3), [(1, 0, None, "x")]) == []


def test_empty_table(spark):
    model = transcripts.fit(transcripts.ordered(turns(spark, conversations(5)), "conv_id", "turn", "text", "role"))
    assert transcripts.parse(transcripts.ordered(turns(spark, []), "conv_id", "turn", "text"), model).count() == 0
