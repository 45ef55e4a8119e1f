import hashlib
import random
import re

import pytest
from tests.llm.test_minhash import shingles

import corpus_pipeline
from docpipe.llm import language
from docpipe.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents of two languages with copies, near copies, benchmark passages, junk and nulls."""
    folder = tmp_path_factory.mktemp("tables")
    rng = random.Random(11)
    kinds = {"en": "the of and to in that was ing tion".split(), "de": "der die und das sch ung lich ein".split()}

    def text(lang, n):
        return " ".join("".join(rng.choice(kinds[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))

    bench = [text("en", 30), text("de", 25)]
    rows = []
    for i in range(120):
        lang = "en" if i % 3 else "de"
        rows.append((i, text(lang, rng.randint(40, 120)), lang))
    rows += [(200 + i, rows[i][1], rows[i][2]) for i in range(10)]
    rows += [(300 + i, rows[20 + i][1] + " extra", rows[20 + i][2]) for i in range(10)]
    rows += [(400 + i, f"{text('en', 20)} {bench[i % 2]} {text('en', 20)}", "en") for i in range(6)]
    rows += [(500, None, "en"), (501, "", "de"), (502, "12 !! 34", "en"), (503, "??", None)]
    full = [(i, t, lang, "s", len(t or "")) for i, t, lang in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, bench


def brute(rows, bench, model):
    names, _ = language.predict(model, [t or "" for _, t, _ in rows])
    left = [(i, t) for (i, t, _), name in zip(rows, names, strict=True) if name != "und"]
    last = {}
    for i, t in left:
        last[t] = max(last.get(t, i), i)
    left = [(i, t) for i, t in left if last[t] == i]
    sets, kept = {}, []
    for i, t in sorted(left):
        own = shingles(t)
        if not any(100 * len(own & s) >= 75 * len(own | s) for s in sets.values()):
            kept.append((i, t))
        sets[i] = own

    def windows(t):
        w = re.findall(r"[a-zäöüß]+", t)
        return {tuple(w[j:j + 5]) for j in range(len(w) - 4)}

    return {i for i, t in kept if not any(len(windows(b) & windows(t)) >= 0.75 * len(windows(b)) for b in bench)}, dict(rows_of(rows))


def rows_of(rows):
    return [(i, t) for i, t, _ in rows]


def test_pipeline_against_plain_python(spark, tables, tokenizer):
    folder, rows, bench = tables
    from docpipe.llm.queries import language_model

    model = language_model(spark.read.parquet(f"{folder}/documents.parquet"))
    want, text = brute(rows, bench, model)
    assert 100 < len(want) < 125
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == {i: tokenizer.encode_ordinary(text[i]) for i in want}
    assert len(got) == len(want)


def test_stages_keep_the_columns(spark, tables):
    folder, rows, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "minhash_near_dedup", "decontamination", "bpe_tokens"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), folder).columns == docs.columns


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_cover_their_tables(spark, name):
    sf = "/root/testdata/sf0.001"
    rows = QUERIES[name](spark, sf).count()
    whole = {"op1_warc": "pages", "op10_url_rules": "pages", "op6_chat_transcripts": "conversations"}
    # Rows per passage, slot, trie node or (lang, source, item) rather than per document.
    if name in ("op8_decontaminate", "op9_substring_dedup", "op3_training_order",
                "op12_conversation_trie", "op13_source_divergence"):
        assert rows > 0
    else:
        assert rows == spark.read.parquet(f"{sf}/{whole.get(name, 'documents')}.parquet").count()


def test_tokens_decode_to_the_text(spark, tables):
    folder, rows, _ = tables
    got = corpus_pipeline.tokens(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()
    assert {r["doc_id"]: r["decoded_sha256"] for r in got} == {
        i: hashlib.sha256((t or "").encode()).hexdigest() for i, t, _ in rows}


def test_no_task_of_the_token_stage_holds_two_python_workers(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (3, "")], "doc_id long, text string")
    out = corpus_pipeline.tokens(spark, docs, "")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert {r["doc_id"]: r["n_tokens"] for r in out.collect()} == {1: 2, 2: 0, 3: 0}
