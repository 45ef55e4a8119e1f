import base64

import public_tokenizers
import pytest
import tiktoken

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of (doc_id, text[, lang]) as a documents table, with columns whose names clash with those the
    operators make."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "src", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCUMENT).repartition(3)
        for name in ("KEPT", "segment", "key64", "text_sha256", "possibly_repeated", "words", "score", "lang_pred"):
            df = df.selectExpr("*", f"'mine' AS {name}")
        return df
    return make


@pytest.fixture(scope="session")
def tokenizer():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="session")
def vocabulary_path():
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
