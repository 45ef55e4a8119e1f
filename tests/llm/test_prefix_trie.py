import random
import struct

import duckdb
import pandas as pd

from docpipe.llm import prefix_trie
from docpipe.llm.oracle import ORACLE
from docpipe.llm.queries import rebuilt_conversations


def _brute(keys):
    nodes = {}
    for conv, key in keys:
        for d in range(len(key) // 8 + 1):
            n, least = nodes.get(key[:8 * d], (0, None))
            nodes[key[:8 * d]] = (n + 1, conv if least is None else min(least, conv))
    return {(k, len(k) // 8, n, m) for k, (n, m) in nodes.items()}


def test_radix_tree_nodes_equal_all_prefixes():
    rng = random.Random(7)
    # Ids that share leading bytes, many siblings (nodes grow to 48 and 256), copies and prefixes.
    ids = [struct.pack(">Q", v) for v in [1, 2, 3, 258, 259, 1 << 40, (1 << 40) + 5] + list(range(300, 600))]
    keys = []
    for conv in range(3000):
        length = rng.choice([0, 1, 1, 2, 3, 5])
        keys.append((conv, b"".join(rng.choice(ids[:7] if rng.random() < 0.7 else ids) for _ in range(length))))
    keys += keys[:50]
    root = prefix_trie._Inner(b"")
    for conv, key in keys:
        root = prefix_trie.insert(root, key, conv)
    got = prefix_trie.turn_nodes(root)
    assert len(got) == len(set(got))
    assert set(got) == _brute(keys)


ROWS = [
    # conv_id, turn, role, text
    (0, 0, "user", "hi"), (0, 1, "assistant", "hello"), (0, 2, "user", None),
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 1, "assistant", "hello"),
    (2, None, None, "start"), (2, 0, "user", "hi"), (2, 0, "system", "hi"),
    (3, 5, "user", "x"),
    (5, 0, "user", "hi"),
    (6, 0, "user", "other"), (6, 1, "user", "é" * 3000),
    (9, 0, "user", "hi"),
    (12, 0, "user", "twelve"),
    (None, 0, "user", "nobody"),
]


def _oracle(rows):
    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con.register("conversations", frame)
    return con.sql(ORACLE["op12_conversation_trie"]).df()


def _norm(df):
    cols = sorted(df.columns)
    df = df[cols].astype(object).where(df[cols].notna(), None)
    return sorted(tuple(str(int(v)) if isinstance(v, float) else str(v) for v in row) for row in df.itertuples(index=False))


def test_trie_equals_sql_with_nulls_ties_copies_and_clashing_columns(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "'c' AS conv", "'k' AS key", "1 AS pos", "'z' AS tid").repartition(3)
    turns, convs = rebuilt_conversations(df)
    got = prefix_trie.trie_of(turns, convs).toPandas()
    want = _oracle(ROWS)
    assert _norm(got) == _norm(want)
    root = got[got.depth == 0].iloc[0]
    assert root.n_convs == 8 and pd.isna(root.parent_conv_id)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    turns, convs = rebuilt_conversations(df)
    assert prefix_trie.trie_of(turns, convs).count() == 0
