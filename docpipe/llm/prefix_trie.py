"""Conversation prefix trie: every distinct sequence of first turns shared by conversations is a node,
with its members, children, leaves and the text a shared prefix saves.

Method: each distinct (role, text) turn gets a fixed-width id (8 bytes, big-endian), and a
conversation becomes the concatenation of its turns' ids. Inside ``mapInArrow`` each batch of
conversations is inserted into an adaptive radix tree (nodes of 4, 16, 48 and 256 children that grow as
they fill, paths without branches compressed into a node's prefix); walking it emits only the
turn-aligned byte depths (multiples of 8) as trie nodes, with the batch's member count and smallest
member. Spark merges these partial nodes by their prefix (a map-side combine of the prefixes that a
batch's conversations share), then derives parents, children, leaves and savings by joins and
aggregates. The members that end at a node are hashed in order by a task that streams the node's
sorted ids, so no group is held in memory.

Edge cases: null role or text is ''. Turns are ordered by ``turn`` with nulls first; turns with equal
``turn`` by role, then text (equal rows are interchangeable). A conversation without turns belongs to
the root only. The root (depth 0) has no text, so it saves nothing. Empty input gives no nodes.
Key bytes grow as the square of a conversation's length (a node's key is its whole prefix).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docpipe.llm.tables import stored

WIDTH = 8  # bytes of a turn id


class _Leaf:
    __slots__ = ("key", "n", "least")

    def __init__(self, key: bytes, conv: int):
        self.key, self.n, self.least = key, 1, conv


class _Inner:
    """An inner node: compressed path ``prefix``, children by next byte, and the keys that end here.
    ``kind`` is its layout: 4 and 16 keep sorted parallel lists, 48 an index of 256 slots into a list,
    256 a direct table; each grows into the next when full."""
    __slots__ = ("prefix", "kind", "keys", "kids", "index", "here")

    def __init__(self, prefix: bytes):
        self.prefix, self.kind, self.keys, self.kids, self.index = prefix, 4, [], [], None
        self.here: _Leaf | None = None

    def find(self, byte: int):
        if self.kind == 256:
            return self.kids[byte]
        if self.kind == 48:
            slot = self.index[byte]
            return None if slot < 0 else self.kids[slot]
        for i, k in enumerate(self.keys):
            if k == byte:
                return self.kids[i]
        return None

    def put(self, byte: int, child) -> None:
        if self.kind == 256:
            self.kids[byte] = child
            return
        if self.kind == 48:
            slot = self.index[byte]
            if slot >= 0:
                self.kids[slot] = child
                return
            if len(self.kids) == 48:
                self._grow()
                return self.put(byte, child)
            self.index[byte] = len(self.kids)
            self.kids.append(child)
            return
        for i, k in enumerate(self.keys):
            if k == byte:
                self.kids[i] = child
                return
        if len(self.keys) == self.kind:
            self._grow()
            return self.put(byte, child)
        at = sum(1 for k in self.keys if k < byte)
        self.keys.insert(at, byte)
        self.kids.insert(at, child)

    def _grow(self) -> None:
        pairs = list(self.items())
        if self.kind == 4:
            self.kind = 16
        elif self.kind == 16:
            self.kind, self.index, self.keys, self.kids = 48, [-1] * 256, None, []
            for i, (byte, child) in enumerate(pairs):
                self.index[byte] = i
                self.kids.append(child)
        else:
            self.kind, self.index, self.kids = 256, None, [None] * 256
            for byte, child in pairs:
                self.kids[byte] = child

    def items(self):
        """Children in byte order."""
        if self.kind == 256:
            return ((b, c) for b, c in enumerate(self.kids) if c is not None)
        if self.kind == 48:
            return ((b, self.kids[s]) for b, s in enumerate(self.index) if s >= 0)
        return zip(self.keys, self.kids)


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    i = 0
    while i < n and a[i] == b[i]:
        i += 1
    return i


def _leaf_here(node: _Inner, key: bytes, conv: int) -> None:
    if node.here is None:
        node.here = _Leaf(key, conv)
    else:
        node.here.n += 1
        node.here.least = min(node.here.least, conv)


def insert(root: _Inner, key: bytes, conv: int) -> _Inner:
    """Adds ``key`` (of member ``conv``) under ``root``; returns the root, which a split may replace."""
    parent, byte, node, depth = None, None, root, 0
    while True:
        if isinstance(node, _Leaf):
            if node.key == key:
                node.n += 1
                node.least = min(node.least, conv)
                return root
            same = _common(node.key[depth:], key[depth:])
            inner = _Inner(key[depth:depth + same])
            for k, v in ((node.key, node), (key, _Leaf(key, conv))):
                if len(k) == depth + same:
                    inner.here = v
                else:
                    inner.put(k[depth + same], v)
            return _replace(root, parent, byte, inner)
        same = _common(node.prefix, key[depth:])
        if same < len(node.prefix):
            inner = _Inner(node.prefix[:same])
            inner.put(node.prefix[same], node)
            node.prefix = node.prefix[same + 1:]
            if len(key) == depth + same:
                inner.here = _Leaf(key, conv)
            else:
                inner.put(key[depth + same], _Leaf(key, conv))
            return _replace(root, parent, byte, inner)
        depth += same
        if len(key) == depth:
            _leaf_here(node, key, conv)
            return root
        child = node.find(key[depth])
        if child is None:
            node.put(key[depth], _Leaf(key, conv))
            return root
        parent, byte, node, depth = node, key[depth], child, depth + 1


def _replace(root, parent, byte, node):
    if parent is None:
        return node
    parent.put(byte, node)
    return root


def turn_nodes(root: _Inner) -> Iterator[tuple[bytes, int, int, int]]:
    """(prefix, depth in turns, members, smallest member) of every turn-aligned depth of the tree."""
    # An explicit stack; an inner node is seen on the way down and again once its children are summed.
    out = []
    stack = [(root, -1, b"", False)]
    totals: dict[int, tuple[int, int]] = {}
    while stack:
        node, edge, path, done = stack.pop()
        if isinstance(node, _Leaf):
            for d in range(-(-(edge + 1) // WIDTH), len(node.key) // WIDTH + 1):
                out.append((node.key[:WIDTH * d], d, node.n, node.least))
            totals[id(node)] = (node.n, node.least)
            continue
        full = path + node.prefix
        if not done:
            stack.append((node, edge, path, True))
            for byte, child in node.items():
                stack.append((child, len(full), full + bytes([byte]), False))
            continue
        count, least = (node.here.n, node.here.least) if node.here else (0, None)
        for _, child in node.items():
            c, m = totals.pop(id(child))
            count += c
            least = m if least is None else min(least, m)
        totals[id(node)] = (count, least)
        for d in range(-(-(edge + 1) // WIDTH), len(full) // WIDTH + 1):
            out.append((full[:WIDTH * d], d, count, least))
    return out


NODES = "key binary, depth long, n long, least long"


def _batch_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        root = _Inner(b"")
        for conv, key in zip(batch.column("conv").to_pylist(), batch.column("key").to_pylist()):
            root = insert(root, key, conv)
        rows = turn_nodes(root)
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64()),
        ], schema=pa.schema([("key", pa.binary()), ("depth", pa.int64()), ("n", pa.int64()), ("least", pa.int64())]))


ENDS = "key binary, ends_sha256 string"


def _ends_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's members, comma-joined in ascending order; rows come sorted by (key,
    member) and a key's rows are all in this partition, so the hash streams across batches."""
    key, digest, first = None, None, True
    keys, hexes = [], []
    for batch in batches:
        for k, conv in zip(batch.column("key").to_pylist(), batch.column("conv").to_pylist()):
            if k != key:
                if key is not None:
                    keys.append(key)
                    hexes.append(digest.hexdigest())
                key, digest, first = k, hashlib.sha256(), True
            digest.update((b"" if first else b",") + str(conv).encode())
            first = False
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(hexes, pa.string())],
                                             names=["key", "ends_sha256"])
            keys, hexes = [], []
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())],
                                         names=["key", "ends_sha256"])


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """(key, n_leaves, saved_tokens) of every node's subtree, in work linear in the nodes.

    In byte order of keys a subtree is a run: it starts at the node's key and ends before its bound, the
    key whose last turn id is one more. Each sum is the difference of two running totals over all nodes
    in key order, read at the bound and at the key. The totals run per range of keys (a range partition,
    one task each) and the ranges' own totals, one row per range, are added in; so no node is repeated
    for its ancestors. The root's subtree is all nodes."""
    leaf = (F.col("n_children") == 0).cast("long")
    tid = F.conv(F.hex(F.substring("key", -WIDTH, WIDTH)), 16, 10).cast("long")
    bound = F.concat(F.expr(f"substring(key, 1, {WIDTH} * (depth - 1))"),
                     F.unhex(F.lpad(F.hex(tid + 1), 2 * WIDTH, "0")))
    own = nodes.select("key", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("node"),
                       F.lit(0).alias("sign"), leaf.alias("leaf"), F.col("own_saved").alias("saved"))
    inner = nodes.where(F.col("depth") > 0)
    asks = inner.select("key", F.lit(0).alias("kind"), F.col("key").alias("node"), F.lit(-1).alias("sign"),
                        F.lit(0).cast("long").alias("leaf"), F.lit(0).cast("long").alias("saved")) \
        .unionByName(inner.select(bound.alias("key"), F.lit(0).alias("kind"), F.col("key").alias("node"),
                                  F.lit(1).alias("sign"), F.lit(0).cast("long").alias("leaf"),
                                  F.lit(0).cast("long").alias("saved")))
    # Asks come before a node of the same key: a total read there counts the nodes before that key.
    events = stored(own.unionByName(asks).repartitionByRange("key", "kind")
                    .withColumn("part", F.spark_partition_id()), "trie-order")
    running = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    ranges = events.groupBy("part").agg(F.sum("leaf").alias("r_leaf"), F.sum("saved").alias("r_saved"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, however large the data: the offsets of the ranges before each.
    offsets = ranges.select("part", F.coalesce(F.sum("r_leaf").over(before), F.lit(0)).alias("o_leaf"),
                            F.coalesce(F.sum("r_saved").over(before), F.lit(0)).alias("o_saved"))
    # The asks alone are read; their running totals are those of all events up to them.
    totals = events.withColumn("t_leaf", F.sum("leaf").over(running)) \
        .withColumn("t_saved", F.sum("saved").over(running)).where(F.col("kind") == 0) \
        .join(F.broadcast(offsets), "part")
    sums = totals.groupBy(F.col("node").alias("key")).agg(
        F.sum(F.col("sign") * (F.col("t_leaf") + F.col("o_leaf"))).alias("n_leaves"),
        F.sum(F.col("sign") * (F.col("t_saved") + F.col("o_saved"))).alias("saved_tokens"))
    # The root's key is empty; without nodes this row meets no node and goes.
    whole = ranges.agg(F.sum("r_leaf").alias("n_leaves"), F.sum("r_saved").alias("saved_tokens")) \
        .select(F.lit(b"").cast("binary").alias("key"), "n_leaves", "saved_tokens")
    return sums.unionByName(whole)


def ordered_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos, role, text): turns numbered from 0 in order, null role and text as ''."""
    clean = turns.select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
                         F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                         F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return clean.withColumn("pos", F.row_number().over(order) - 1).drop("turn")


def trie(turns: DataFrame) -> DataFrame:
    """Nodes of the prefix trie of ``turns`` (conv, pos, role, text; every conv listed in ``members``
    of at least one row, or given through ``convs``). One row per node: conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    return trie_of(turns, turns.select("conv").distinct())


def trie_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """As ``trie``, with the conversations (column conv) given apart, so that turnless ones count."""
    spark = turns.sparkSession
    distinct = turns.select("role", "text").distinct()
    ids = stored(distinct.select("role", "text", F.monotonically_increasing_id().alias("tid"),
                                 F.octet_length("text").cast("long").alias("bytes")), "trie-turn-ids")
    coded = turns.join(ids, ["role", "text"]).select("conv", "pos", "tid")
    keys = coded.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("pos", "tid"))).alias("seq")) \
        .select("conv", F.unhex(F.array_join(F.transform("seq", lambda x: F.lpad(F.hex(x["tid"]), 2 * WIDTH, "0")), "")).alias("key"))
    keys = stored(convs.select(F.col("conv").cast("long")).distinct().join(keys, "conv", "left")
                  .select("conv", F.coalesce("key", F.lit(b"").cast("binary")).alias("key")), "trie-keys")

    partial = keys.mapInArrow(_batch_nodes, NODES)
    nodes = partial.groupBy("key").agg(F.first("depth").alias("depth"), F.sum("n").alias("n_convs"),
                                       F.min("least").alias("conv_id"))
    last = F.when(F.col("depth") > 0, F.conv(F.hex(F.substring("key", -WIDTH, WIDTH)), 16, 10))
    nodes = nodes.withColumn("parent_key", F.when(F.col("depth") > 0, F.expr(f"substring(key, 1, {WIDTH} * (depth - 1))")))
    nodes = nodes.withColumn("tid", last.cast("long"))
    nodes = stored(nodes.join(ids.select("tid", "bytes"), "tid", "left")
                   .withColumn("own_saved", (F.col("n_convs") - 1) * F.coalesce("bytes", F.lit(0)))
                   .drop("tid", "bytes"), "trie-nodes")

    children = nodes.where(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")) \
        .agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stored(nodes, "trie-counted")

    up = _subtree_sums(nodes)

    ends = keys.repartition("key").sortWithinPartitions("key", "conv").mapInArrow(_ends_digest, ENDS)
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    empty = hashlib.sha256(b"").hexdigest()
    out = nodes.join(up, "key").join(ends, "key", "left").join(parents, "parent_key", "left")
    return out.select("conv_id", F.col("depth").cast("long"), F.col("parent_conv_id").cast("long"),
                      F.col("n_convs").cast("long"), F.col("n_children").cast("long"),
                      F.col("n_leaves").cast("long"), F.col("saved_tokens").cast("long"),
                      F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))
