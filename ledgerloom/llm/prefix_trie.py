"""Prefix trie of conversations, as ternary search trees over range shards.

Turns (role and text) become dictionary ids; a conversation is the sequence of
its ids, kept as bytes that sort as the ids do (``WIDTH`` bytes a turn: the id
and the code points of the text). Distinct sequences are sorted into range
shards. Each shard inserts its sequences into a ternary search tree, medians
first, so that the siblings of every node form a balanced search tree, and
walks it without recursion, adding members, leaves and savings upwards.

Shards meet at their borders only. A shard is told the last sequence before it
and the first one behind it: nodes on the path of its own first sequence that
the former shares occur in an earlier shard, too, and count as children and as
text there; a sequence that the latter extends is no leaf. So every number of
a shard's part of a subtree is complete and counted once, and border nodes are
merged by adding them up per node. Their number depends on shards and depth.

Bounded tasks: turns and members are gathered as sorted pieces, so neither a
hot conversation nor a hot group of copies goes through one task turn by turn;
the turns that hold more than one in ``HOT`` rows (fewer than ``HOT``) get
their id by broadcast, all others by a shuffle. One sequence is one row.

Defined results: null role or text is empty; rows without a conversation id
belong to none; rows of one conversation with one turn number are ordered by
a hash of role and text; repeated rows are turns of their own; a conversation
without turns is a member of the root; an empty table has no nodes, not even
the root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import store

#: Bytes of a turn in a sequence: 8 of its id, 4 of its text's code points.
WIDTH = 12
HOT = 1000
#: Turns or members of one piece.
PIECE = 65_536


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def turn_key(role, text):
    """256-bit name of a turn."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def encoded(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(sequences, dictionary): conv_id and seq, all turns in order; turn_id, turn_key, chars and times of the distinct turns."""
    keyed = store(conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"), turn_key(F.col(role_col), F.col(text_col)).alias("turn_key"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("chars")), "trie-turns")
    dictionary = store(keyed.groupBy("turn_key").agg(F.max("chars").alias("chars"), F.count("*").alias("times")).withColumn(
        "turn_id", F.monotonically_increasing_id()), "trie-dictionary")
    hot = F.col("times") * HOT > F.lit(keyed.count())
    ids = dictionary.select("turn_key", "turn_id", "times")
    looked = keyed.join(F.broadcast(ids.where(hot).drop("times")), "turn_key", "left")  # fewer than HOT rows
    rest = looked.where("turn_id is null").drop("turn_id").join(ids.where(~hot).drop("times").hint("merge"), "turn_key")
    packed = F.concat(F.unhex(F.lpad(F.hex("turn_id"), 16, "0")), F.unhex(F.lpad(F.hex("chars"), 8, "0")))
    turns = looked.where("turn_id is not null").unionByName(rest).select("conv_id", "turn", "turn_key", packed.alias("unit"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no, now, held = TaskContext.get().partitionId() << 32, None, []

        def piece():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([no], pa.int64()), pa.array([b"".join(held)], pa.binary())],
                                              names=["conv_id", "no", "seq"])

        for batch in batches:
            for conv, unit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (conv != now or len(held) >= PIECE):
                    yield piece()
                    no, held = no + 1, []
                now = conv
                held.append(unit)
        if held:
            yield piece()

    order = ["conv_id", F.col("turn").asc_nulls_first(), "turn_key"]
    sorted_ = turns.repartitionByRange(_parts(turns), *order).sortWithinPartitions(*order).select("conv_id", "unit")
    gathered = store(sorted_.mapInArrow(pieces, "conv_id bigint, no bigint, seq binary"), "trie-pieces")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            convs, seqs = [], []
            for conv, seq in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if conv != now and held:
                    convs.append(now), seqs.append(b"".join(held))
                    held = []
                now = conv
                held.append(seq)
            yield _sequences(convs, seqs)
        if held:
            yield _sequences([now], [b"".join(held)])

    whole = gathered.repartition("conv_id").sortWithinPartitions("conv_id", "no").select("conv_id", "seq")
    return store(whole.mapInArrow(joined, "conv_id bigint, seq binary"), "trie-sequences"), dictionary


def _sequences(convs: list, seqs: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(convs, pa.int64()), pa.array(seqs, pa.binary())], names=["conv_id", "seq"])


def rebuilt(sequences: DataFrame, span: int = 100, most: int = 6) -> DataFrame:
    """Each conversation c with the first h turns of conversation c - c % ``span`` in place of its own; h = crc32(c) % ``most``."""
    heads = sequences.where(F.col("conv_id") % span == 0).select(F.col("conv_id").alias("base"), F.substring("seq", 1, WIDTH * (most - 1)).alias("head"))
    own = sequences.withColumn("base", F.col("conv_id") - F.col("conv_id") % span).withColumn(
        "cut", (F.crc32(F.col("conv_id").cast("string")) % most * WIDTH).cast("int"))
    return own.join(heads, "base", "left").select("conv_id", F.expr(
        "concat(coalesce(substring(head, 1, cut), X''), substring(seq, cut + 1))").alias("seq"))


class TernarySearchTree:
    """Sequences of fixed-width units; node 0 is the root. ``eq`` leads to the search tree of a node's children."""

    def __init__(self):
        self.unit, self.low, self.high, self.eq = [b""], [-1], [-1], [-1]
        self.parent, self.depth, self.members, self.first = [-1], [0], [0], [None]
        self.end: dict[int, tuple[int, int]] = {}

    def _new(self, unit: bytes, parent: int) -> int:
        for column, value in ((self.unit, unit), (self.low, -1), (self.high, -1), (self.eq, -1), (self.parent, parent),
                              (self.depth, self.depth[parent] + 1), (self.members, 0), (self.first, None)):
            column.append(value)
        return len(self.unit) - 1

    def child(self, node: int, unit: bytes, make: bool = False) -> int:
        links, at = self.eq, node
        while links[at] >= 0:
            at = links[at]
            if unit == self.unit[at]:
                return at
            links = self.low if unit < self.unit[at] else self.high
        if not make:
            return -1
        links[at] = new = self._new(unit, node)
        return new

    def insert(self, seq: bytes, n: int, first: int) -> None:
        """``n`` conversations, ``first`` the smallest of them, are this sequence."""
        node = 0
        for i in range(0, len(seq) + 1, WIDTH):
            self.members[node] += n
            if self.first[node] is None or first < self.first[node]:
                self.first[node] = first
            if i < len(seq):
                node = self.child(node, seq[i:i + WIDTH], True)
        self.end[node] = (n, first)

    def insert_sorted(self, rows: list[tuple[bytes, int, int]]) -> None:
        """Medians first, so that no search tree is deeper than the logarithm of its siblings."""
        open_ = [(0, len(rows))]
        while open_:
            a, b = open_.pop()
            if a < b:
                middle = (a + b) // 2
                self.insert(*rows[middle])
                open_ += [(a, middle), (middle + 1, b)]

    def walk(self) -> list[int]:
        """All nodes, each behind its parent."""
        out, open_ = [], [0]
        while open_:
            node = open_.pop()
            out.append(node)
            open_ += [x for x in (self.low[node], self.high[node], self.eq[node]) if x >= 0]
        return out

    def path(self, seq: bytes, depth: int) -> list[int]:
        """Nodes of the first ``depth`` units, without the root."""
        nodes = [0]
        for i in range(0, depth * WIDTH, WIDTH):
            nodes.append(self.child(nodes[-1], seq[i:i + WIDTH]))
        return nodes[1:]


def common_units(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // WIDTH * WIDTH
    x, y = np.frombuffer(a[:n], f"V{WIDTH}"), np.frombuffer(b[:n], f"V{WIDTH}")
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else n // WIDTH


_NODE = pa.schema([("shard", pa.int32()), ("node", pa.int64()), ("parent", pa.int64()), ("open", pa.bool_()), ("parent_open", pa.bool_()),
                   ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
                   ("turn_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
                   ("n_ends", pa.int64()), ("end_first", pa.int64())])
_NODE_KINDS = ("shard int, node bigint, parent bigint, open boolean, parent_open boolean, key binary, parent_key binary, conv_id bigint, depth bigint, "
               "parent_conv_id bigint, turn_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, n_ends bigint, end_first bigint")


def shard_nodes(shard: int, rows: list[tuple[bytes, int, int]], before: bytes | None, behind: bytes | None) -> Iterator[pa.RecordBatch]:
    """Nodes of one shard's sorted distinct sequences (seq, n, first) between those of its neighbours."""
    tree = TernarySearchTree()
    tree.insert_sorted(rows)
    first, last = rows[0][0], rows[-1][0]
    guests = set() if before is None else {0, *tree.path(first, common_units(before, first))}
    border = guests | (set() if behind is None else {0, *tree.path(last, common_units(last, behind))})
    goes_on = tree.path(last, len(last) // WIDTH)[-1:] or [0] if behind is not None and behind.startswith(last) else []

    order, size = tree.walk(), len(tree.unit)
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for node in reversed(order):
        chars = int.from_bytes(tree.unit[node][8:], "big")
        if tree.eq[node] < 0 and node not in goes_on:
            leaves[node] = 1
        saved[node] += chars * (tree.members[node] - (node not in guests))
        if node:
            up = tree.parent[node]
            children[up] += node not in guests
            leaves[up] += leaves[node]
            saved[up] += saved[node]

    keys, states = {}, {}  # of border nodes, whose ancestors are border nodes, too
    for node in order:
        if node in border:
            state = states[tree.parent[node]].copy() if node else hashlib.sha256()
            state.update(tree.unit[node])
            states[node], keys[node] = state, state.digest()
    for at in range(0, size, 100_000):
        some = order[at:at + 100_000]
        ups = [tree.parent[x] for x in some]
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((
            [shard] * len(some), some, ups, [x in border for x in some], [u in border for u in ups], [keys.get(x) for x in some],
            [keys.get(u) for u in ups], [tree.first[x] for x in some], [tree.depth[x] for x in some],
            [tree.first[u] if u >= 0 else None for u in ups], [int.from_bytes(tree.unit[x][:8], "big") if x else None for x in some],
            [tree.members[x] for x in some], [children[x] for x in some], [leaves[x] for x in some], [saved[x] for x in some],
            [tree.end.get(x, (0, None))[0] for x in some], [tree.end.get(x, (0, None))[1] for x in some]), _NODE)], schema=_NODE)


def prefix_trie(sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of conversations (conv_id, seq).

    nodes: conv_id (smallest member), depth, parent_conv_id, turn_id, n_convs, n_children, n_leaves, saved_tokens, n_ends and end_first
    (conversations that end here and the smallest of them). ends: end_first, no and ids, the ending conversations in ascending pieces.
    """
    parts = _parts(sequences)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            out = []
            for conv, seq in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (seq != now or len(held) >= PIECE):
                    out.append((now, held))
                    held = []
                now = seq
                held.append(conv)
            yield _pieces(out)
        if held:
            yield _pieces([(now, held)])

    def _pieces(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in rows], pa.binary()), pa.array([x[0] for _, x in rows], pa.int64()),
             pa.array([x for _, x in rows], pa.list_(pa.int64()))], names=["seq", "no", "ids"])

    ranged = sequences.select("conv_id", "seq").repartitionByRange(parts, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    pieces = store(ranged.mapInArrow(members, "seq binary, no bigint, ids array<bigint>"), "trie-members")
    counted = pieces.groupBy("seq").agg(F.min("no").alias("first"), F.sum(F.size("ids")).cast("bigint").alias("n"))
    distinct = store(counted.repartitionByRange(parts, "seq").sortWithinPartitions("seq").withColumn("shard", F.spark_partition_id()), "trie-distinct")
    ends = pieces.join(distinct.select("seq", F.col("first").alias("end_first")).hint("merge"), "seq").select("end_first", "no", "ids")

    edges = store(distinct.groupBy("shard").agg(F.min("seq").alias("low"), F.max("seq").alias("high")), "trie-edges")
    row = Window.orderBy("shard")  # one number per shard
    near = edges.select("shard").withColumns({"before": F.lag("shard").over(row), "behind": F.lead("shard").over(row)})
    told = near.join(edges.select(F.col("shard").alias("before"), F.col("high").alias("seq")), "before").select("shard", F.lit(0).alias("role"), "seq")
    told = told.unionByName(near.join(edges.select(F.col("shard").alias("behind"), F.col("low").alias("seq")), "behind").select(
        "shard", F.lit(1).alias("role"), "seq")).withColumns({"first": F.lit(None).cast("bigint"), "n": F.lit(None).cast("bigint")})
    rows = distinct.withColumn("role", F.lit(2)).unionByName(told)

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides, held = None, {}, []
        for batch in batches:
            for shard, role, seq, n, first in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != now:
                    if held:
                        yield from shard_nodes(now, held, sides.get(0), sides.get(1))
                    now, sides, held = shard, {}, []
                if role < 2:
                    sides[role] = seq
                else:
                    held.append((seq, n, first))
        if held:
            yield from shard_nodes(now, held, sides.get(0), sides.get(1))

    dealt = rows.select("shard", "role", "seq", "n", "first").repartition("shard").sortWithinPartitions("shard", "role", "seq")
    found = store(dealt.mapInArrow(trees, _NODE_KINDS), "trie-nodes")
    border = found.where("open")
    merged = store(border.groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_key").alias("parent_key"), F.max("turn_id").alias("turn_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens", "n_ends")], F.max("end_first").alias("end_first")), "trie-border")
    columns = ["conv_id", "depth", "parent_conv_id", "turn_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "n_ends", "end_first"]
    up = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    tops = merged.join(up, "parent_key", "left").select(columns)
    smallest = border.select("shard", F.col("node").alias("parent"), "key").join(
        merged.select("key", F.col("conv_id").alias("parent_conv_id")), "key").drop("key")
    inner = found.where("not open")
    below = inner.where("parent_open").drop("parent_conv_id").join(smallest, ["shard", "parent"]).select(columns)
    return inner.where("not parent_open").select(columns).unionByName(below).unionByName(tops), ends


def with_texts(nodes: DataFrame, dictionary: DataFrame, conversations: DataFrame, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Nodes with role and text of their last turn (null at the root)."""
    texts = conversations.select(turn_key(F.col(role_col), F.col(text_col)).alias("turn_key"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                                 F.coalesce(F.col(text_col), F.lit("")).alias("text")).dropDuplicates(["turn_key"])
    turns = dictionary.join(texts, "turn_key").select("turn_id", "role", "text")
    return nodes.join(turns, "turn_id", "left")


def ends_digests(ends: DataFrame) -> DataFrame:
    """(end_first, sha256): lowercase hex over the members' decimal ids, comma-joined, hashed piece by piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            firsts, out = [], []
            for first, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = ",".join(map(str, ids.as_py())).encode()
                if first == now:
                    state.update(b"," + text)
                    continue
                if state is not None:
                    firsts.append(now), out.append(state.hexdigest())
                now, state = first, hashlib.sha256(text)
            yield pa.RecordBatch.from_arrays([pa.array(firsts, pa.int64()), pa.array(out, pa.string())], names=["end_first", "sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()], pa.string())], names=["end_first", "sha256"])

    return ends.repartition("end_first").sortWithinPartitions("end_first", "no").select("end_first", "ids").mapInArrow(
        run, "end_first bigint, sha256 string")


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the rebuilt conversations, with the digest of the conversations that end at each."""
    sequences, _ = encoded(conversations)
    nodes, ends = prefix_trie(store(rebuilt(sequences), "trie-rebuilt"))
    return nodes.join(ends_digests(ends), "end_first", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


ORACLE_SQL = r"""
WITH own AS (
    SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), crc AS (
    SELECT conv_id, turns, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
        lambda a, b: list_reduce([xor(a, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) % 6 AS h
    FROM own
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns, [])[:c.h], c.turns[c.h + 1:]) AS seq
    FROM crc c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
), prefixes AS (
    SELECT conv_id, len(seq) AS n, unnest(range(0, len(seq) + 1)) AS depth, seq FROM rebuilt
), nodes AS (
    SELECT seq[:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
    FROM prefixes GROUP BY 1, 2
), children AS (
    SELECT path[:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), full_nodes AS (
    SELECT n.*, coalesce(c.n_children, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * len(n.path[n.depth].t) END AS own_saved
    FROM nodes n LEFT JOIN children c ON c.path = n.path
), upward AS (
    SELECT path[:a] AS path, sum(own_saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
    FROM (SELECT path, own_saved, n_children, unnest(range(0, depth + 1)) AS a FROM full_nodes) GROUP BY 1
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
       u.n_leaves::BIGINT AS n_leaves, u.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN upward u ON u.path = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[:n.depth - 1]
"""
