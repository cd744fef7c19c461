"""N-gram Jaccard join by multiple global orders.

A document's set holds its distinct shingles of four words. Sorted by a global
order of all shingles, two sets that are similar enough share a shingle among
the first few of each (the prefix), and in fact a known least number of them.
Each document sends its prefixes under two orders; both put the corpus' most
frequent shingles last and differ in the hash that sorts the rest. A pair is a
candidate only if it passes the count under both orders; candidates are then
verified on their whole sets.

How groups stay bounded
* Documents with one and the same set are one class; classes, not copies, meet.
* A bucket (order, shingle) of up to ``SMALL`` classes gives pairs. Classes of
  larger buckets are clustered instead (classes that share a large bucket,
  directly or through others), and each cluster is verified in pairs of blocks
  of ``BLOCK`` classes. A task multiplies the blocks' incidence matrices and
  returns a spanning forest of the links it finds, never all pairs.
* The frequent shingles are the ``FREQUENT`` largest of counts over all
  documents. They only shape the order: any order gives the same links.

Links are exact but for collisions of 64-bit hashes. Defined results: null or
wordless text has the empty set, n_shingles 0, and is its own component; a
text with fewer than four words has one shingle, its whole sequence; repeated
rows and ties fall into one class; links run between classes, whatever ids
their rows have (null, repeated, of any type), and a component of null ids only
has a null id; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import components as graph
from .common import store

WORDS = 4
#: Two documents link when 100 * shared >= PERCENT * union.
PERCENT = 85
SMALL = 64
BLOCK = 512
FREQUENT = 50_000
#: Shingles that one count of frequent shingles holds at a time.
CHUNK = 3_000_000
SIZE_CAP = 0xFFFF
_M1, _M2, _P = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = x + np.uint64(int(_P) * seed & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, words: _Words, size: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a text. Lower-casing bytes touches A to Z only, and bytes split at blanks 9 to 13 and 32."""
    parts = text.encode("utf-8", "replace").lower().split() if text else []
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    span = min(size, len(h))
    out = np.full(len(h) - span + 1, span, np.uint64)
    for i in range(span):
        out = mix(out ^ h[i:len(h) - span + 1 + i], i + 1)
    return np.unique(out)


def least_shared(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """The smallest intersection of sets of these sizes that makes a link."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n, percent: int):
    """Sets that link with one of size n share a shingle among its first so many."""
    return n - -(-percent * n // 100) + 1


def _values(grams: np.ndarray, order: int, frequent: np.ndarray) -> np.ndarray:
    """Places of the shingles in a global order: 46 bits of hash, frequent ones behind all others, and the order's number."""
    v = mix(grams, 101 + order) >> np.uint64(18)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
        v |= (frequent[at] == grams).astype(np.uint64) << np.uint64(46)
    return v << np.uint64(1) | np.uint64(order)


def _class_key(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


def _batch(columns: dict[str, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns.values()], names=list(columns))


def _survey(slim: DataFrame, size: int) -> DataFrame:
    """Rows of two kinds: a document with its class (doc_id, row, n, key), and a shingle often met in one task (gram, times)."""
    id_kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, count, seen = _Words(), [], 0, set()

        def often(kind):
            grams, times = np.unique(np.concatenate(held), return_counts=True)
            grams, times = grams[times >= 3], times[times >= 3]
            return _batch({"doc_id": ([None] * len(grams), kind), "row": ([None] * len(grams), pa.int64()),
                           "n": ([None] * len(grams), pa.int64()), "key": ([None] * len(grams), pa.int64()), "gram": (grams.view(np.int64), pa.int64()),
                           "times": (times, pa.int64())})

        kind = pa.int64()
        for batch in batches:
            ns, keys, kind = [], [], batch.schema.field(0).type
            for text in batch.column(1):
                grams = shingles(text.as_py(), words, size)
                key = _class_key(grams)
                ns.append(len(grams))
                keys.append(key)
                if key not in seen and len(grams):
                    seen.add(key)
                    held.append(grams)
                    count += len(grams)
            nothing = [None] * len(ns)
            yield _batch({"doc_id": (batch.column(0), kind), "row": (batch.column(2), pa.int64()), "n": (ns, pa.int64()), "key": (keys, pa.int64()),
                          "gram": (nothing, pa.int64()), "times": (nothing, pa.int64())})
            if count > CHUNK:
                yield often(kind)
                held, count, seen = [], 0, set()
        if held:
            yield often(kind)

    return slim.mapInArrow(run, f"doc_id {id_kind}, row bigint, n bigint, key bigint, gram bigint, times bigint")


def _prefixes(slim: DataFrame, frequent, size: int, percent: int) -> DataFrame:
    """(place, key): place is the shingle's place in its order, 16 bits up, and the set's size (``SIZE_CAP`` at most) below."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            places, keys, counts, seen = [], [], [], set()
            for text in batch.column(1):
                grams = shingles(text.as_py(), words, size)
                key = _class_key(grams)
                if not len(grams) or key in seen:
                    continue
                seen.add(key)
                first = prefix_length(len(grams), percent)
                for order in (0, 1):
                    v = _values(grams, order, frequent.value)
                    v = np.partition(v, first - 1)[:first] if first < len(v) else v
                    places.append(v << np.uint64(16) | np.uint64(min(len(grams), SIZE_CAP)))
                    keys.append(key)
                    counts.append(len(v))
            if places:
                yield _batch({"place": (np.concatenate(places).view(np.int64), pa.int64()),
                              "key": (np.repeat(np.array(keys, np.int64), counts), pa.int64())})

    return slim.mapInArrow(run, "place bigint, key bigint")


def _candidates(prefixes: DataFrame, percent: int, small: int) -> DataFrame:
    """Rows (order, a, b, least): a pair of one bucket and the count it must reach; for a large bucket (null, place, key, null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = (np.empty(0, np.int64), np.empty(0, np.int64))
        large = None  # a bucket that is known to be large and goes on

        def pairs(place, key):
            value, n = place >> 16, place & SIZE_CAP
            for d in range(1, small):
                i = np.flatnonzero(value[d:] == value[:-d])
                if not len(i):
                    break
                j = i + d
                x, y = n[i], n[j]
                known = (x < SIZE_CAP) & (y < SIZE_CAP)
                need = least_shared(x, y, percent) - np.maximum(x - prefix_length(x, percent), y - prefix_length(y, percent))
                ok = ~known | (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
                i, j, need = i[ok], j[ok], np.where(known, np.maximum(need, 1), 1)[ok]
                if len(i):
                    yield _batch({"orders": ((value[i] & 1).astype(np.int32), pa.int32()),
                                  "a": (np.minimum(key[i], key[j]), pa.int64()), "b": (np.maximum(key[i], key[j]), pa.int64()),
                                  "least": (need, pa.int64())})

        def members(place, key):
            return _batch({"orders": ([None] * len(key), pa.int32()), "a": (place >> 16, pa.int64()), "b": (key, pa.int64()),
                           "least": ([None] * len(key), pa.int64())})

        def split(place, key, last):
            nonlocal rest, large
            value = place >> 16
            starts = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
            sizes = np.diff(np.r_[starts, len(value)])
            big = sizes > small
            if large is not None and len(value):
                big |= value[starts] == large
            large = None
            if not last and len(starts):
                if big[-1]:
                    large = value[starts[-1]]
                else:  # may go on
                    rest = (place[starts[-1]:], key[starts[-1]:])
                    place, key, sizes, big = place[:starts[-1]], key[:starts[-1]], sizes[:-1], big[:-1]
            in_big = np.repeat(big, sizes)
            if in_big.any():
                yield members(place[in_big], key[in_big])
            some = ~in_big & np.repeat(sizes > 1, sizes)
            if some.any():
                yield from pairs(place[some], key[some])

        for batch in batches:
            place = np.concatenate([rest[0], batch.column(0).to_numpy()])
            key = np.concatenate([rest[1], batch.column(1).to_numpy()])
            rest = (place[:0], key[:0])
            if len(place):
                once = np.r_[True, (place[1:] != place[:-1]) | (key[1:] != key[:-1])]
                yield from split(place[once], key[once], False)
        if len(rest[0]):
            yield from split(*rest, True)

    bucketed = prefixes.repartition(F.shiftright("place", 16)).sortWithinPartitions("place", "key")
    return bucketed.mapInArrow(run, "orders int, a bigint, b bigint, least bigint")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """Rows of (key, text, tasks): one row (task, role, node, grams) for each task that wants the set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            task, role, node, grams = [], [], [], []
            for key, text, wanted in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
                found, key = shingles(text.as_py(), words, size), key.as_py()
                if _class_key(found) != key:  # another text with the same row hash
                    continue
                packed = found.tobytes()
                for w in wanted:
                    task.append(w["task"]), role.append(w["role"]), node.append(key), grams.append(packed)
                if len(task) >= 2000:
                    yield _batch({"task": (task, pa.string()), "role": (role, pa.int32()), "node": (node, pa.int64()), "grams": (grams, pa.binary())})
                    task, role, node, grams = [], [], [], []
            yield _batch({"task": (task, pa.string()), "role": (role, pa.int32()), "node": (node, pa.int64()), "grams": (grams, pa.binary())})

    return texts.mapInArrow(run, "task string, role int, node bigint, grams binary")


def block_links(left: list[np.ndarray], right: list[np.ndarray], percent: int, same: bool) -> np.ndarray:
    """Spanning forest of the links between two lists of sets, as pairs of positions (right ones count on from left)."""
    grams, at = np.unique(np.concatenate(left + ([] if same else right)), return_inverse=True)
    every = left if same else left + right
    sizes = np.array([len(s) for s in every])
    rows = np.repeat(np.arange(len(every)), sizes)
    usual = np.bincount(at, minlength=len(grams)) > 1  # a shingle of one set is in no intersection
    column = np.cumsum(usual) - 1
    keep = usual[at]
    shared = np.zeros((len(every), len(every)), np.float32)
    order = np.argsort(column[at[keep]], kind="stable")
    r, c = rows[keep][order], column[at[keep]][order]
    for first in range(0, int(usual.sum()), 8192):  # a slab of shingles at a time bounds the matrices
        a, b = np.searchsorted(c, [first, first + 8192])
        m = np.zeros((len(every), 8192), np.float32)
        m[r[a:b], c[a:b] - first] = 1
        shared += m @ m.T
    linked = shared * 100 >= percent * (sizes[:, None] + sizes[None, :] - shared)
    np.fill_diagonal(linked, False)
    if not same:
        linked[:len(left), :len(left)] = linked[len(left):, len(left):] = False
    parent = np.arange(len(every))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(*np.nonzero(np.triu(linked))):
        p, q = root(x), root(y)
        if p != q:
            parent[p] = q
            out.append((x, y))
    return np.array(out, np.int64).reshape(-1, 2)


def _verified(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of each task. A task has a middle (role 0) and its partners (1), or two blocks (2 and 3), or one (2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, middle, blocks, a, b = None, None, {2: [], 3: []}, [], []

        def finish():
            if blocks[2]:
                every = blocks[2] + blocks[3]
                same = not now.endswith("x")
                if len(every) > 1 and (same or blocks[3]):
                    for x, y in block_links([s for _, s in blocks[2]], [s for _, s in blocks[3]], percent, same):
                        a.append(every[x][0]), b.append(every[y][0])
            blocks[2], blocks[3] = [], []

        for batch in batches:
            for task, role, node, grams in zip(*(c.to_pylist() for c in batch.columns)):
                if task != now:
                    finish()
                    now, middle = task, None
                grams = np.frombuffer(grams, np.uint64)
                if role >= 2:
                    blocks[role].append((node, grams))
                elif role == 0:
                    middle = (node, grams)
                elif middle is not None:
                    at = np.minimum(np.searchsorted(middle[1], grams), len(middle[1]) - 1)
                    common = int((middle[1][at] == grams).sum())
                    if 100 * common >= percent * (len(grams) + len(middle[1]) - common):
                        a.append(middle[0]), b.append(node)
            if len(a) > 1000:
                yield _batch({"a": (a, pa.int64()), "b": (b, pa.int64())})
                a, b = [], []
        finish()
        yield _batch({"a": (a, pa.int64()), "b": (b, pa.int64())})

    return sets.repartition("task").sortWithinPartitions("task", "role").mapInArrow(run, "a bigint, b bigint")


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, percent: int = PERCENT,
          small: int = SMALL, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, classes, links): members has doc_id, n and key, classes key, n, row (the row whose text stands for the
    class) and doc_id (the smallest), links pairs (a, b) of keys.

    The links connect whatever is connected; of a cluster's links only a spanning forest per pair of blocks is listed.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # a row is found again by what it holds, so that null and repeated ids lose no text
    slim = slim.withColumn("row", F.xxhash64("doc_id", "text"))
    survey = store(_survey(slim, size), "join-survey")
    often = survey.where("gram is not null").groupBy("gram").agg(F.sum("times").alias("times")).orderBy(
        F.desc("times"), "gram").limit(FREQUENT).select("gram").toPandas()["gram"].to_numpy(np.int64)  # FREQUENT numbers at most
    frequent = spark.sparkContext.broadcast(np.sort(often.view(np.uint64)))

    members = survey.where("key is not null").select("doc_id", "n", "key")
    classes = store(survey.where("key is not null and n > 0").groupBy("key", "n").agg(
        F.min("row").alias("row"), F.min("doc_id").alias("doc_id")), "join-classes")

    found = store(_candidates(_prefixes(slim, frequent, size, percent), percent, small), "join-candidates")
    pairs = found.where("orders is not null").groupBy("a", "b").agg(
        F.min("least").alias("least"), F.sum((F.col("orders") == 0).cast("int")).alias("one"),
        F.sum((F.col("orders") == 1).cast("int")).alias("two")).where("one >= least and two >= least").select("a", "b")
    wanted = store(pairs.select(F.concat(F.lit("p"), F.col("a").cast("string")).alias("task"), F.explode(F.array(
        F.struct(F.lit(1).alias("role"), F.col("b").alias("key")), F.struct(F.lit(0).alias("role"), F.col("a").alias("key")))).alias("w"))
        .select("task", "w.role", "w.key").distinct(), "join-wanted")
    clustered = found.where("orders is null").select("a", F.col("b").alias("key")).distinct()
    clustered = store(clustered, "join-large")
    # a bucket joins all its classes to its smallest one
    firsts = clustered.groupBy("a").agg(F.min("key").alias("first"))
    cluster = graph.components(clustered.join(firsts, "a").select(F.col("first").alias("a"), F.col("key").alias("b")))
    total = cluster.groupBy("component").count().withColumn("blocks", F.ceil(F.col("count") / block)).select("component", "blocks")
    spread = cluster.join(total, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    other = F.explode(F.expr("sequence(0L, blocks - 1)"))
    blocked = spread.select("component", "own", F.col("node").alias("key"), other.alias("with")).select(
        F.concat_ws("-", F.lit("c"), "component", F.least("own", "with"), F.greatest("own", "with")).alias("task"),
        F.when(F.col("own") <= F.col("with"), 2).otherwise(3).alias("role"), "key", (F.col("own") != F.col("with")).alias("cross"))
    blocked = blocked.select(F.concat("task", F.when(F.col("cross"), "x").otherwise("")).alias("task"), "role", "key")
    tasks = wanted.unionByName(blocked).join(classes.select("key", "row"), "key").groupBy("key", "row").agg(
        F.collect_list(F.struct("task", "role")).alias("tasks"))
    texts = slim.join(tasks.hint("merge"), "row").select("key", "text", "tasks")
    linked = _verified(_sets(texts, size), percent)
    return members, classes, linked


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS,
                    percent: int = PERCENT, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id reachable by links, its own included)."""
    members, classes, linked = links(docs, id_col, text_col, size, percent, small, block)
    placed = classes.join(graph.components(linked), F.col("key") == F.col("node"), "left").select(
        "key", "n", "doc_id", "component")
    least = placed.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    named = placed.join(least, "component", "left").select(
        "key", "n", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))
    return members.join(named, ["key", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
