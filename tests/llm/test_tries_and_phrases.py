"""Conversation trie, benchmark search and collocations against brute force, with nulls, ties, repeats, long rows, empty tables and extra columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import collocations, fm_index, prefix_trie
from ledgerloom.llm.common import ship

TURNS = "conv_id bigint, turn bigint, role string, text string, unit string, shard int, key string"
DOCS = "doc_id string, text string, lang string, items string, hits int, chunk string"


@pytest.fixture
def shards(spark):
    ship(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _trie(rows):
    """The contract, row by row."""
    key = lambda r: (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).digest())
    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        own[r[0]].append((r[2] or "", r[3] or ""))
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += not children[p]
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def _found(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens,
                   r.ends_sha256) for r in df.collect())


@pytest.fixture(scope="module")
def turns():
    rnd, out = random.Random(3), []
    for c in [*range(0, 40), *range(100, 160), *range(200, 300, 3), 405, 7001]:
        same = rnd.random() < 0.3  # copies
        for t in range(3 if same else rnd.randrange(1, 9)):
            out.append((c, t, "user" if t % 2 else None, f"hello {t}" if same or rnd.random() < 0.6 else f"text {rnd.randrange(4)}", "u", 1, "k"))
    out += [(41, t, "user", "é" * (t % 7), "u", 1, "k") for t in range(2000)]  # one long conversation
    out += [(42, None, "a", "first", "u", 1, "k"), (42, 3, "a", "x", "u", 1, "k"), (42, 3, "a", "y", "u", 1, "k"), (42, 3, "a", "y", "u", 1, "k"),
            (42, -1, None, None, None, None, None), (None, 1, "user", "nobody's", "u", 1, "k")]
    rnd.shuffle(out)
    return out


def test_trie_equals_brute_force(spark, shards, turns, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    df = spark.createDataFrame(turns, TURNS).repartition(3)
    assert _found(prefix_trie.rebuilt_trie(df)) == _trie(turns)


def test_trie_of_copies_on_one_path(spark, shards):
    rows = [(c, t, "user", f"t{t}", "u", 1, "k") for c in range(0, 3000, 100) for t in range(5 + c // 100 % 3)]
    assert _found(prefix_trie.rebuilt_trie(spark.createDataFrame(rows, TURNS).repartition(4))) == _trie(rows)


def test_trie_of_nothing_and_texts(spark, shards):
    none = spark.createDataFrame([], TURNS)
    assert prefix_trie.rebuilt_trie(none).count() == 0
    df = spark.createDataFrame([(1, 0, "user", "a", "u", 1, "k"), (1, 1, None, None, "u", 1, "k"), (2, 0, "user", "a", "u", 1, "k")], TURNS)
    sequences, dictionary = prefix_trie.encoded(df)
    nodes, ends = prefix_trie.prefix_trie(sequences)
    got = prefix_trie.with_texts(nodes, dictionary, df)
    assert sorted((r.depth, r.n_convs, r.n_ends, r.role, r.text) for r in got.collect() if r.depth) == [(1, 2, 1, "user", "a"), (2, 1, 1, "", "")]
    assert sorted((r.end_first, r.ids) for r in ends.collect()) == [(1, [1]), (2, [2])]


@pytest.mark.parametrize("cuts", [[], [1], [3], [1, 2, 3], [2, 4, 6, 8]])
def test_shards_add_up_wherever_they_are_cut(cuts):
    unit = lambda i, chars: i.to_bytes(8, "big") + chars.to_bytes(4, "big")
    a, b, c = unit(1, 3), unit(2, 5), unit(3, 7)
    rows = [(s, n + 1, 10 * n) for n, s in enumerate(sorted([b"", a, a + a, a + a + b, a + b, a + b + c, b, b + a, b + c + c]))]

    def total(cuts):
        edges, out = [0, *cuts, len(rows)], defaultdict(lambda: [None, 0, 0, 0, 0])
        for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
            for batch in prefix_trie.shard_nodes(i, rows[lo:hi], rows[lo - 1][0] if lo else None, rows[hi][0] if hi < len(rows) else None):
                paths = {}
                for r in sorted(batch.to_pylist(), key=lambda r: r["depth"]):
                    paths[r["node"]] = path = paths.get(r["parent"], ()) + ((r["turn_id"],) if r["depth"] else ())
                    t = out[path]
                    t[0] = min(x for x in (t[0], r["conv_id"]) if x is not None)
                    for k, c in enumerate(("n_convs", "n_children", "n_leaves", "saved_tokens"), 1):
                        t[k] += r[c]
        return dict(out)

    assert total(cuts) == total([])


def test_sibling_trees_are_balanced():
    tree = prefix_trie.TernarySearchTree()
    tree.insert_sorted([(i.to_bytes(prefix_trie.WIDTH, "big"), 1, i) for i in range(1000)])
    deepest = 0
    for node in range(1, 1001):
        at, steps = tree.eq[0], 0
        while at != node:
            at, steps = (tree.low[at] if tree.unit[node] < tree.unit[at] else tree.high[at]), steps + 1
        deepest = max(deepest, steps)
    assert deepest <= 10


def test_index_finds_all_occurrences():
    rnd = np.random.default_rng(5)
    for symbols, n in [(2, 1), (3, 40), (3, 400), (9, 900)]:
        text = np.r_[rnd.integers(0, symbols, n), 0].astype(np.int32)
        index = fm_index.FMIndex(text, symbols, sample=4)
        windows = np.zeros((60, 5), np.int32)
        lengths = rnd.integers(1, 6, 60)
        for i, length in enumerate(lengths):
            windows[i, :length] = rnd.integers(1, symbols, length)
        found = defaultdict(list)
        for w, lo, hi in zip(*index.search(windows, lengths)):
            found[int(w)] = sorted(index.locate(np.arange(lo, hi)).tolist())
        for i, length in enumerate(lengths):
            want = [p for p in range(len(text) - length + 1) if (text[p:p + length] == windows[i, :length]).all()]
            assert found[i] == want


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = _words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i:i + 10])].add("" if item is None else str(item))
    out = []
    for r in docs:
        w, hit, own = _words(r[1]), set(), set()
        for size in {len(x) for x in windows}:
            for p in range(len(w) - size + 1):
                if tuple(w[p:p + size]) in windows:
                    hit.update(range(p, p + size))
                    own |= windows[tuple(w[p:p + size])]
        out.append((str(r[0]), len(w), len(hit), sorted(own)))
    return sorted(out)


@pytest.mark.parametrize("limits", [{}, {"block_words": 25, "segment": 6, "shard": 40}])
def test_contamination_equals_brute_force(spark, limits):
    ship(spark)
    rnd = random.Random(11)
    text = lambda n: " ".join(rnd.choice("a b c É zürich 7".split()) for _ in range(n))
    items = [(1, text(30)), (2, text(12)), (3, "A b, C"), (4, ""), (5, None), (None, text(10)), (1, text(11)), (7, "x " * 40)]
    docs = [(None, None), ("d0", ""), ("d1", "!?"), ("d2", text(400)), ("d2", text(20)), ("d3", f"{text(9)}; {items[0][1].upper()}... {text(5)}"),
            ("d4", items[5][1] + " " + items[1][1]), ("d5", "a b c"), ("d6", "ab c"), ("d7", "x" * 5000 + " x" * 60)] + [
            (f"e{i}", text(rnd.randrange(40))) for i in range(40)]
    df = spark.createDataFrame([(*d, "en", "clash", 1, "c") for d in docs], DOCS).repartition(3)
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = fm_index.contamination(df, bench, **limits).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in got) == _contamination(docs, items)
    texts = dict((d, t) for d, t in docs if d != "d2")
    for r in got:  # spans hold exactly the words that are hit
        if r.doc_id in texts:
            assert sum(len(_words(texts[r.doc_id][s.start:s.end])) for s in r.spans) == r.n_hit
    assert {r.n_hit for r in fm_index.contamination(df, bench.limit(0)).collect()} == {0}
    assert fm_index.contamination(df.limit(0), bench).count() == 0


def _collocations(docs, least):
    f, n = defaultdict(Counter), Counter()
    for r in docs:
        lang = "und" if r[2] is None else r[2]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, 5):
                f[lang].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if a >= least}
        scored = []
        for p, a in found.items():
            if len(p) < 2:
                continue
            longer = [b for q, b in found.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= 80 * a for b in longer):
                continue
            score, k = min((2_000_000 * a // (found[p[:k]] + found[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        out += [(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for i, x in enumerate(sorted(scored)[:25])]
    return sorted(out)


@pytest.mark.parametrize("chunk", [50, 1_000_000])
def test_collocations_equal_brute_force(spark, chunk):
    ship(spark)
    rnd = random.Random(2)
    words = "to be or not that is Is É the. of, end\n x\x00y   a\tb".split(" ")
    docs = [(str(i), " ".join(rnd.choice(words) for _ in range(rnd.randrange(60))), rnd.choice(["en", None, "und", "de", ""])) for i in range(80)]
    docs += [("z", "to be or not to be " * 300, "en"), ("z", "to be or not to be " * 300, "en"), (None, None, "en"), ("y", "", None), ("x", "one two", "rare")]
    df = spark.createDataFrame([(*d, "i", 1, "c") for d in docs], DOCS).repartition(3)
    got = collocations.collocations(df, best=25, chunk_words=chunk, bucket_words=chunk)
    assert sorted(tuple(r) for r in got.collect()) == _collocations(docs, 30)
    assert collocations.collocations(df.limit(0)).count() == 0


def test_collocation_scores_are_exact(spark):
    """Counts whose products pass 64 bits."""
    got = spark.range(1).select(F.lit(10**15).alias("a"), F.lit(3 * 10**14 + 7).alias("l1"), F.lit(9 * 10**14).alias("r1")).selectExpr(
        "cast(2000000 as decimal(9,0)) * cast(a as decimal(20,0)) div (cast(l1 as decimal(20,0)) + cast(r1 as decimal(20,0))) as score").collect()[0].score
    assert got == 2_000_000 * 10**15 // (12 * 10**14 + 7)
