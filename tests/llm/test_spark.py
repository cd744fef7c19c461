"""Operators in Spark against brute force, with nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, exact_dedup, html_extract, langid, merkle, mixing, ngram_join, secrets, suffix_dedup, warc
from ledgerloom.llm.common import ship

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, name string, n int, key string, node string, rid int"


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7)))
    text = lambda k: " ".join(word() for _ in range(k))
    base, passage = text(120), text(60)
    out = [None, "", " ", "one", "One\tone", "a b c", "A  b c", base, base, base.replace(" ", "\n", 9), text(4000), "x" * 3000, "x" * 150]
    out += [re.sub(r"\b\w", lambda m: m[0].upper(), base)] + [f"{text(30)} {passage} {text(30)}" for _ in range(6)]
    for _ in range(12):  # near copies
        words = base.split()
        words[rnd.randrange(120)] = word()
        out.append(" ".join(words))
    made = [(i, t, rnd.choice(["en", "de", None]), rnd.choice(["s1", "s2", None, "hot", "hot"]), 0, "n", 1, "k", "d", 1) for i, t in enumerate(out)]
    return [*made, made[7], (None, base, "en", "s1", 0, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    ship(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    ship(spark)
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, none, rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0d]+", " ", t or "")
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    want = sorted((str(r[0]), min((x for x in groups[norm(r[1])] if x is not None)), len(groups[norm(r[1])]),
                   hashlib.sha256(norm(r[1]).encode()).hexdigest()) for r in rows)
    got = exact_dedup.exact_dedup(docs).collect()
    assert sorted((str(r.doc_id), r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    assert exact_dedup.exact_dedup(none).count() == 0


def test_block_names_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HEAD", 2)
    monkeypatch.setattr(exact_dedup, "BLOCK", 3)
    texts = ["abcabcabcabcab", "abcabcabcabcab", "abcabcabcabcac", "abcabcxbcabcab", "ab", "ab", "abc"]
    got = exact_dedup.exact_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    assert {r.doc_id: r.keep_id for r in got} == {i: texts.index(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("small,block", [(64, 512), (2, 4)])
def test_near_duplicates(docs, rows, small, block):
    sets = {}
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        sets[r[0]] = frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = [i for i in sets if i is not None]
    for i in ids:
        for j in ids:
            c = len(sets[i] & sets[j])
            if i < j and c and 100 * c >= 85 * (len(sets[i]) + len(sets[j]) - c):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    got = ngram_join.near_duplicates(docs, small=small, block=block).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_shingles == len(sets[r.doc_id])
        assert r.component_id == root(r.doc_id if r.doc_id is not None else 7)


def test_near_duplicates_of_nothing(none):
    assert ngram_join.near_duplicates(none).count() == 0


def test_suffix_dedup(docs, none, rows):
    seen = Counter()
    for r in rows:
        b = (r[1] or "").encode()
        seen.update(b[k:k + 200] for k in range(len(b) - 199))
    want = []
    for r in rows:
        b = (r[1] or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                gone[k:k + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        want.append((str(r[0]), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = suffix_dedup.without_repeats(docs).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
    assert suffix_dedup.without_repeats(none).count() == 0


@pytest.mark.parametrize("length", [8, 10])
def test_suffix_dedup_of_short_repeats(spark, length):
    rnd = random.Random(length)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randint(0, 40))) for _ in range(25)] + [
        "".join(rnd.choice("abcdefgh") for _ in range(30)) for _ in range(5)]
    seen = Counter(t[k:k + length] for t in texts for k in range(len(t) - length + 1))
    want = {}
    for i, t in enumerate(texts):
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                gone[k:k + length] = [True] * length
        want[i] = "".join(c for c, g in zip(t, gone) if not g)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup.without_repeats(df, length=length).collect()} == want


def _webster(votes, seats):
    import heapq
    from fractions import Fraction
    won = {k: 0 for k in votes}
    heap = [(-Fraction(v), k) for k, v in votes.items()]
    heapq.heapify(heap)
    for _ in range(seats):
        _, k = heapq.heappop(heap)
        won[k] += 1
        heapq.heappush(heap, (-Fraction(votes[k]) / (2 * won[k] + 1), k))
    return won


def test_apportionment_by_highest_quotients(spark):
    rnd = random.Random(1)
    for seats in (0, 1, 7, 50, 1000):
        votes = {f"p{i:02d}": rnd.randint(1, 10 ** rnd.randint(1, 5)) for i in range(12)}
        df = spark.createDataFrame([(k, float(v), seats) for k, v in votes.items()], "party string, votes double, seats bigint")
        assert {r.party: r.won for r in mixing.apportion(df, [], "party", "votes", "seats").collect()} == _webster(votes, seats)


def test_mix(docs, none, rows):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0d]+", t or ""))
    got = mixing.mix(docs, block_words=4, shard_words=500).collect()
    assert sorted((str(r.doc_id), r["size"]) for r in got) == sorted((str(r[0]), size(r[1])) for r in rows)
    held = Counter()
    for r in rows:
        held[r[3]] += size(r[1])
    order = sorted((s for s in held if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, rest = {}, set(order), sum(held.values())
    while free:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * held[s]}
        for s in full or free:
            target[s] = 3 * held[s] if full else share[s]
        if not full:
            break
        rest -= sum(target[s] for s in full)
        free -= full
    taken = Counter()
    for r in got:
        assert r.source_size == held[r.source] and abs(r.target - target[r.source]) < 1e-6 and 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 4 * 30 for s in order)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5), block_words=4, shard_words=500).collect()))
    assert mixing.mix(none).count() == 0 and mixing.drawn(none).count() == 0 and mixing.drawn(docs).columns == docs.columns


def test_language_ids(spark, none):
    rnd = random.Random(3)
    words = {"en": "the cat and this house with water".split(), "de": "der hund und diese straße mit größe".split()}
    data = [(i, " ".join(rnd.choice(words[k]) for _ in range(12)), k if i % 5 else None) for i in range(120) for k in [rnd.choice(["en", "de"])]]
    truth = {i: "de" if re.search("und|der|mit|hund", t) else "en" for i, t, _ in data}
    data += [(1000, None, "en"), (1001, "12 34 !", "de"), (1002, "", None)]
    got = {r.doc_id: r for r in langid.language_ids(spark.createDataFrame(data, "doc_id bigint, text string, lang string")).collect()}
    assert all(got[i].lang_pred == truth[i] for i in truth) and {got[i].lang_pred for i in (1000, 1001, 1002)} == {"und"}
    assert all(0 <= r.score <= 1 for r in got.values()) and got[1].held_out in (True, False)
    assert langid.language_ids(none).count() == 0
    unlabelled = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    assert langid.language_ids(unlabelled).collect()[0].lang_pred == "und"


def test_merkle_neighbours(docs, none, rows):
    got = merkle.edited_fingerprints(docs).collect()
    assert len(got) == len(rows) and merkle.edited_fingerprints(none).count() == 0
    ordered = sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0])
    by_id = {r.doc_id: r for r in got}
    for r, after in zip(ordered, ordered[1:]):
        if Counter(x[0] for x in rows)[r[0]] == 1 and Counter(x[0] for x in rows)[after[0]] == 1:
            t, u = r[1] or "", after[1] or ""
            h = len(t) // 2
            assert by_id[r[0]].edited_sha256 == hashlib.sha256((t[:len(t) - h] + u[:h]).encode()).hexdigest()
            assert by_id[r[0]].fingerprint == merkle.fingerprint(t) and by_id[r[0]].n_chars == len(t)
    last = [r for r in got if r.doc_id is None][0]  # after the last comes the first
    t, u = rows[-1][1], ordered[0][1] or ""
    assert last.edited_sha256 == hashlib.sha256((t[:len(t) - len(t) // 2] + u[:len(t) // 2]).encode()).hexdigest()
    one = docs.where("doc_id = 3")
    assert merkle.edited_fingerprints(one).collect()[0].near_next == 1.0


def test_tokens_secrets_and_pages(spark, docs, none):
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = bpe.encode(docs, path, public_tokenizers.PATTERN, carry=("doc_id", "text"))
    back = bpe.decode(ids, path, public_tokenizers.PATTERN, carry=("text",))
    assert back.where(F.coalesce(F.col("text"), F.lit("")) != F.col("decoded").cast("string")).count() == 0
    assert bpe.round_trip(none, path, public_tokenizers.PATTERN).count() == 0
    assert secrets.secret_digest(docs).count() == docs.count() and secrets.secret_digest(none).count() == 0
    pages = spark.createDataFrame([(1, "http://a/ b", "<p>x</p>", 0), (2, None, None, 0), (3, "u", "", 0), (4, "u", "<p>x</p>", 0), (4, "u", "<p>x</p>", 0),
                                   (None, "u", "<p>x</p>", 0)], "page_id bigint, url string, html string, key int")
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in warc.archived_pages(pages).collect())
    assert got == [("1", 8, "response", None), ("2", 0, "response", None), ("3", 0, "revisit", 2), ("4", 8, "revisit", 1), ("4", 8, "revisit", 1),
                   ("None", 8, "revisit", 1)]
    assert warc.archived_pages(pages.limit(0)).count() == 0
    shown = pages.withColumn("html", F.when(F.col("page_id") == 1, "<nav><a href=/>Menu</a></nav><article><p>A page.</p></article>").otherwise(F.col("html").substr(1, 0)))
    assert {(r.page_id, r.text, r.n_chars) for r in html_extract.main_text(shown).collect()} == {
        (1, "A page.", 7), (2, "", 0), (3, "", 0), (4, "", 0), (None, "", 0)}
    assert html_extract.main_text(pages.limit(0)).count() == 0


def test_pipeline_on_a_small_table(spark):
    import corpus_pipeline
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert out.select("doc_id").distinct().count() <= docs.count()
    sha = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("s"))
    assert out.join(sha, "doc_id").where("s != decoded_sha256").count() == 0


@pytest.mark.parametrize("kind, ids", [("int", [3, 1, 2, None]), ("string", ["b", "a", "c", None]), ("decimal(30,0)", [5, 10**22, 7, None])])
def test_fingerprints_and_archives_with_any_id(spark, kind, ids):
    ship(spark)
    from decimal import Decimal
    ids = [Decimal(i) if i is not None and kind.startswith("decimal") else i for i in ids]
    texts = ["One. Two. Three.", "One. Two. Four.", "", None]
    df = spark.createDataFrame(list(zip(ids, texts)), f"doc_id {kind}, text string").repartition(2)
    got = merkle.edited_fingerprints(df).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(map(str, ids))
    follow = dict(zip(sorted((i for i in ids if i is not None), reverse=True), sorted((i for i in ids if i is not None), reverse=True)[1:] + [None]))
    follow[None] = max(i for i in ids if i is not None)
    plain = dict(zip(ids, (t or "" for t in texts)))
    for r in got:
        t, f = plain[r.doc_id], plain[follow[r.doc_id]]
        edited = t[:len(t) - len(t) // 2] + f[:len(t) // 2]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == merkle.likeness(merkle.fingerprint(t), merkle.fingerprint(edited))
        assert r.near_next == merkle.likeness(merkle.fingerprint(t), merkle.fingerprint(f))


@pytest.mark.parametrize("kind, ids, first", [("string", ["p9", "p10", "p2"], "p10"), ("decimal(38,0)", [10**20, 2 * 10**19, 3 * 10**21], 2 * 10**19)])
def test_first_page_by_the_order_of_its_type(spark, kind, ids, first):
    ship(spark)
    from decimal import Decimal
    ids = [Decimal(i) if kind != "string" else i for i in ids]
    pages = spark.createDataFrame([(i, f"http://x/{i}", "<p>same</p>") for i in ids], f"page_id {kind}, url string, html string").repartition(2)
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.archived_pages(pages).collect()}
    assert got == {i: ("response", None) if i == first else ("revisit", first) for i in ids}


def test_drawn_rows_without_words_and_with_one_id(spark):
    ship(spark)
    rows = [(1, "a " * 300, "s"), (1, "b " * 10, "s"), (2, "", "s"), (3, None, None), (None, "c " * 50, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = Counter(r.text for r in mixing.drawn(df).collect())
    want = Counter()
    for r in mixing.mix(df).where("size > 0").collect():
        text = next(t for i, t, s in rows if i == r.doc_id and s == r.source and len((t or "").split()) == r["size"])
        want[text] = int(r.taken / r["size"] + 0.5)
    assert got == +want
