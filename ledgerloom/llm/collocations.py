"""Phrase collocations by SETM relational mining.

Texts are lower-cased (A to Z), cut into pieces and pieces into words. The
occurrence relation R_k holds, per piece and position, the phrase of k words
that starts there; it is kept sorted by piece and position, in chunks of about
``CHUNK`` words of one language. Each length makes one round:

1. group-count: every chunk counts its own phrases first, so a phrase has one
   entry per chunk however often it occurs. Entries are dealt by hash into
   buckets, about one per ``BUCKET`` words of the corpus; a bucket adds up the
   counts and names the phrases that reach ``LEAST``, all others go. Words are
   compared with their language as text, a longer phrase as the names of its
   two parts, all words but the last and all but the first: names are numbers
   given once, so equal names are equal phrases;
2. semi-join: names return to the chunks that asked, and R_k keeps the
   positions of these only;
3. merge-join: R_k meets itself one position further on in the same piece, two
   sorted relations side by side, which gives R_(k+1).

Both results of a round, R_(k+1) and the named phrases, are written to the
shared folder as one table, and the round's shuffle files go. Entries travel
in columns, one row per chunk and bucket. Text and counts of the parts of the
phrases found are put together by joins on names.

Bounded tasks: a chunk holds ``CHUNK`` words and one text beyond that at most;
a bucket holds its share of the phrases, each at most once per chunk; the best
phrases of a language are chosen among the best of ``SALTS`` parts of it.

Defined results: null text has no words; a null language counts as ``und``,
together with rows that say so; repeated rows and ids count each; ties are
ordered by phrase (bytes of UTF-8); an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, store_once

LONGEST = 4
LEAST = 30
#: A candidate goes when a longer one that holds it has this many hundredths of its occurrences.
COVERED = 80
BEST = 2000
SCALE = 2_000_000
CHUNK = 2_000_000
BUCKET = 500_000
SALTS = 64

BREAK = b"."
#: Bytes A to Z in lower case, tab as space, every mark that ends a piece as BREAK.
_PLAIN = bytes(ord(".") if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))

_CUTS = [f"{side}{i}" for i in range(1, LONGEST) for side in "lr"]
#: A row is a chunk's relation (codes; words and times in R_1) or its entries of one bucket (body).
_ROW = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("times", pa.int64()), ("codes", pa.binary()), ("words", pa.binary()),
                  ("bucket", pa.int64()), ("body", pa.list_(pa.binary()))])
_ROW_KINDS = "chunk bigint, lang string, times bigint, codes binary, words binary, bucket bigint, body array<binary>"
#: A row is a chunk's relation (codes), its answer (local, names) or a frequent phrase: name, then lang and phrase of a word or the names of two parts.
_COUNTED = pa.schema([("chunk", pa.int64()), ("codes", pa.binary()), ("local", pa.binary()), ("names", pa.binary()), ("name", pa.int64()),
                      ("lang", pa.string()), ("phrase", pa.string()), ("left", pa.int64()), ("right", pa.int64()), ("a", pa.int64())])
_COUNTED_KINDS = "chunk bigint, codes binary, local binary, names binary, name bigint, lang string, phrase string, left bigint, right bigint, a bigint"


class _Codes(dict):
    """Words to numbers from 1 on, as they come; the break is 0."""

    def __init__(self):
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _rows(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers by byte planes, as the high bytes are alike, compressed."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "big") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(body: bytes, kind: type) -> np.ndarray:
    planes = pa.decompress(body[8:], int.from_bytes(body[:8], "big"), "zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _entries(chunk: int, lang: str | None, hashes: np.ndarray, buckets: int, columns: dict, order: tuple = ()) -> tuple[pa.RecordBatch, np.ndarray]:
    """A chunk's counted phrases, a row per bucket, and their places from 1 on. Entries keep their number as differences."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    at = np.lexsort((*order, bucket))
    place = np.empty(len(at), np.int32)
    place[at] = np.arange(1, len(at) + 1)
    found, first = np.unique(bucket[at], return_index=True)
    bodies = []
    for begin, end in zip(first, [*first[1:], len(at)]):
        own, body = at[begin:end], []
        for name, values in columns.items():
            v = values[own]
            body.append(b"\n".join(v) if v.dtype == object else _packed(np.diff(v, prepend=v.dtype.type(0)) if name in ("left", "local") else v))
        if "local" not in columns:
            body.append(_packed(np.diff(np.arange(begin + 1, end + 1, dtype=np.int32), prepend=np.int32(0))))
        bodies.append(body)
    return _rows(_ROW, len(found), chunk=np.full(len(found), chunk), lang=[lang] * len(found), bucket=found, body=bodies), place


def _hash(*numbers: np.ndarray) -> np.ndarray:
    h = np.zeros(1, np.uint64)
    for x in numbers:
        h = (h ^ x.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _occurrences(docs: DataFrame, chunk_words: int) -> DataFrame:
    """R_1 in chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, open_, total = TaskContext.get().partitionId() << 32, {}, 0

        def close(lang):
            nonlocal chunk, total
            names, parts, n = open_.pop(lang)
            codes = np.concatenate(parts)
            total, chunk = total - n, chunk + 1
            return _rows(_ROW, 1, chunk=[chunk], lang=[lang], codes=[_packed(codes)], words=[b"\n".join(list(names)[1:])], times=[int((codes > 0).sum())])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = (text.as_py() or "").encode("utf-8", "replace").translate(_PLAIN).replace(BREAK, b" . ").split()
                if not tokens:
                    continue
                names, parts, n = open_.get(lang) or (_Codes(), [], 0)
                parts += [np.fromiter(map(names.__getitem__, tokens), np.int32, len(tokens)), np.zeros(1, np.int32)]
                open_[lang] = names, parts, n + len(tokens)
                total += len(tokens)
                if total >= chunk_words:
                    yield close(max(open_, key=lambda x: open_[x][2]))
        for lang in list(open_):
            yield close(lang)

    return docs.mapInArrow(run, _ROW_KINDS)


def _words(relations: DataFrame, buckets: int) -> DataFrame:
    """Each chunk's counted words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk, lang, codes, words = (batch.column(c)[row].as_py() for c in ("chunk", "lang", "codes", "words"))
                words = words.split(b"\n") if words else []
                if words:
                    marks = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
                    times = np.bincount(_unpacked(codes, np.int32), minlength=len(words) + 1)[1:]
                    yield _entries(chunk, lang, _hash(np.full(1, zlib.crc32(lang.encode())), marks), buckets, {
                        "phrase": np.array(words, object), "times": times, "local": np.arange(1, len(words) + 1, dtype=np.int32)})[0]

    return relations.select("chunk", "lang", "codes", "words").mapInArrow(run, _ROW_KINDS)


def _frequent(rows: DataFrame, least: int) -> DataFrame:
    """Adds up the entries of each bucket and names the phrases that occur often enough. Relations pass through."""
    def run(table: pa.Table) -> pa.Table:
        held = pc.is_valid(table["codes"])
        relations, table = table.filter(held), table.filter(pc.invert(held))
        out = [_rows(_COUNTED, relations.num_rows, chunk=relations["chunk"].combine_chunks(), codes=relations["codes"].combine_chunks())]
        if not table.num_rows:
            return pa.Table.from_batches(out)
        bodies = table["body"].to_pylist()
        steps, times = [_unpacked(b[-1], np.int32) for b in bodies], np.concatenate([_unpacked(b[-2], np.int64) for b in bodies])
        sizes, words = np.array([len(x) for x in steps]), len(bodies[0]) == 3
        if words:
            langs = table["lang"].combine_chunks().dictionary_encode()
            phrases = pa.array([w for b in bodies for w in b[0].split(b"\n")], pa.binary()).cast(pa.string()).dictionary_encode()
            one, other = np.repeat(langs.indices.to_numpy(), sizes), phrases.indices.to_numpy()
        else:
            one = np.concatenate([np.cumsum(_unpacked(b[0], np.int64)) for b in bodies])
            other = np.concatenate([_unpacked(b[1], np.int64) for b in bodies])
        order = np.lexsort((other, one))
        new = np.r_[True, (one[order][1:] != one[order][:-1]) | (other[order][1:] != other[order][:-1])]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        first, f = order[new], np.add.reduceat(times[order], np.flatnonzero(new))
        often, name = f >= least, (table["bucket"][0].as_py() << 32) + np.arange(len(f))
        chunks, locals_, names = [], [], []
        for chunk, step, end in zip(table["chunk"].to_pylist(), steps, np.cumsum(sizes)):
            own = which[end - len(step):end]
            stays = often[own]
            if stays.any():
                chunks.append(chunk)
                locals_.append(_packed(np.diff(np.cumsum(step)[stays].astype(np.int32), prepend=np.int32(0))))
                names.append(_packed(np.diff(name[own[stays]], prepend=0)))
        at = first[often]
        parts = {"lang": pc.take(langs.dictionary, pa.array(one[at])), "phrase": pc.take(phrases.dictionary, pa.array(other[at]))} if words else {
            "left": one[at], "right": other[at]}
        out += [_rows(_COUNTED, len(chunks), chunk=chunks, local=locals_, names=names), _rows(_COUNTED, len(at), name=name[often], a=f[often], **parts)]
        return pa.Table.from_batches(out)

    return rows.drop("times", "words").groupBy("bucket").applyInArrow(run, _COUNTED_KINDS)


def _extended(relations: DataFrame, counted: DataFrame, buckets: int, more: bool) -> DataFrame:
    """Entries of R_(k+1), and with ``more`` the relation itself, from R_k and the names of its frequent phrases."""
    nothing = F.lit(None).cast("binary")
    relation = relations.where("codes is not null").select("chunk", "codes", nothing.alias("local"), nothing.alias("names"))
    answers = counted.where("local is not null").select("chunk", nothing.alias("codes"), "local", "names")

    def run(table: pa.Table) -> pa.Table:
        held = pc.is_valid(table["codes"])
        state, answer = table.filter(held), table.filter(pc.invert(held))
        if not state.num_rows or not answer.num_rows:
            return _ROW.empty_table()
        chunk, codes = state["chunk"][0].as_py(), _unpacked(state["codes"][0].as_py(), np.int32)
        name = np.full(int(codes.max(initial=0)) + 1, -1)
        for local, names in zip(answer["local"].to_pylist(), answer["names"].to_pylist()):
            name[np.cumsum(_unpacked(local, np.int32))] = np.cumsum(_unpacked(names, np.int64))
        stays = name[codes] >= 0
        p = np.flatnonzero(stays[:-1] & stays[1:])
        if not len(p):
            return _ROW.empty_table()
        found, which, times = np.unique(codes[p].astype(np.int64) << 32 | codes[p + 1], return_inverse=True, return_counts=True)
        left, right = name[found >> 32], name[found & 0xFFFFFFFF]
        entries, place = _entries(chunk, None, _hash(left, right), buckets, {"left": left, "right": right, "times": times}, (right, left))
        out = [entries]
        if more:
            longer = np.zeros(len(codes) + 1, np.int32)
            longer[p] = place[which]
            longer = longer[(longer > 0) | np.r_[False, longer[:-1] > 0]]  # runs, parted by breaks
            out.append(_rows(_ROW, 1, chunk=[chunk], bucket=[zlib.crc32(str(chunk).encode()) % buckets], codes=[_packed(longer)]))
        return pa.Table.from_batches(out)

    return relation.unionByName(answers).groupBy("chunk").applyInArrow(run, _ROW_KINDS)


def _put_together(phrases: DataFrame, parts: DataFrame, size: int) -> DataFrame:
    """Language, text and the counts of all cuts of phrases (name, left, right, a), from those of their parts, which are one word shorter."""
    carried = ["lang", "phrase", "a", *_CUTS]
    left = parts.select(F.col("name").alias("left"), F.struct(*carried).alias("_l"))
    right = parts.select(F.col("name").alias("right"), F.struct(*carried).alias("_r"))
    last = F.element_at(F.split("_r.phrase", " "), -1)
    cuts = {"r1": F.col("_r.a"), f"l{size - 1}": F.col("_l.a")}
    cuts |= {f"l{j}": F.col(f"_l.l{j}") for j in range(1, size - 1)} | {f"r{j}": F.col(f"_r.r{j - 1}") for j in range(2, size)}
    return phrases.select("name", "left", "right", "a").join(left, "left").join(right, "right").select(
        "name", F.col("_l.lang").alias("lang"), F.concat_ws(" ", "_l.phrase", last).alias("phrase"), "a",
        *[cuts.get(c, F.lit(None).cast("bigint")).alias(c) for c in _CUTS], F.lit(size).alias("size"))


def _exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST,
                 covered: int = COVERED, best: int | None = BEST, chunk_words: int = CHUNK, bucket_words: int = BUCKET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two to ``longest`` (4 at most) words of each language; all with ``best`` None."""
    slim = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    relations = store_once(_occurrences(slim, chunk_words), "setm-relation")
    sizes = store_once(relations.groupBy("lang").agg(F.sum("times").alias("n")), "setm-sizes")
    buckets = 1 + (sizes.agg(F.sum("n")).toPandas().iat[0, 0] or 0) // bucket_words  # from one number
    counted = store_once(_frequent(_words(relations, buckets), least), "setm-counted-1")
    parts = store_once(counted.where("name is not null").select(
        "name", "lang", "phrase", "a", *[F.lit(None).cast("bigint").alias(c) for c in _CUTS]), "setm-phrases-1")
    found = None
    for k in range(2, longest + 1):
        done = {relations._stored: relations, counted._stored: counted}
        relations = counted = store_once(_frequent(_extended(relations, counted, buckets, k < longest), least), f"setm-counted-{k}")
        parts = store_once(_put_together(counted.where("name is not null"), parts, k), f"setm-phrases-{k}")
        found = parts if found is None else found.unionByName(parts)
        for old in done.values():
            discard(old)
    discard(counted)
    found = found.drop("name")

    inner = F.expr("flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), i -> concat_ws(' ', slice(split(phrase, ' '), i, s)))))")
    inside = found.where("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer")).groupBy(
        "lang", "phrase").agg(F.max("longer").alias("longer"))
    own = found.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * _exact(F.col("longer")) < covered * _exact(F.col("a")))).drop("longer")
    cut = lambda i: F.struct(F.expr(
        f"cast({SCALE} as decimal(9,0)) * cast(a as decimal(20,0)) div (cast(l{i} as decimal(20,0)) + cast(r{i} as decimal(20,0)))").alias("score"),
        F.lit(i).alias("k"), F.col(f"l{i}").alias("l"), F.col(f"r{i}").alias("r"))
    cuts = F.array(*[F.when(F.col("size") > i, cut(i)) for i in range(1, LONGEST)])
    scored = own.withColumn("cut", F.array_min(cuts)).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").cast("long").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if best is not None:
        part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
        scored = scored.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(
            F.col("rank") <= best).drop("part", "rank")
        scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= best)
    else:
        scored = scored.withColumn("rank", F.lit(None).cast("long"))
    return scored.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH docs AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), pieces AS (
    SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS p FROM split
), grams AS (
    SELECT lang, size, array_to_string(w[p:p + size - 1], ' ') AS phrase
    FROM starts, (VALUES (1), (2), (3), (4)) sizes(size) WHERE p + size - 1 <= len(w)
), f AS (
    SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), n AS (
    SELECT lang, sum(len(w)) AS n FROM split GROUP BY lang
), candidates AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1
), parts AS (
    SELECT lang, size, a, w, s, unnest(range(1, size - s + 2)) AS i FROM candidates, (VALUES (2), (3)) sub(s) WHERE s < size
), inside AS (
    SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer FROM parts GROUP BY ALL
), kept AS (
    SELECT c.* FROM candidates c LEFT JOIN inside i ON c.lang = i.lang AND c.phrase = i.phrase
    WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * c.a
), cuts AS (
    SELECT k.lang, k.phrase, k.a, k.size, cut, array_to_string(k.w[:cut], ' ') AS head, array_to_string(k.w[cut + 1:], ' ') AS tail
    FROM kept k, (VALUES (1), (2), (3)) c(cut) WHERE cut < k.size
), scored AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, c.cut, (2000000::HUGEINT * c.a) // (x.f + y.f)::HUGEINT AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest
)
SELECT r.lang, r.rank::BIGINT AS rank, r.phrase, r.a::BIGINT AS a, r.l::BIGINT AS l, r.r::BIGINT AS r, n.n::BIGINT AS n, r.score::BIGINT AS score
FROM ranked r JOIN n ON n.lang = r.lang WHERE r.rank <= 2000
"""
