"""Benchmark decontamination by an FM-index per training shard.

A shard is a run of whole documents of about ``SHARD`` words. Its words are
numbered by the benchmark's vocabulary; a word that no item has ends a run, as
nothing can be found across it, and runs shorter than the shortest window are
left out. The rest is indexed: suffix array, Burrows-Wheeler transform, a
wavelet matrix for ranks, and suffix positions sampled at every ``SAMPLE``-th
place and at run starts. All windows of the benchmark are searched backwards
at once, one word a step; the rows that remain are walked to the next sampled
position, which locates them. Occurrences merge into spans to remove.

No shuffle: documents are read once, and each row carries its own result. The
benchmark reaches the tasks in blocks of at most ``BLOCK`` words (plus one
segment; long items are cut into overlapping segments), each block broadcast
and searched by one more step of the same stage, so neither side is bounded.
An index holds at most ``SHARD`` words; longer documents are indexed in slices
that overlap by a window.

Defined results: null text has no words; rows that repeat an id are documents
of their own; items with one id are one item, a null id counts as the empty
string; items without words have no window; without a benchmark nothing is
hit; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

#: Words of a window.
WINDOW = 10
SHARD = 1_000_000
SAMPLE = 16
BLOCK = 1_000_000
SEGMENT = 10_000

#: Bytes A to Z in lower case; digits, letters and all bytes of other scripts make words.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_PLAIN).split()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes by prefix doubling; each break (0) is smaller than all words and unlike any other break."""
    n, breaks = len(text), text == 0
    rank = np.where(breaks, np.cumsum(breaks) - 1, text.astype(np.int64) + int(breaks.sum()))
    step, wide = 1, max(n, int(rank.max(initial=0)) + 1) + 1
    while True:
        key = rank * wide
        key[:n - step] += rank[step:] + 1
        order = np.argsort(key)
        ordered = key[order]
        names = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]])
        if n == 0 or names[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = names
        step *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit of the symbols a level."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = []
        for shift in reversed(range(max(1, (symbols - 1).bit_length()))):
            bits = (sequence >> shift) & 1
            ones = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(bits, out=ones[1:])
            self.levels.append((shift, ones, len(sequence) - int(ones[-1])))
            sequence = np.concatenate([sequence[bits == 0], sequence[bits == 1]])
        self.starts = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for shift, ones, zeros in self.levels:
            before = ones[place]
            place = np.where((symbol >> shift) & 1, zeros + before, place - before)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self._down(symbol, place) - self.starts[symbol]


class FMIndex:
    """Full-text index of runs of words, numbered 1 to ``symbols`` - 1, each run ended by a 0."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = SAMPLE):
        order = suffix_array(text)
        self.bwt = text[order - 1]
        self.tree = WaveletMatrix(self.bwt, symbols)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        kept = (order % sample == 0) | (self.bwt == 0)
        self.samples, self.sampled = order[kept], np.cumsum(kept)
        self.marked = kept

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, low, high): the rows of suffixes that begin with a window, for the windows that occur."""
        alive = np.arange(len(lengths))
        low, high = np.zeros(len(alive), np.int64), np.full(len(alive), len(self.bwt))
        for step in range(int(lengths.max(initial=0))):
            on = lengths[alive] > step
            w = alive[on]
            symbol = windows[w, lengths[w] - 1 - step]
            low[on] = self.smaller[symbol] + self.tree.rank(symbol, low[on])
            high[on] = self.smaller[symbol] + self.tree.rank(symbol, high[on])
            left = low < high
            alive, low, high = alive[left], low[left], high[left]
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, each walked back to a sampled one."""
        out, open_, walked = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(open_):
            there = self.marked[rows]
            out[open_[there]] = self.samples[self.sampled[rows[there]] - 1] + walked
            open_, rows = open_[~there], rows[~there]
            symbol = self.bwt[rows]
            rows = self.smaller[symbol] + self.tree.rank(symbol, rows)
            walked += 1
        return out


class Windows:
    """A block of the benchmark: its vocabulary, its distinct windows and the items of each."""

    def __init__(self, segments: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.names, self.items, found = {}, {}, {}
        for item, words in segments:
            number = self.items.setdefault(item, len(self.items))
            codes = tuple(self.names.setdefault(w, len(self.names) + 1) for w in words)
            for i in range(max(1, len(codes) - window + 1) if codes else 0):
                found.setdefault(codes[i:i + window], set()).add(number)
        self.items = list(self.items)
        self.lengths = np.array([len(w) for w in found], np.int64)
        self.codes = np.zeros((len(found), window), np.int32)
        for row, w in enumerate(found):
            self.codes[row, :len(w)] = w
        self.first = np.cumsum([0, *map(len, found.values())])
        self.owner = np.array(list(chain.from_iterable(map(sorted, found.values()))), np.int64)

    def occurrences(self, codes: np.ndarray, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of all occurrences in numbered words, 0 for words that the benchmark lacks."""
        nothing = np.empty(0, np.int64)
        if not len(self.lengths):
            return nothing, nothing
        inside = np.r_[False, codes != 0, False]
        starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
        long = ends - starts >= self.lengths.min()
        edge = np.zeros(len(codes) + 2, np.int32)
        edge[starts[long]] += 1
        edge[ends[long] + 1] -= 1  # a run and the break behind it
        places = np.flatnonzero(np.cumsum(edge) > 0)
        text = np.r_[codes, 0][places]
        windows, positions = [nothing], [nothing]
        for at in range(0, len(text), shard):
            part = np.r_[text[at:at + shard + self.codes.shape[1] - 1], 0]
            index = FMIndex(part, len(self.names) + 1)
            window, low, high = index.search(self.codes, self.lengths)
            times = high - low
            rows = np.repeat(low - np.cumsum(np.r_[0, times[:-1]]), times) + np.arange(times.sum())
            windows.append(np.repeat(window, times))
            positions.append(places[at + index.locate(rows)])
        return np.concatenate(windows), np.concatenate(positions)


def _spans(hit: np.ndarray) -> np.ndarray:
    edges = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    return edges.reshape(-1, 2)


def _segments(benchmark: DataFrame, window: int, block_words: int, segment: int) -> DataFrame:
    """(block, item, words): items cut into segments that overlap by a window, dealt into blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                for at in range(0, max(len(words) - window + 1, min(len(words), 1)), segment):
                    part = words[at:at + segment + window - 1]
                    if held and held + len(part) > block_words:
                        block, held = block + 1, 0
                    held += len(part)
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([item], pa.string()),
                                                      pa.array([b" ".join(part)], pa.binary())], names=["block", "item", "words"])

    return benchmark.mapInArrow(run, "block bigint, item string, words binary")


def _searched(docs: DataFrame, id_kind: str, block, shard: int, last: bool) -> DataFrame:
    """One block searched in documents (doc_id, text, hits, items): hits are spans of words; the last step turns them into the result."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def shard_result(batches: list[pa.RecordBatch], codes: list[np.ndarray]) -> pa.RecordBatch:
        spec = block.value
        held = pa.Table.from_batches(batches).combine_chunks()
        sizes = np.array([len(c) for c in codes], np.int64)
        first = np.cumsum(np.r_[0, sizes + 1])  # a break behind every document
        line = np.zeros(int(first[-1]), np.int32)
        for c, at in zip(codes, first):
            line[at:at + len(c)] = c
        window, position = spec.occurrences(line, shard)
        edge = np.zeros(len(line) + 1, np.int32)
        np.add.at(edge, position, 1)
        np.add.at(edge, position + spec.lengths[window], -1)
        row = np.searchsorted(first, position, "right") - 1
        pairs = np.unique(np.stack([row, window], 1), axis=0)
        own = [set(x) for x in held["items"].to_pylist()]
        for r, w in pairs.tolist():
            own[r].update(spec.items[o] for o in spec.owner[spec.first[w]:spec.first[w + 1]])
        for r, hits in enumerate(held["hits"].to_pylist()):
            for h in hits:
                edge[first[r] + h["start"]] += 1
                edge[first[r] + h["end"]] -= 1
        hit = np.cumsum(edge[:-1]) > 0
        spans = [()] * len(sizes)
        for r in np.unique(np.searchsorted(first, np.flatnonzero(hit), "right") - 1):
            spans[r] = _spans(hit[first[r]:first[r] + sizes[r]]).tolist()
        items = pa.array([sorted(x) for x in own], pa.list_(pa.string()))
        if not last:
            return pa.RecordBatch.from_arrays(
                [held["doc_id"].combine_chunks(), held["text"].combine_chunks(),
                 pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], span), items], names=["doc_id", "text", "hits", "items"])
        texts, out = held["text"], []
        for r, found in enumerate(spans):
            places = [m.span() for m in _WORD.finditer(texts[r].as_py())] if found else ()
            out.append([{"start": places[a][0], "end": places[b - 1][1]} for a, b in found])
        n_hit = [sum(b - a for a, b in x) for x in spans]
        ids = held["doc_id"].combine_chunks()
        return pa.RecordBatch.from_arrays([ids, pa.array(sizes), pa.array(n_hit, pa.int64()), pa.array(out, span), items],
                                          names=["doc_id", "n_words", "n_hit", "spans", "items"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, codes, total = block.value.names.get, [], [], 0
        for batch in batches:
            begin = 0
            for i, text in enumerate(batch.column(1)):
                words = words_of(text.as_py())
                codes.append(np.fromiter(map(number, words, repeat(0)), np.int32, len(words)))
                total += len(words)
                if total >= shard:
                    yield shard_result([*held, batch.slice(begin, i + 1 - begin)], codes)
                    begin, held, codes, total = i + 1, [], [], 0
            if begin < batch.num_rows:
                held.append(batch.slice(begin))
        if held:
            yield shard_result(held, codes)

    span_kind = "array<struct<start:bigint,end:bigint>>"
    return docs.mapInArrow(run, f"doc_id {id_kind}, n_words bigint, n_hit bigint, spans {span_kind}, items array<string>" if last
                           else f"doc_id {id_kind}, text string, hits {span_kind}, items array<string>")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, shard: int = SHARD, block_words: int = BLOCK,
                  segment: int = SEGMENT) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans to remove (code points, end exclusive), items (ids as text, sorted)."""
    spark = docs.sparkSession
    listed = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).alias("text"))
    cut = store(_segments(listed, window, block_words, segment), "fm-windows")
    blocks = [r.block for r in cut.select("block").distinct().orderBy("block").collect()] or [None]  # one number per BLOCK words or task
    no_hits = F.array().cast("array<struct<start:bigint,end:bigint>>")
    out = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), no_hits.alias("hits"),
                      F.array().cast("array<string>").alias("items"))
    kind = out.schema["doc_id"].dataType.simpleString()
    for b in blocks:
        rows = cut.where(F.col("block") == F.lit(b)).select("item", "words").toPandas()  # BLOCK words and one segment at most
        spec = Windows([(item, bytes(words).split()) for item, words in zip(rows["item"], rows["words"])], window)
        out = _searched(out, kind, spark.sparkContext.broadcast(spec), shard, b == blocks[-1])
    return out


ORACLE_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item, size, array_to_string(w[p:p + size - 1], ' ') AS phrase
    FROM (SELECT item, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM b WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT size FROM windows
), places AS (
    SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d
), grams AS (
    SELECT doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') AS phrase FROM places, sizes WHERE p + size - 1 <= len(w)
), found AS (
    SELECT doc_id, p, g.size, item FROM grams g JOIN windows x ON x.phrase = g.phrase AND x.size = g.size
), hits AS (
    SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS spot FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM found GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
