"""Byte-level BPE encoding and decoding over a given rank file.

Text is cut by the pre-token pattern; each pre-token is encoded by itself, in
two tiers. A minimal perfect hash over the vocabulary (hash, displace, verify)
resolves pre-tokens that are one token. The others merge: a heap holds the
ranks of adjacent pairs over doubly linked bytes, the lowest rank (leftmost
first) merges next, stale entries are skipped; n log n for any length.

A worker remembers recent pre-tokens up to a fixed number; that changes the
speed, never a result. Each text is encoded whole.

Defined results: null counts as the empty text and has no ids; empty tables
give empty results; rows are handled one by one, so repeats get equal ids;
extra columns are carried only where asked for.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens, and words, that a worker remembers for sure; twice as many at most.
REMEMBER = 100_000
#: Marks that are a match of their own behind letters.
MARKS = frozenset(".,;:!?")
SPACE_THEN_BLANK = re.compile(r" \s")
#: The code points with the Unicode property White_Space.
WHITE_SPACE = r"\t-\r \x85\xa0  -     　"


def read_ranks(path: str) -> list[bytes]:
    """Tokens in the order of their ranks."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    return [base64.b64decode(a) for a, b in sorted(pairs, key=lambda p: int(p[1]))]


def python_pattern(pattern: str) -> regex.Pattern:
    r"""The pattern with \s spelled out, as the two libraries differ in what it holds."""
    out, inside = [], False
    for piece in regex.findall(r"\\.|.", pattern):
        if piece == "[":
            inside = True
        elif piece == "]":
            inside = False
        out.append({"\\s": WHITE_SPACE if inside else f"[{WHITE_SPACE}]", "\\S": f"[^{WHITE_SPACE}]"}.get(piece, piece))
    return regex.compile("".join(out))


class PerfectHash:
    """Minimal perfect hash: n keys to 0..n-1, with the keys kept to verify.

    Keys fall into buckets by their hash; from the largest bucket on, each gets
    the first displacement that sends all its keys to free slots. A bucket of
    one key simply names a slot that is left over (as a negative number).
    """

    def __init__(self, keys: list[bytes], load: int = 3):
        self.keys, self.size, self.buckets = keys, len(keys), max(1, len(keys) // load)
        grouped: dict[int, list[tuple[int, int]]] = {}
        for i, key in enumerate(keys):
            h = xxhash.xxh3_64_intdigest(key)
            grouped.setdefault(h % self.buckets, []).append((h, i))
        self.shift, self.slots, taken = [0] * self.buckets, [0] * self.size, bytearray(self.size)
        for bucket, members in sorted(grouped.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:
                place = taken.index(0)
                self.shift[bucket], places = -1 - place, [place]
            else:
                d = 0
                while True:
                    places = [self._place(h, d) for h, _ in members]
                    if len(set(places)) == len(places) and not any(taken[p] for p in places):
                        break
                    d += 1
                self.shift[bucket] = d
            for p, (_, i) in zip(places, members):
                taken[p], self.slots[p] = 1, i

    def _place(self, h: int, d: int) -> int:
        return ((h >> 20) * (2 * d + 1) + (d * d ^ h >> 41)) % self.size

    def get(self, key: bytes) -> int:
        """Number of the key, or -1."""
        if not self.size:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        i = self.slots[-1 - d if d < 0 else self._place(h, d)]
        return i if self.keys[i] == key else -1


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: a heap of pair ranks over doubly linked bytes."""
    n, get = len(piece), ranks.get
    bits = n.bit_length()
    low = (1 << bits) - 1  # a heap entry is rank, start and stop of the pair in one integer
    end = [*range(1, n + 1)]  # where the part that starts here ends; 0 once it is swallowed
    left = [*range(-1, n - 1)]
    heap = []
    for i in range(n - 1):
        if (r := get(piece[i:i + 2])) is not None:
            heap.append((r << bits | i) << bits | i + 2)
    heapify(heap)
    while heap:
        top = heappop(heap)
        stop, i = top & low, top >> bits & low
        mid = end[i]
        if not mid or mid >= n or end[mid] != stop:
            continue
        end[i], end[mid] = stop, 0
        if stop < n:
            left[stop] = i
            if (r := get(piece[i:end[stop]])) is not None:
                heappush(heap, (r << bits | i) << bits | end[stop])
        if (j := left[i]) >= 0 and (r := get(piece[j:stop])) is not None:
            heappush(heap, (r << bits | j) << bits | stop)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


def pack(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class Memo(dict):
    """Remembers what ``make`` gave for the last keys, at most 2 * ``REMEMBER`` of them."""

    def __init__(self, make):
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= REMEMBER:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


class Codec:
    """Text to ids, packed as little-endian 32-bit numbers, and back."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.split = tokens, python_pattern(pattern).findall
        self.index = PerfectHash(tokens)
        self.ranks = {t: i for i, t in enumerate(tokens)}
        #: Known to hold for patterns in which a space only opens a match or belongs to a run of blanks.
        self.by_word = set(re.findall(r" .", pattern)) == {" ?"} and r"|\s+(?!\S)|\s+" in pattern
        self.piece = Memo(self._piece).__getitem__
        self.word = Memo(self._word).__getitem__

    def _piece(self, piece: str) -> bytes:
        raw = piece.encode("utf-8", "replace")
        found = self.index.get(raw)
        return pack([found] if found >= 0 else merged(raw, self.ranks))

    def _word(self, word: str) -> bytes:
        """A word with the space before it; letters, with or without one mark behind them, need no pattern."""
        if word.isalpha():
            return self._piece(" " + word)
        if word[-1:] in MARKS and word[:-1].isalpha():
            return self.word(word[:-1]) + self.piece(word[-1])
        return self.whole(" " + word)

    def whole(self, text: str) -> bytes:
        """All matches of the pattern, one after the other."""
        return b"".join(map(self.piece, self.split(text)))

    def encode(self, text: str | None) -> bytes:
        """A space between two other characters always begins a match, so words can be looked up one by one.

        That holds where no blank follows a space; other texts are matched in one go.
        """
        if not text:
            return b""
        if not self.by_word or SPACE_THEN_BLANK.search(text):
            return self.whole(text)
        first, *words = text.split(" ")
        if not words:
            return self.whole(text)
        if not words[-1]:  # a space that ends the text
            words.pop()
            return self.whole(first) + b"".join(map(self.word, words)) + self.piece(" ")
        return self.whole(first) + b"".join(map(self.word, words))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


_CODECS: dict[tuple[int, str], Codec] = {}


def _codec(shared, pattern: str) -> Codec:
    """One codec per worker process."""
    key = (shared.value["digest"], pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(shared.value["tokens"], pattern)
    return _CODECS[key]


def _mapped(df: DataFrame, vocabulary: str, pattern: str, col: str, carry: tuple[str, ...], made: str, make) -> DataFrame:
    tokens = read_ranks(vocabulary)  # a vocabulary's size is fixed, whatever the corpus
    shared = df.sparkSession.sparkContext.broadcast({"digest": xxhash.xxh3_64_intdigest(b"\n".join(tokens)), "tokens": tokens})
    slim = df.select(F.col(col).alias("_value"), *carry)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        for batch in batches:
            columns = make(codec, (x.as_py() for x in batch.column(0)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns.values()], names=[*batch.schema.names[1:], *columns])

    return slim.mapInArrow(run, ", ".join([*kinds, made]))


def encode(df: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns and ids (array of long)."""
    def make(codec, texts):
        return {"ids": pa.array([np.frombuffer(codec.encode(t), "<u4").astype(np.int64) for t in texts], pa.list_(pa.int64()))}
    return _mapped(df, vocabulary, pattern, text_col, carry, "ids array<bigint>", make)


def decode(df: DataFrame, vocabulary: str, pattern: str, ids_col: str = "ids", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns and decoded (binary); null ids count as none."""
    def make(codec, rows):
        return {"decoded": pa.array([codec.decode(np.array(ids or [], "<u4").tobytes()) for ids in rows], pa.binary())}
    return _mapped(df, vocabulary, pattern, ids_col, carry, "decoded binary", make)


def round_trip(df: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",),
               with_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass: the ``carry`` columns, n_tokens, ids_sha256, decoded_sha256; ``with_ids`` adds ids."""
    def make(codec, texts):
        counts, ids, back, all_ids = [], [], [], []
        for text in texts:
            packed = codec.encode(text)
            counts.append(len(packed) // 4)
            ids.append(hashlib.sha256(packed).hexdigest())
            back.append(hashlib.sha256(codec.decode(packed)).hexdigest())
            if with_ids:
                all_ids.append(np.frombuffer(packed, "<u4").astype(np.int32))
        made = {"n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(ids, pa.string()),
                "decoded_sha256": pa.array(back, pa.string())}
        return made | ({"ids": pa.array(all_ids, pa.list_(pa.int32()))} if with_ids else {})
    return _mapped(df, vocabulary, pattern, text_col, carry,
                   "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids, make)
