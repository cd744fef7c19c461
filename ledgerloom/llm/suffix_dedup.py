"""Removal of repeated passages by a common-prefix-aware distributed merge sort of suffixes.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else
too, in the same document or another.

1. Anchors. Of all ``length // 2``-byte strings in a window of ``length`` bytes
   the one with the smallest hash is an anchor. Equal windows have the same
   anchor at the same place, so two windows can only be equal if they meet at
   an anchor; one position in about fifty is one. As in prefix-doubling string
   sorting, hashes go out first: a suffix whose anchor is unique is not sent
   at all, and one whose whole neighbourhood (every window around its anchor)
   is found twice is settled. What is left are the edges of repeats.
2. Runs. Each task sorts the suffixes at its remaining anchors and sends them
   as front-coded runs: the length of the prefix shared with the suffix before,
   and the rest. One representative of each settled neighbourhood goes along.
3. Merge. A task merges the runs of its share with a loser tree that keeps for
   every loser the prefix it shares with the winner: a longer shared prefix
   decides without looking at a byte, and comparisons begin behind it. The
   sorted order with its shared prefixes gives the suffixes that share an
   anchor; among those, every window is matched by what lies before the anchor
   and what follows.

Exact but for collisions of 64-bit hashes. Defined results: null counts as the
empty text; texts shorter than ``length`` lose nothing; rows that repeat id and
text are occurrences of each other; null ids are carried; empty tables give
empty results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store
from .ngram_join import mix

LENGTH = 200
#: Suffixes that a task holds before it sends its runs, or compares their windows.
RUN = 20_000
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
_BYTES = np.random.default_rng(5).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS["up"]) < n:
        size = max(n, 2 * len(_POWERS["up"]), 4096)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over each ``width`` neighbours, by doubling."""
    done, out = 1, x
    while done < width:
        step = min(done, width - done)
        out = op(out[:-step], out[step:])
        done += step
    return out


def anchors(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, hashes and neighbourhood hashes of a text's anchors."""
    n, k = len(data), length // 2
    if n < length:
        empty = np.empty(0, np.uint64)
        return np.empty(0, np.int64), empty, empty
    up, down = _powers(n + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[np.frombuffer(data, np.uint8)] * up[:n], dtype=np.uint64)))
    grams = mix((total[k:] - total[:-k]) * down[:n - k + 1], 3)
    width = length - k + 1
    least = _sliding(grams, width, np.minimum)  # of the window that starts here
    padded = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    at = np.flatnonzero(_sliding(padded, width, np.maximum) == grams)
    first, last = np.maximum(at - (length - k), 0), np.minimum(at + length, n)
    around = mix((total[last] - total[first]) * down[first] + (at - first).astype(np.uint64) * np.uint64(1000003) + (last - at).astype(np.uint64), 4)
    return at, grams[at], around


def _batch(columns: dict[str, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns.values()], names=list(columns))


def _anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid, pos, gram, around = [], [], [], []
            for row, text in zip(batch.column(0).to_numpy(), batch.column(1)):
                at, g, c = anchors((text.as_py() or "").encode("utf-8", "replace"), length)
                rid.append(np.full(len(at), row)), pos.append(at), gram.append(g), around.append(c)
            if rid:
                yield _batch({"gram": (np.concatenate(gram).view(np.int64), pa.int64()), "around": (np.concatenate(around).view(np.int64), pa.int64()),
                              "rid": (np.concatenate(rid), pa.int64()), "pos": (np.concatenate(pos), pa.int64())})

    return texts.select("rid", "text").mapInArrow(run, "gram bigint, around bigint, rid bigint, pos bigint")


def met_kinds(gram, around, rid, pos, last: bool):
    """(kept, chosen): what the next batch needs, and rid, pos and kind of the anchors found more than once.

    Rows come sorted by anchor and neighbourhood. Unless this is the last batch
    its last neighbourhood may go on: what is kept of it is its first row, as
    long as that is undecided, and marks (pos -1) for what has gone before.
    """
    new_run = np.r_[True, (gram[1:] != gram[:-1]) | (around[1:] != around[:-1])]
    new_group = np.r_[True, gram[1:] != gram[:-1]]
    run_no, group_no = np.cumsum(new_run) - 1, np.cumsum(new_group) - 1
    many, twice = np.bincount(group_no[new_run])[group_no] > 1, np.bincount(run_no)[run_no] > 1
    kind = np.where(twice, np.where(new_run & many, 2, 1), np.where(many, 0, 3))
    keep, kept = (kind != 3) & (pos >= 0), [x[:0] for x in (gram, around, rid, pos)]
    if not last:
        start = int(np.flatnonzero(new_run)[-1])
        g, a, seen_twice = gram[start], around[start], bool(twice[start])
        if not (many[start] and seen_twice):
            keep[start] = False
        rows = [] if keep[start] else [(g, a, rid[start], pos[start])]
        marks = [(g, a, 0, -1)] * (2 - len(rows)) if seen_twice else []
        before = [(g, a - 1, 0, -1)] if many[start] else []
        kept = list(np.array(before + rows + marks, np.int64).T)
    return kept, (rid[keep], pos[keep], kind[keep])


def _met(rows: DataFrame) -> DataFrame:
    """(rid, pos, kind) of the anchors found more than once: 0 open, 1 settled, 2 settled and standing for its neighbourhood."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 4

        def batch_of(rid, pos, kind):
            return _batch({"rid": (rid, pa.int64()), "pos": (pos, pa.int64()), "kind": (kind.astype(np.int32), pa.int32())})

        for batch in batches:
            if batch.num_rows:
                held, chosen = met_kinds(*(np.concatenate((h, c.to_numpy())) for h, c in zip(held, batch.columns)), False)
                yield batch_of(*chosen)
        if len(held[0]):
            yield batch_of(*met_kinds(*held, True)[1])

    return rows.repartition("gram").sortWithinPartitions("gram", "around").mapInArrow(run, "rid bigint, pos bigint, kind int")


# --- runs ----------------------------------------------------------------

def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which the first ``known`` bytes need no look."""
    end = min(len(a), len(b))
    if a[known:end] == b[known:end]:
        return end
    low, high = known, end  # halves of slices compare fast
    while high - low > 8:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    while a[low] == b[low]:
        low += 1
    return low


def front_coded(entries: list[tuple[bytes, bytes]]) -> bytes:
    """A sorted run: for each (suffix, payload) the shared prefix, the lengths, and the rest."""
    out, before = [], b""
    for suffix, payload in sorted(entries):
        same = shared(before, suffix)
        out += [struct.pack("<HHH", same, len(suffix) - same, len(payload)), suffix[same:], payload]
        before = suffix
    return b"".join(out)


def read_run(run: bytes) -> Iterator[tuple[int, bytes, bytes]]:
    """(prefix shared with the suffix before, suffix, payload)."""
    at, before = 0, b""
    while at < len(run):
        same, rest, extra = struct.unpack_from("<HHH", run, at)
        at += 6
        before = before[:same] + run[at:at + rest]
        yield same, before, run[at + rest:at + rest + extra]
        at += rest + extra


def merge(runs: list[bytes]) -> Iterator[tuple[int, bytes, bytes]]:
    """All suffixes in order, each with the prefix it shares with the one before.

    Inner nodes of the tree hold the losers. Each entry knows the prefix that
    it shares with the last winner that passed it, so of two entries the one
    that shares more is smaller, and only equals are compared, from there on.
    """
    sources = [read_run(r) for r in runs]
    size = 1
    while size < len(sources):
        size *= 2
    now = [next(s, None) for s in sources] + [None] * (size - len(sources))
    known = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser learns what it shares with the winner."""
        x, y = now[a], now[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        same = shared(x[1], y[1], known[a])
        if x[1][same:same + 1] <= y[1][same:same + 1]:
            known[b] = same
            return a, b
        known[a] = same
        return b, a

    losers = [0] * size
    level = list(range(size))
    node = size // 2
    while len(level) > 1:
        played = [play(level[i], level[i + 1]) for i in range(0, len(level), 2)]
        for i, (_, lost) in enumerate(played):
            losers[node + i] = lost
        level = [won for won, _ in played]
        node //= 2
    winner = level[0]
    while now[winner] is not None:
        yield known[winner], now[winner][1], now[winner][2]
        now[winner] = following = next(sources[winner], None)
        known[winner] = following[0] if following else 0
        place = (winner + size) // 2
        while place:
            won, lost = play(winner, losers[place])
            losers[place], winner = lost, won
            place //= 2


# --- windows around one anchor --------------------------------------------

def _padded(parts: list[bytes], half: int) -> np.ndarray:
    return np.frombuffer(b"".join(x[:half].ljust(half, b"\0") for x in parts), np.uint8).reshape(len(parts), half)


def repeated_windows(groups: np.ndarray, before: list[bytes], after: list[bytes], half: int) -> np.ndarray:
    """For each member and each number a of bytes before the anchor: does the window occur in another member of its group?

    ``before`` are the bytes up to the anchor, ``after`` those behind its
    ``half`` bytes; a window takes the last a of one and the first half - a of
    the other. Window hashes move on by one byte at either end for each a.
    """
    left, right = _padded([x[::-1] for x in before], half), _padded(after, half)
    lefts, rights = np.array([len(x) for x in before]), np.array([len(x) for x in after])
    up = _powers(2 * half + 1)[0]
    own = mix(groups.astype(np.uint64), 9)
    back, front = np.zeros(len(groups), np.uint64), own.copy()
    for b in range(half):
        front += _BYTES[right[:, b]] * up[half + 1 + b]
    out = np.zeros((len(groups), half + 1), bool)
    for a in range(half + 1):
        if a:
            back += _BYTES[left[:, a - 1]] * up[a]
            front -= _BYTES[right[:, half - a]] * up[2 * half + 1 - a]
        fits = np.flatnonzero((lefts >= a) & (rights >= half - a))
        if len(fits) > 1:
            window = mix(back[fits], 8) + front[fits]
            order = np.argsort(window, kind="stable")
            same = window[order][1:] == window[order][:-1]
            out[fits[order], a] = np.r_[same, False] | np.r_[False, same]
    return out


def _runs(texts: DataFrame, length: int, shares: int) -> DataFrame:
    """(share, run) from rows (rid, text, met)."""
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        count = 0

        def send():
            return _batch({"share": (list(held), pa.int32()), "run": ([front_coded(x) for x in held.values()], pa.binary())})

        for batch in batches:
            for rid, text, met in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode("utf-8", "replace")
                for m in met:
                    if m["kind"] == 1:
                        continue
                    p = m["pos"]
                    suffix = data[p:p + length]
                    share = int.from_bytes(hashlib.blake2b(suffix[:half], digest_size=4).digest(), "little") % shares
                    held.setdefault(share, []).append((suffix, struct.pack("<qqB", rid, p, m["kind"]) + data[max(0, p - half):p]))
                    count += 1
            if count >= RUN:
                yield send()
                held, count = {}, 0
        if held:
            yield send()

    return texts.mapInArrow(run, "share int, run binary")


def _edges(runs: DataFrame, length: int) -> DataFrame:
    """(rid, start, end) of the repeated strings at open anchors."""
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans(members):
            """Repeated strings at the open anchors among the members (group, suffix, payload)."""
            hit = repeated_windows(np.array([m[0] for m in members]), [m[2][17:] for m in members], [m[1][half:] for m in members], half)
            out = []
            for (_, _, payload), row in zip(members, hit):
                rid, pos, kind = struct.unpack_from("<qqB", payload)
                if kind == 0 and row.any():
                    a = np.flatnonzero(row)
                    cuts = np.flatnonzero(np.diff(a) > 1) + 1
                    for first, end in zip([0, *cuts], [*cuts, len(a)]):
                        out.append((rid, pos - int(a[end - 1]), pos - int(a[first]) + length))
            return _batch({name: ([s[i] for s in out], pa.int64()) for i, name in enumerate(("rid", "start", "end"))})

        def merged(blobs):
            number, members = 0, []
            for same, suffix, payload in merge(blobs):
                if same < half:  # another anchor
                    number += 1
                    if len(members) >= RUN:
                        yield spans(members)
                        members = []
                members.append((number, suffix, payload))
            if members:
                yield spans(members)

        now, blobs = None, []
        for batch in batches:
            for share, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if share != now and blobs:
                    yield from merged(blobs)
                    blobs = []
                now = share
                blobs.append(blob)
        if blobs:
            yield from merged(blobs)

    return runs.repartition("share").sortWithinPartitions("share").mapInArrow(run, "rid bigint, start bigint, `end` bigint")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): texts has rid, doc_id, text; spans has rid and an array of repeated (start, end) in bytes, not yet joined."""
    half = length // 2
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "rid", F.xxhash64("doc_id", "text"))
    met = store(_met(_anchor_rows(texts, length)), "repeat-anchors")
    open_rows = met.where("kind != 1").groupBy("rid").agg(F.collect_set(F.struct("pos", "kind")).alias("met"))  # bounded by the text
    shares = max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    wanted = texts.select("rid", "text").join(open_rows.hint("merge"), "rid")
    edges = _edges(_runs(wanted.select("rid", "text", "met"), length, shares), length)
    settled = met.where("kind != 0").select("rid", F.greatest(F.col("pos") - (length - half), F.lit(0)).alias("start"),
                                            (F.col("pos") + length).alias("end"))
    spans = settled.unionByName(edges).groupBy("rid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return texts, spans


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (spans in bytes), kept (bytes)."""
    texts, spans = repeats(docs, id_col, text_col, length)
    joined = texts.join(store(spans, "repeat-spans").hint("merge"), "rid", "left").select("doc_id", "text", "spans")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data, runs = text.encode("utf-8", "replace"), []
                for s, e in sorted((s["start"], min(s["end"], len(data))) for s in spans or []):
                    if runs and s <= runs[-1][1]:
                        runs[-1][1] = max(e, runs[-1][1])
                    else:
                        runs.append([s, e])
                at, kept = 0, []
                for s, e in runs:
                    kept.append(data[at:s])
                    at = e
                kept = b"".join([*kept, data[at:]])
                out.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(),
                            [{"start": s, "end": e} for s, e in runs], kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([o[i] for o in out], k) for i, k in enumerate(kinds))],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
                                  "removed array<struct<start:bigint,`end`:bigint>>, kept binary")
