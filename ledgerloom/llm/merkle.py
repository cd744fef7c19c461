"""Document fingerprints: Merkle trees over sections, paragraphs and sentences.

A text's lines are its paragraphs; a section ends at an empty line or behind a
paragraph whose hash says so, which keeps later sections as they are when an
earlier one grows. Leaves are the sentences of a paragraph; a sentence of more
than ``MOST`` code points is cut where a hash of the code points before says
so, so that leaves are bounded in texts without line breaks and full stops,
too. Every node hashes its children, so equal roots mean equal texts, and
walking down differing branches finds what changed.

The fingerprint is text: the root, then the first bytes of every leaf, grouped
by paragraph (;) and section (/). The likeness of two fingerprints is the share
of leaves that they have in common, 0 to 1.

``edited_fingerprints`` needs each row's successor by descending id. Rows are
range partitioned and sorted, so the successor is the next row of the same
task; only the last row of each task meets the first row of the next one in a
second, small join.

Defined results: null counts as the empty text (no leaves; two such are alike
in full, one and another text not at all); null ids come last; rows with one
id follow each other by hash of the text; a single row is its own successor;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import store

#: A section ends, on average, behind this many paragraphs; hex digits of a leaf in the fingerprint.
SECTION = 8
LEAF = 8
#: Code points of a leaf at most, and of a piece cut from a long sentence at least (but for its last one).
MOST = 96
LEAST = 48
#: A cut depends on so many code points before it; one place in ``CUT`` is one.
REACH = 6
CUT = 16


def _digest(data: bytes, person: bytes = b"") -> bytes:
    return hashlib.blake2b(data, digest_size=16, person=person).digest()


def _leaf(piece: str, person: bytes = b"") -> tuple[bytes, str]:
    return _digest(piece.encode("utf-8", "replace"), person), piece


def _places(text: str) -> list[int]:
    """Where long sentences may be cut: behind code points whose hash says so."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    mixed = np.zeros(len(points) - REACH + 1, np.uint32)
    for i in range(REACH):
        mixed = (mixed ^ points[i:i + len(mixed)]) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
    return (np.flatnonzero(mixed % CUT == 0) + REACH).tolist()


def _cut(text: str, start: int, end: int, places: list[int]) -> Iterator[tuple[bytes, str]]:
    """Leaves of a long sentence: pieces up to the first fitting place. All but the last are hashed apart from whole sentences."""
    while end - start > MOST:
        i = bisect_left(places, start + LEAST)
        stop = min(places[i] if i < len(places) else end, start + MOST)
        yield _leaf(text[start:stop], b"cut")
        start = stop
    yield _leaf(text[start:end])


def tree(text: str | None) -> tuple[str, list]:
    """(root, sections); a section is (hash, paragraphs), a paragraph (hash, leaves), a leaf (hash, text)."""
    sections, paragraphs, places, at = [], [], None, 0
    for line in (text or "").split("\n") if text else []:
        leaves = []
        for s in line.split(". "):
            if len(s) <= MOST:
                leaves.append(_leaf(s))
            else:
                places = _places(text) if places is None else places
                leaves.extend(_cut(text, at, at + len(s), places))
            at += len(s) + 2
        at -= 1  # a line ends with one code point, a sentence with two
        node = _digest(b"p" + b"".join(h for h, _ in leaves))
        paragraphs.append((node, leaves))
        if not line or node[0] % SECTION == 0:
            sections.append((_digest(b"s" + b"".join(h for h, _ in paragraphs)), paragraphs))
            paragraphs = []
    if paragraphs:
        sections.append((_digest(b"s" + b"".join(h for h, _ in paragraphs)), paragraphs))
    return _digest(b"r" + b"".join(h for h, _ in sections)).hex(), sections


def fingerprint(text: str | None) -> str:
    root, sections = tree(text)
    return root + ":" + "/".join(
        ";".join("".join(h.hex()[:LEAF] for h, _ in leaves) for _, leaves in paragraphs) for _, paragraphs in sections)


def _leaves(mark: str) -> Counter:
    body = mark.partition(":")[2].replace("/", "").replace(";", "")
    return Counter(body[i:i + LEAF] for i in range(0, len(body), LEAF))


def likeness(one: str, other: str) -> float:
    """Twice the shared leaves over all leaves of both."""
    if one == other:
        return 1.0
    a, b = _leaves(one), _leaves(other)
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 1.0


def differing(one: str | None, other: str | None) -> list[tuple[int, int, int]]:
    """Leaves of ``other`` (section, paragraph, sentence) in branches that ``one`` lacks; equal branches are not entered."""
    def walk(old: list, new: list, path: tuple) -> Iterator[tuple]:
        have = {h: children for h, children in old}
        rest = [c for h, c in old if h not in {x for x, _ in new}]
        for i, (h, children) in enumerate(new):
            if h in have:
                continue
            if isinstance(children, str):
                yield (*path, i)
            else:
                yield from walk([x for c in rest for x in c], children, (*path, i))
    return list(walk(tree(one)[1], tree(other)[1], ()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([fingerprint(t.as_py()) for t in batch.column(1)], pa.string())],
                names=["doc_id", "fingerprint"])

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def _edited(text: str, follower: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + follower[:half]


_RESULT = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_KINDS = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(text: str, own: str, follower: str, follower_mark: str) -> tuple:
    edited = _edited(text, follower)
    mark = fingerprint(edited)
    return (len(text), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), own, mark,
            likeness(own, mark), likeness(own, follower_mark))


def _arrays(rows: list[tuple]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return [pa.array([r[i] if r else None for r in rows], k) for i, k in enumerate(kinds)]


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    order = F.col("doc_id").desc_nulls_last()
    ranged = slim.repartitionByRange(order).sortWithinPartitions(order, F.xxhash64("text"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that have their successor here; the task's first and last row also with their text."""
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            id_kind = batch.schema.field(0).type
            ids, roles, texts, rows = [], [], [], []

            def put(doc, role, text, row):
                ids.append(doc), roles.append(role), texts.append(text), rows.append(row)

            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mark = fingerprint(text)
                if held is None:
                    put(doc, "head", text, None)
                else:
                    put(held[0], "row", None, _compared(held[1], held[2], text, mark))
                held = (doc, text, mark)
            yield _batch(id_kind, ids, roles, part, texts, rows)
        if held is not None:
            yield _batch(id_kind, [held[0]], ["tail"], part, [held[1]], [None])

    def _batch(id_kind, ids, roles, part, texts, rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, id_kind), pa.array(roles, pa.string()), pa.array([part] * len(ids), pa.int32()),
             pa.array(texts, pa.string()), *_arrays(rows)], names=["doc_id", "role", "part", "text", *_RESULT])

    done = store(ranged.mapInArrow(pairs, f"doc_id {kind}, role string, part int, text string, {_KINDS}"), "merkle-rows")
    heads = done.where("role = 'head'").select("part", F.col("text").alias("follower"))
    parts = done.where("role = 'head'").select("part")  # one number per task
    every = Window.orderBy("part")
    follows = parts.withColumn("first", F.min("part").over(Window.partitionBy(F.lit(0)))).select(
        "part", F.coalesce(F.lead("part").over(every), F.col("first")).alias("next"))
    seams = done.where("role = 'tail'").select("doc_id", "part", "text").join(follows, "part").join(
        heads.withColumnRenamed("part", "next"), "next").select("doc_id", "text", "follower")

    def join_seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_compared(a, fingerprint(a), b, fingerprint(b))
                    for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_arrays(rows)], names=["doc_id", *_RESULT])

    return done.where("role = 'row'").select("doc_id", *_RESULT).unionByName(
        seams.mapInArrow(join_seams, f"doc_id {kind}, {_KINDS}"))
