"""Secret scans: base patterns and compression novelty.

Base patterns are reported as they match. On top of them, strings near a
sensitive word are candidates, and each is measured by what it adds to the
compressed size of its surroundings: a zstandard compressor primed with a
dictionary of code and identifier words compresses the surrounding text with
and without the candidate. Words, paths and repeated strings cost little;
random key material costs nearly its own size and is reported as ``novel``.

Spans are code points, end exclusive. Defined results: null counts as the
empty text, which has no spans; an empty table gives an empty result; each row
is scanned by itself and whole; extra columns are ignored.
"""

from __future__ import annotations

import builtins
import hashlib
import keyword
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "novel")
#: The base patterns and the least length of what they catch.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run matches from its start, so this is each run of 24 or more
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

#: A sensitive word; candidates begin within ``NEAR`` code points behind it.
SENSITIVE = re.compile(
    r"passw(?:or)?d|passphrase|secret|token|credential|private.?key|api.?key|access.?key|auth|bearer|signature", re.I | re.A)
LEAST = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
NEAR = 48
#: Surrounding code points on either side, and marginal bytes per character from which a string is novel.
AROUND = 200
NOVEL = 0.62


@lru_cache(maxsize=1)
def _compressor() -> zstandard.ZstdCompressor:
    words = [*keyword.kwlist, *dir(builtins), *dir(str), *dir(dict), "password", "passphrase", "secret", "token", "credential",
             "private_key", "api_key", "access_key", "authorization", "bearer", "signature", "http://", "https://", "example.com",
             "localhost", "config", "import", "return", "function", "const", "string", "value", "username", "default"]
    primed = zstandard.ZstdCompressionDict("\n".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=6, dict_data=primed, write_content_size=False, write_checksum=False)


def marginal_bytes(text: str, start: int, end: int) -> int:
    """Compressed bytes that the span adds to its surroundings."""
    before, after = text[max(0, start - AROUND):start], text[end:end + AROUND]
    size = _compressor().compress
    return len(size((before + after + text[start:end]).encode("utf-8", "replace"))) - len(size((before + after).encode("utf-8", "replace")))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, in order."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _joined_spans(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the areas that the spans cover, in order and apart from each other."""
    starts, ends = [], []
    for start, _, end in spans:
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start), ends.append(end)
    return starts, ends


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the strings that begin within ``NEAR`` code points behind a sensitive word.

    Words and runs of candidate characters are both found once and in order.
    What a word or an earlier candidate has passed never counts again, so each
    run is left for good as soon as too little of it remains.
    """
    runs = CANDIDATE.finditer(text)
    run, done = next(runs, None), 0
    for word in SENSITIVE.finditer(text):
        while run is not None:
            start = max(run.start(), word.end(), done)
            if run.end() - start >= LEAST:
                if start > word.end() + NEAR:
                    break  # a later word may be near
                done = run.end()
                yield start, done
            run = next(runs, None)
        if run is None:
            return


def novel_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates near a sensitive word that the primed compressor cannot shorten; base spans aside."""
    found, (starts, ends) = [], _joined_spans(base)
    for a, b in candidates(text):
        at = bisect_right(ends, a)  # the first area that ends behind a
        if at < len(starts) and starts[at] < b:
            continue
        if marginal_bytes(text, a, b) >= NOVEL * (b - a):
            found.append((a, 3, b))
    return found


def scan(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all spans, in order."""
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + novel_spans(text, base))


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, spans as an array of (kind, start, end)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, "
                                "spans array<struct<kind:string,start:bigint,`end`:bigint>>")


def secret_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (text form)."""
    spans = secret_spans(docs, id_col, text_col)
    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    text = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return spans.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
