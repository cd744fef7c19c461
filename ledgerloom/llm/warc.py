"""Legacy archives (ARC) to WARC, with revisit records.

``write_arcs`` makes ARC archives of version 1 or 2; ``read_arcs`` parses them:
the version block at the head of an archive names the fields of its record
lines, and the declared length of each record says where it ends.
``convert`` turns every record into its WARC equivalent: a record id derived
from address, date and content, an ISO timestamp, the record type, and base32
SHA-1 digests of payload and block. Records whose payload equals another's of
at least ``min_revisit_bytes`` bytes revisit the one with the smallest key and
carry no payload. ``read_warcs`` reads the result.

An archive is one file of about ``ARCHIVE_BYTES`` before compression, written
and read by Spark's own sources, so any store that Spark reaches will do. Only
(digest, key, place) is grouped to find revisits; payloads stay in their
compressed archives, and the decisions join to whole archives by path.

Defined results: null payload is empty, null address is "-"; blanks in an
address are escaped; a null key is carried as no key and sorts last among
equal payloads; records that repeat a key each count, and of equal ones all
but one are revisits; an empty table gives empty results; extra columns are
ignored. A record longer than an archive gets an archive of its own.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_path, store

ARCHIVE_BYTES = 8 << 20
#: The field lines of the two versions, and the date that pages without one get.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
DATE = "20240101000000"
#: Header of the archived reply that carries the row's key.
KEY = "X-Archive-Key"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- ARC -----------------------------------------------------------------

def arc_record(version: int, url: str | None, kind: str, content: bytes, date: str = DATE, name: str = "-", offset: int = 0) -> bytes:
    values = {"URL": re.sub(r"\s", lambda m: "%%%02X" % (ord(m[0]) & 255), url or "-"), "IP-address": "0.0.0.0",
              "Archive-date": date, "Content-type": kind, "Result-code": "200", "Checksum": digest(content), "Location": "-",
              "Offset": str(offset), "Filename": name, "Archive-length": str(len(content))}
    return " ".join(values[f] for f in FIELDS[version].split()).encode("utf-8", "replace") + b"\n" + content + b"\n"


def arc_head(version: int, name: str) -> bytes:
    block = f"{version} 0 archive\n{FIELDS[version]}\n".encode()
    return f"filedesc://{name} 0.0.0.0 {DATE} text/plain {len(block)}\n".encode() + block + b"\n"


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of one archive, each a dict of its line's fields with ``content`` and ``offset``.

    The first record is the version block; its last line names the fields of
    all others. Lines are split from the right, as an address may hold spaces.
    """
    at, fields = 0, FIELDS[1].split()
    while at < len(data):
        if data[at:at + 1] in b"\r\n":  # blank lines between records
            at += 1
            continue
        stop = data.index(b"\n", at)
        line = data[at:stop].decode("utf-8", "replace").rstrip("\r")
        parts = line.rsplit(" ", len(fields) - 1) if not line.startswith("filedesc:") else line.split(" ")
        head = dict(zip(FIELDS[1].split() if line.startswith("filedesc:") and len(parts) == 5 else fields, parts))
        length = int(parts[-1])
        content = data[stop + 1:stop + 1 + length]
        if len(content) != length:
            raise ValueError(f"record at {at} declares {length} bytes and has {len(content)}")
        if line.startswith("filedesc:"):
            named = [x for x in content.decode("utf-8", "replace").splitlines() if x.startswith("URL ")]
            fields = named[0].split() if named else fields
        yield head | {"content": content, "offset": at}
        at = stop + 1 + length


def split_reply(content: bytes) -> tuple[bytes, bytes]:
    """Reply header (with its empty line) and payload; a record without a reply header is all payload."""
    if content.startswith(b"HTTP/"):
        head, gap, body = content.partition(b"\r\n\r\n")
        return (head + gap, body) if gap else (content, b"")
    return b"", content


def header(head: bytes, name: str) -> str | None:
    m = re.search(rf"(?im)^{re.escape(name)}: *(.*?)\r?$".encode(), head)
    return m[1].decode("utf-8", "replace") if m else None


# --- WARC ----------------------------------------------------------------

def record_type(url: str, content: bytes) -> str:
    if url.startswith("filedesc:"):
        return "warcinfo"
    return "response" if content.startswith(b"HTTP/") else "resource"


def iso(date: str) -> str:
    """14-digit date to ISO; digits that are missing are the earliest possible."""
    d = re.sub(r"\D", "", date)[:14]
    d += "19700101000000"[len(d):]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(url: str, date: str, key: str, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, ' '.join((url, date, key, payload_digest)))}>"


def warc_record(arc: dict, refers: tuple[str | None, str] | None = None) -> bytes:
    """The WARC equivalent of an ARC record; ``refers`` (key, record id) makes it a revisit."""
    content, url, date = arc["content"], arc["URL"], arc["Archive-date"]
    head, payload = split_reply(content)
    kind, sha = record_type(url, content), digest(payload)
    block = content if refers is None else head
    lines = [("WARC-Type", "revisit" if refers else kind),
             ("WARC-Record-ID", record_id(url, date, header(head, KEY) or "", sha)), ("WARC-Date", iso(date))]
    if kind == "warcinfo":
        lines += [("WARC-Filename", url.removeprefix("filedesc://")), ("Content-Type", "text/plain")]
    else:
        lines += [("WARC-Target-URI", url), ("WARC-IP-Address", arc["IP-address"]), ("WARC-Payload-Digest", f"sha1:{sha}"),
                  ("Content-Type", "application/http; msgtype=response" if head else arc["Content-type"])]
    if refers:
        lines += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", refers[1])]
        if refers[0] is not None:
            lines.append(("X-Refers-To-Key", refers[0]))
    lines += [("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def parse_warc(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of each record, by declared length."""
    at = 0
    while at < len(data):
        if data[at:at + 1] in b"\r\n":
            at += 1
            continue
        stop = data.index(b"\r\n\r\n", at) + 4
        head = data[at:stop]
        length = int(header(head, "Content-Length"))
        block = data[stop:stop + length]
        if len(block) != length:
            raise ValueError(f"record at {at} declares {length} bytes and has {len(block)}")
        yield head, block
        at = stop + length


# --- Spark ---------------------------------------------------------------

def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _write(archives: DataFrame, path: str) -> str:
    """One file per row; each row is an archive whose last line end the writer adds."""
    archives.select(F.col("archive").cast("string")).write.option("maxRecordsPerFile", 1).option(
        "compression", "gzip").option("lineSep", "\n").text(path)
    return path


def write_arcs(pages: DataFrame, path: str, key_col: str = "page_id", url_col: str = "url", body_col: str = "html",
               archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Write ARC archives, of version 1 and 2 in turn, with one record per row."""
    slim = pages.select(F.col(key_col).cast("string").alias("key"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(body_col), F.lit("")).alias("body"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, made, size = 0, [], 0
        for batch in batches:
            for key, url, body in zip(*(c.to_pylist() for c in batch.columns)):
                if not made:
                    version, name = 1 + number % 2, f"pages-{number}.arc"
                    made, size = [arc_head(version, name)], 0
                raw = body.encode("utf-8", "replace")
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (
                    f"{KEY}: {key}\r\n" if key is not None else "") + f"Content-Length: {len(raw)}\r\n\r\n"
                made.append(arc_record(version, url, "text/html", head.encode() + raw, name=name, offset=size))
                size += len(made[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(made)[:-1]], pa.binary())})
                    number, made = number + 1, []
        if made:
            yield pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(made)[:-1]], pa.binary())})

    return _write(slim.mapInArrow(pack, "archive binary"), path)


def read_arcs(spark: SparkSession, path: str) -> DataFrame:
    """What is in the archives, without the payloads: path, seq, url, type, key, record_id, payload_bytes, payload_digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for seq, arc in enumerate(parse_arc(gzip.decompress(content.as_py()))):
                    head, payload = split_reply(arc["content"])
                    key, sha = header(head, KEY), digest(payload)
                    rows.append((name, seq, arc["URL"], record_type(arc["URL"], arc["content"]), key,
                                 record_id(arc["URL"], arc["Archive-date"], key or "", sha), len(payload), sha))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], k) for i, k in enumerate(
                        [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()])],
                    names=["path", "seq", "url", "type", "key", "record_id", "payload_bytes", "payload_digest"])

    return _files(spark, path).mapInArrow(
        run, "path string, seq int, url string, type string, key string, record_id string, payload_bytes bigint, payload_digest string")


def revisits(records: DataFrame, min_revisit_bytes: int = 0, key_order: str = "bigint") -> DataFrame:
    """path, seq, refers_key, refers_id of every record that repeats the payload of one with a smaller key."""
    replies = records.where((F.col("type") == "response") & (F.col("payload_bytes") >= min_revisit_bytes))
    place = F.struct(F.col("key").isNull().alias("unkeyed"), F.expr(f"try_cast(key as {key_order})").alias("k"), "path", "seq", "key", "record_id")
    firsts = store(replies.groupBy("payload_digest", "payload_bytes").agg(F.min(place).alias("first"), F.count("*").alias("n"))
                   .where("n > 1").drop("n"), "warc-firsts")
    return replies.join(firsts, ["payload_digest", "payload_bytes"]).where(
        ~((F.col("path") == F.col("first.path")) & (F.col("seq") == F.col("first.seq")))).select(
        "path", "seq", F.col("first.key").alias("refers_key"), F.col("first.record_id").alias("refers_id"))


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_revisit_bytes: int = 0, key_order: str = "bigint") -> str:
    """ARC archives to WARC archives, one for one; keys are ordered as values of the type ``key_order``."""
    records = store(read_arcs(spark, arc_path), "warc-records")
    by_archive = revisits(records, min_revisit_bytes, key_order).groupBy("path").agg(
        F.collect_list(F.struct("seq", "refers_key", "refers_id")).alias("refers"))  # bounded by an archive's records

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, refers in zip(batch.column(0), batch.column(1).to_pylist()):
                to = {r["seq"]: (r["refers_key"], r["refers_id"]) for r in refers or []}
                out = [warc_record(arc, to.get(seq)) for seq, arc in enumerate(parse_arc(gzip.decompress(content.as_py())))]
                yield pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(out)[:-1]], pa.binary())})

    joined = _files(spark, arc_path).join(by_archive.hint("merge"), "path", "left").select("content", "refers")
    return _write(joined.mapInArrow(run, "archive binary"), warc_path)


def read_warcs(spark: SparkSession, path: str) -> DataFrame:
    """One row per reply or revisit: key, url, date, record_id, record_type, payload_bytes, payload_digest, refers_key, payload.

    A revisit has no payload; its bytes come from the reply header that it keeps, its digest from its own header.
    """
    kinds = {"key": pa.string(), "url": pa.string(), "date": pa.string(), "record_id": pa.string(), "record_type": pa.string(),
             "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_key": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for head, block in parse_warc(gzip.decompress(content.as_py())):
                    kind = header(head, "WARC-Type")
                    if kind not in ("response", "revisit"):
                        continue
                    reply, payload = split_reply(block)
                    said = (header(head, "WARC-Payload-Digest") or "").removeprefix("sha1:")
                    if kind == "response" and digest(payload) != said:
                        raise ValueError(f"payload digest of {header(head, 'WARC-Record-ID')} does not hold")
                    rows.append((header(reply, KEY), header(head, "WARC-Target-URI"), header(head, "WARC-Date"),
                                 header(head, "WARC-Record-ID"), kind,
                                 len(payload) if kind == "response" else int(header(reply, "Content-Length") or 0), said,
                                 header(head, "X-Refers-To-Key")))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds.values())], names=list(kinds))

    return _files(spark, path).select("content").mapInArrow(
        run, "key string, url string, date string, record_id string, record_type string, payload_bytes bigint, payload_digest string, refers_key string")


def archived_pages(pages: DataFrame, key_col: str = "page_id", url_col: str = "url", body_col: str = "html",
                   min_revisit_bytes: int = 0) -> DataFrame:
    """Pages to ARC to WARC and back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    arcs = write_arcs(pages, scratch_path(spark, "arc"), key_col, url_col, body_col)
    kind = pages.schema[key_col].dataType
    warcs = convert(spark, arcs, scratch_path(spark, "warc"), min_revisit_bytes, kind.simpleString())
    return read_warcs(spark, warcs).select(
        F.col("key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_key").cast(kind).alias("refers_to"))


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), b AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS sha, min(page_id) OVER (PARTITION BY body) AS first
  FROM p
)
SELECT page_id, payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + (((('0x' || substr(sha, 1 + 5 * (i // 4), 5))::BIGINT) >> (15 - 5 * (i % 4))) & 31)::INT, 1), '' ORDER BY i)
   FROM range(0, 32) r(i)) AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM b
"""
