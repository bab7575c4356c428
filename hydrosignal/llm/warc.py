"""WARC archives: one gzip member per record, written in parallel and read back sequentially."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrosignal.operators.attach import attach

CRLF = b"\r\n"
#: An empty gzip member: what Spark's writer puts after each run of records.
EMPTY_MEMBER = bytes.fromhex("1f8b080000000000000303000000000000000000")
RUN_BYTES = 1_000_000
#: An archive holds at most so many runs, so about 32 MB.
RUNS_PER_FILE = 32
READ_BYTES = 65_536
WARC_VERSION = b"WARC/1.0"
RECORD_SCHEMA = (
    "record_id string, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary, digest_ok boolean"
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record. A revisit's block is the HTTP head alone, with the full length in it."""
    revisit = refers_to is not None
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    name = uuid.uuid5(uuid.NAMESPACE_OID, f"page {page}")
    clean = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{name}>"),
        ("WARC-Target-URI", clean),
        ("WARC-Identified-Payload-Page", "" if page is None else str(page)),
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {refers_to}')}>"),
            ("WARC-Refers-To-Page", str(refers_to)),
        ]
    top = WARC_VERSION + CRLF + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + CRLF
    return top + block + CRLF + CRLF


def members(data: bytes) -> Iterator[bytes]:
    """Contents of the gzip members of an archive, inflated piece by piece; empty ones are skipped."""
    at = 0
    while at < len(data):
        inflate, out = zlib.decompressobj(31), []
        while not inflate.eof:
            piece = data[at : at + READ_BYTES]
            if not piece:
                raise ValueError("archive ends inside a gzip member")
            out.append(inflate.decompress(piece))
            at += len(piece)
        at -= len(inflate.unused_data)
        whole = b"".join(out)
        if whole:
            yield whole


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in lines.split(CRLF)[1:])
    return {k.decode().lower(): v.strip().decode() for k, _, v in pairs}


def parse(data: bytes) -> dict:
    """Fields of one record; framing and digests are checked."""
    top, _, rest = data.partition(CRLF + CRLF)
    if not top.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    head = _fields(top)
    length = int(head["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != CRLF + CRLF:
        raise ValueError("content length does not fit the record")
    http, _, payload = block.partition(CRLF + CRLF)
    revisit = head["warc-type"] == "revisit"
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    good = f"sha1:{sha1_base32(block)}" == head["warc-block-digest"] and (revisit or sha1_base32(payload) == digest)
    page, refers = head["warc-identified-payload-page"], head.get("warc-refers-to-page")
    return {
        "record_id": head["warc-record-id"],
        "page_id": int(page) if page else None,
        "url": head["warc-target-uri"],
        "record_type": head["warc-type"],
        "refers_to": int(refers) if refers else None,
        "payload_bytes": int(_fields(http)["content-length"]),
        "payload_digest": digest,
        "payload": None if revisit else payload,
        "digest_ok": good,
    }


def mark_revisits(pages: DataFrame, least_bytes: int = 0, key: str = "page_id", body: str = "html") -> DataFrame:
    """(key, url, html, refers_to): the smallest key with the same payload, null for that row itself.

    Payloads are compared by SHA-256. Only digests that occur more than once are looked up,
    with the size-checked ``attach``; no group of equal payloads is brought together.
    """
    rows = pages.select(
        F.col(key).alias("page_id"),
        F.col("url"),
        F.coalesce(F.col(body), F.lit("")).alias("html"),
    ).withColumn("_digest", F.sha2(F.col("html").cast("binary"), 256))
    copies = (
        rows.filter(F.octet_length("html") >= least_bytes)
        .groupBy("_digest")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1 AND _first IS NOT NULL")
        .select("_digest", "_first")
    )
    looked_up = attach(rows, copies, ["_digest"], salt_by=["page_id"])
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return looked_up.select("page_id", "url", "html", refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Writes a record per row of ``pages`` (page_id, url, html) below ``path``.

    Every task packs its records into runs of about a megabyte of gzip members; Spark's text
    writer puts runs one after another, with an empty member between them, and starts a new
    archive after ``RUNS_PER_FILE`` runs. Each file is a valid gzip and WARC file.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, size = [], 0

        def out(parts):
            return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["value"])

        for batch in batches:
            for page, url, html, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                run.append(member(record(page, url, html.encode(), refers)))
                size += len(run[-1])
                if size >= RUN_BYTES:
                    yield out(run)
                    run, size = [], 0
        if run:
            yield out(run)

    packed = mark_revisits(pages, least_bytes).mapInArrow(pack, "value binary")
    (
        packed.select(F.col("value").cast("string"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .option("maxRecordsPerFile", RUNS_PER_FILE)
        .text(path)
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives below ``path``; a broken member or length raises, a wrong digest is flagged."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("record_id", pa.string()),
                ("page_id", pa.int64()),
                ("url", pa.string()),
                ("record_type", pa.string()),
                ("refers_to", pa.int64()),
                ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()),
                ("payload", pa.binary()),
                ("digest_ok", pa.bool_()),
            ]
        )
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for data in members(content.as_py()):
                    rows.append(parse(data))
                    size += len(data)
                    if size >= RUN_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(unpack, RECORD_SCHEMA)
