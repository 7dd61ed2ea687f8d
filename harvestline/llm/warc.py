"""WARC output by a monolithic gzip normaliser.

Each task writes its records as one gzip stream over the whole file (the way
many crawlers do, which allows no random access), and then normalises it: the
stream is inflated once, record after record, each record is written as a gzip
member of its own, and a sidecar index gets its offset and length. Readers use
the index to fetch single records.

A payload's group is all records with equal payloads. The one with the largest
``page_id`` is the response, the others are revisits that carry the digest and
length of the full payload and name the response, but no payload bytes.
Payloads under ``min_revisit_bytes`` are always responses.

Null html is an empty payload; null url an empty target. A null page_id takes
no part in the comparison: such a row is a response, written without an id.
Rows that repeat a page_id with the same html are all responses of that id.
An empty table gives no file and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline.llm.common import open_fs, scratch, write_once

CRLF = b"\r\n"
CHUNK = 1 << 18
INDEX = "file string, offset long, length long, page_id long"
READ = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def digest32(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1, as WARC digests are written."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def planned(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Each row with its record type and, for revisits, the response's page_id.

    The largest page_id of a payload comes from a pre-aggregated group, so a
    payload that a third of all pages share costs one row per task. Only rows
    of payloads that repeat are looked up.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("key", F.sha1(F.encode("html", "UTF-8")))
    groups = (
        rows.where("page_id is not null")
        .where(F.octet_length("html") >= min_revisit_bytes)
        .groupBy("key")
        .agg(F.max("page_id").alias("newest"), F.min("page_id").alias("oldest"))
        .where("newest <> oldest")
    )
    revisit = F.col("newest").isNotNull() & (F.col("page_id") < F.col("newest"))
    return rows.join(groups, "key", "left").select(
        "page_id",
        "url",
        "html",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("newest")).alias("refers_to"),
    )


def record(page_id, url, payload: bytes, kind: str, refers_to) -> bytes:
    """One uncompressed WARC/1.1 record with its two closing line ends."""
    sha = digest32(payload)
    rid = hashlib.sha1(f"{page_id}\n{url}\n{sha}".encode()).hexdigest()
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:sha1:{rid}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Payload-Digest: sha1:{sha}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"X-Refers-To-Page-Id: {refers_to}")
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + CRLF + CRLF + payload + CRLF + CRLF


def parse_head(head: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])


def monolithic(records, level: int = 1) -> Iterator[bytes]:
    """All records as one gzip stream."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    for r in records:
        if out := z.compress(r):
            yield out
    yield z.flush()


class Inflater:
    """A whole-file gzip stream (one member or several), inflated CHUNK bytes at a time.

    ``buffer`` holds what is inflated, of which the first ``at`` bytes are done with.
    """

    def __init__(self, source):
        self.source, self.z, self.raw = source, zlib.decompressobj(31), b""
        self.buffer, self.at = bytearray(), 0

    def more(self) -> bool:
        del self.buffer[: self.at]
        self.at = 0
        while True:
            if self.z.eof:
                self.raw, self.z = self.z.unused_data, zlib.decompressobj(31)
            out = self.z.decompress(self.raw, CHUNK)
            self.raw = self.z.unconsumed_tail
            if out:
                self.buffer += out
                return True
            if not self.z.eof and not self.raw:
                self.raw = self.source.read(CHUNK)
                if not self.raw:
                    return False

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """(headers, whole record) of one record after the other; memory is one record and a CHUNK."""
        while True:
            while (end := self.buffer.find(CRLF + CRLF, self.at)) < 0:
                if not self.more():
                    if self.buffer.strip():
                        raise ValueError("the stream ends within a record's head")
                    return
            head = parse_head(bytes(self.buffer[self.at : end]))
            size = end - self.at + 4 + int(head["Content-Length"]) + 4
            while len(self.buffer) - self.at < size:
                if not self.more():
                    raise ValueError("the stream ends within a record's block")
            whole = bytes(self.buffer[self.at : self.at + size])
            self.at += size
            yield head, whole


def normalise(source, level: int = 1) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, gzip member) of each record of a monolithic stream, inflated once."""
    for head, whole in Inflater(source).records():
        z = zlib.compressobj(level, zlib.DEFLATED, 31)
        yield head, z.compress(whole) + z.flush()


def write_archives(plan: DataFrame, folder: str) -> DataFrame:
    """Write one archive and one sidecar index per task; returns the index rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        # A name of this attempt's own: only the attempt that Spark commits has
        # its index rows kept, and those name the files that it wrote itself.
        name = f"{base}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"

        def records():
            for b in batches:
                # one value at a time: a batch's html need not be in memory twice
                for i in range(b.num_rows):
                    page, url, html, kind, refers = (b.column(c)[i].as_py() for c in range(5))
                    yield record(page, url, html.encode(), kind, refers)

        first = next(rows := records(), None)
        if first is None:
            return

        def again():
            yield first
            yield from rows

        write_once(fs, f"{name}.mono.warc.gz", monolithic(again()))
        index: list[tuple[str, int, int, int | None]] = []

        def members(source):
            at = 0
            for head, member in normalise(source):
                page = head.get("X-Page-Id")
                index.append((f"{name}.warc.gz", at, len(member), page and int(page)))
                at += len(member)
                yield member

        with fs.open_input_stream(f"{name}.mono.warc.gz", compression=None) as source:
            write_once(fs, f"{name}.warc.gz", members(source))
        write_once(
            fs,
            f"{name}.idx.jsonl",
            (json.dumps({"offset": a, "length": n, "page_id": p}).encode() + b"\n" for _, a, n, p in index),
        )
        # the stream has been rewritten; a retried task makes it anew
        fs.delete_file(f"{name}.mono.warc.gz")
        cols = list(zip(*index))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:])],
            names=["file", "offset", "length", "page_id"],
        )

    return plan.select("page_id", "url", "html", "record_type", "refers_to").mapInArrow(run, INDEX)


def read_record(fs, path: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by random access."""
    with fs.open_input_file(path) as f:
        f.seek(offset)
        whole = zlib.decompress(f.read(length), 31)
    end = whole.index(CRLF + CRLF)
    head = parse_head(whole[:end])
    return head, whole[end + 4 : end + 4 + int(head["Content-Length"])]


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Each indexed record, read back from its archive and checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(folder)
        for batch in batches:
            out = []
            for file, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                head, payload = read_record(fs, file, offset, length)
                sha, n = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"])
                if head["WARC-Type"] == "response" and (digest32(payload), len(payload)) != (sha, n):
                    raise ValueError(f"{file} at {offset}: the payload differs from its digest")
                page, refers = head.get("X-Page-Id"), head.get("X-Refers-To-Page-Id")
                out.append(
                    (page and int(page), n, sha, head["WARC-Type"], refers and int(refers))
                )
            cols = list(zip(*out)) or [()] * 5
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
            )

    return index.select("file", "offset", "length").mapInArrow(run, READ)


def archive(spark: SparkSession, pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Write the archives of ``pages`` to a shared folder; returns the rows read back."""
    folder = folder or scratch(spark, "warc")
    index = write_archives(planned(pages, min_revisit_bytes), f"{folder}/archives")
    # The index is a written table: reading back never runs the writers again.
    index.write.parquet(f"{folder}/index")
    return read_archives(spark.read.schema(INDEX).parquet(f"{folder}/index"), f"{folder}/archives")
