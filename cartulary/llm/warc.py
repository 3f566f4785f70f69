"""WARC archives: one gzip member per record, written by executors, and a sequential reader.

The writer stores pages as ``resource``-style ``response`` records, or as ``revisit``
records of the page that holds the same payload.  The reader inflates the archive
member by member with an incremental decompressor, frames each record by its
Content-Length, and verifies length and SHA-1 of what it stored.

Archives go to the folder that driver and executors share, each under a name of its
own, and only the names that successful tasks return are listed; an attempt that was
lost leaves a file that nothing refers to.

Defined cases: a null html is an empty payload; a null page_id is written as an empty
id; rows that repeat the largest page_id of a payload are all responses; an empty
table makes no archive and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from cartulary.llm.shared import bounded_batches, stash
from cartulary.operators.materialise import shared_dir

LEAST_REVISIT = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
READ, HEADER = 1 << 18, 1 << 24
ROTATE = 256 << 20


class WarcError(ValueError):
    """A record that breaks the format or whose digest doesn't agree."""


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _named(digest) -> str:
    return "sha1:" + base64.b32encode(digest.digest()).decode()


def _sha1(data: bytes) -> str:
    return _named(hashlib.sha1(data, usedforsecurity=False))


def page_record(page_id: int | None, url: str | None, html: str | None, refers_to: int | None, original_url: str | None = None) -> bytes:
    """The gzip member of a page: a response with its payload, or a revisit without."""
    payload = (html or "").encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if refers_to is not None else http + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join((url or "").split())),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", _sha1(payload)),
        ("WARC-Block-Digest", _sha1(block)),
    ]
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    return _record(headers, block)


class Frame:
    """A record as it is inflated: its header, then as many bytes as Content-Length says, hashed as they come."""

    def __init__(self) -> None:
        self.head, self.headers, self.block, self.left, self.end, self.digest = b"", None, [], 0, b"", hashlib.sha1(usedforsecurity=False)

    def feed(self, data: bytes) -> None:
        if self.headers is None:
            self.head += data
            head, sep, data = self.head.partition(b"\r\n\r\n")
            if not sep:
                if len(self.head) > HEADER or not b"WARC/".startswith(self.head[:5]):
                    raise WarcError("no record header")
                return
            self.headers, self.left = self._headers(head)
        part, rest = data[: self.left], data[self.left :]
        self.block.append(part)
        self.digest.update(part)
        self.left -= len(part)
        self.end += rest
        if len(self.end) > 4:
            raise WarcError("the block is longer than the Content-Length")

    @staticmethod
    def _headers(head: bytes) -> tuple[dict[str, str], int]:
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise WarcError("no record header")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = headers.get("content-length", "")
        if not length.isdigit():
            raise WarcError("no Content-Length")
        return headers, int(length)

    def whole(self) -> tuple[dict[str, str], bytes]:
        if self.headers is None or self.left or self.end != b"\r\n\r\n":
            raise WarcError("the record ends before its Content-Length")
        if self.headers.get("warc-block-digest", own := _named(self.digest)) != own:
            raise WarcError("block digest")
        return self.headers, b"".join(self.block)


def records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each gzip member of a stream, read and inflated ``READ`` bytes at a time."""
    data = stream.read(READ)
    while data:
        unpack, frame = zlib.decompressobj(31), Frame()
        while not unpack.eof:
            if not data:
                raise WarcError("archive ends within a member")
            frame.feed(unpack.decompress(data, READ))
            data = unpack.unconsumed_tail or (b"" if unpack.eof else stream.read(READ))
        yield frame.whole()
        data = unpack.unused_data or stream.read(READ)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record that is inflated already."""
    frame = Frame()
    frame.feed(member)
    return frame.whole()


def read_archive(stream: BinaryIO) -> Iterator[dict]:
    """Records of an archive: page_id, url, record_type, payload (None for revisits), digest hex, refers_to."""
    for headers, block in records(stream):
        kind = headers["warc-type"]
        payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
        if payload is not None and headers["warc-payload-digest"] != _sha1(payload):
            raise WarcError("payload digest")
        ids = [headers.get(k, "<urn:page:>")[len("<urn:page:") : -1] for k in ("warc-record-id", "warc-refers-to")]
        yield {
            "page_id": int(ids[0]) if ids[0] else None,
            "url": headers.get("warc-target-uri", ""),
            "record_type": kind,
            "payload": payload,
            "payload_digest": base64.b32decode(headers["warc-payload-digest"].partition(":")[2]).hex(),
            "refers_to": int(ids[1]) if ids[1] else None,
        }


def plan_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``pages`` (page_id, url, html) with refers_to: the largest page_id of an equal payload of ``least`` bytes or more."""
    keyed = pages.select("page_id", "url", "html", F.sha2(F.coalesce("html", F.lit("")), 256).alias("s"), F.octet_length(F.coalesce("html", F.lit(""))).alias("b"))
    owners = keyed.where(F.col("b") >= least).groupBy("s").agg(F.max("page_id").alias("owner"), F.count("*").alias("c")).where("c > 1").select("s", "owner")
    refers = F.when(F.col("owner").isNotNull() & ~F.col("owner").eqNullSafe(F.col("page_id")), F.col("owner"))
    return keyed.join(stash(owners, "payload-owners"), "s", "left").select("page_id", "url", "html", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html, refers_to) as archives in ``folder``; a stashed table of (path, records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        out, path, count, size, done = None, "", 0, 0, []
        for b in batches:
            for page_id, url, html, refers in zip(*(b.column(i) for i in range(4))):
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out, count, size = fs.open_output_stream(path, compression=None), 0, 0
                member = page_record(page_id.as_py(), url.as_py(), html.as_py(), refers.as_py())
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= ROTATE:
                    out.close()
                    done.append((path, count))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done]), pa.array([c for _, c in done], pa.int64())], ["path", "records"])

    bounded_batches(pages)
    return stash(pages.select("page_id", "url", "html", "refers_to").mapInArrow(run, "path string, records long"), "archives")


RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, html string"


def read_archives(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the listed archives, one task an archive; ``payloads`` False leaves html null."""
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for b in batches:
            for path in b.column("path").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for r in read_archive(stream):
                        p = r["payload"]
                        n = None if p is None else len(p)
                        rows.append((r["page_id"], r["url"], r["record_type"], n, r["payload_digest"], r["refers_to"], p.decode() if payloads and p is not None else None))
                        held += n if payloads and n else 0
                        if len(rows) >= 4096 or held >= 1 << 24:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    files = archives.select("path").repartition(max(1, min(archives.count(), 4096)))
    return files.mapInArrow(run, RECORDS)


def roundtrip(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Write every page, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    archives = write_archives(plan_revisits(pages, least), folder)
    records = stash(read_archives(archives, folder, payloads=False).drop("html", "url"), "records")
    firsts = records.where("record_type = 'response'").groupBy(F.col("page_id").alias("owner"), F.col("payload_digest").alias("d")).agg(F.max("payload_bytes").alias("n"))
    wanted = records.where("record_type = 'revisit'").select(F.col("refers_to").alias("owner"), F.col("payload_digest").alias("d")).distinct()
    known = firsts.join(wanted, ["owner", "d"], "left_semi")
    on = (records["refers_to"] == known["owner"]) & (records["payload_digest"] == known["d"])
    return records.join(known, on, "left").select("page_id", F.coalesce("payload_bytes", "n").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
