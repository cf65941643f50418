"""WARC archives: a writer that deduplicates payloads by revisit records and a splittable reader.

`write` makes one record per page. Of pages with equal payloads (of at least `least` bytes) the one with the smallest
page id is a response; the others are revisits that refer to it and hold no payload. Every record is a gzip member of
its own. Each task writes files under names of their own; only files in the manifest, a Parquet table whose commit
takes one attempt of each task, are part of the archive, so a repeated task leaves no second copy of a record.

`read` cuts the files into byte ranges. A task looks for the gzip magic in its range, takes a hit for a record's start
only if the member inflates to a WARC version line and well-formed headers with a length, and owns the records that start inside
its range, reading past its end where the last one needs it.

Null payloads count as empty, null URLs are written as `urn:none`. Null page ids get a record id without a number and
are never referred to while a numbered page has the payload. Pages that repeat an id and payload: one of them, any, is
the response. Paths are URIs that every executor can open (the shared folder), as Spark itself writes no raw bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Scratch, merged

VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RANGE_BYTES = 8 << 20
FILE_BYTES = 64 << 20
CHUNK = 1 << 16
MANIFEST = "path string, bytes long, records long"


def record_id(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = HTTP if revisit else HTTP + payload
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {clean(url)}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    raw = b"\r\n".join([VERSION, *(h.encode() for h in head), b"", b""])
    return deflate.compress(raw) + deflate.compress(block) + deflate.compress(b"\r\n\r\n") + deflate.flush()


def clean(url: str | None) -> str:
    """A URL on one header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:none"


def _files(base: str):
    """Task function: write the rows of a task to files of about FILE_BYTES, and name them."""

    def rows(batches):
        from pyarrow.fs import FileSystem

        fs, root = FileSystem.from_uri(base)
        out, path, size, records = None, "", 0, 0

        def done():
            out.close()
            return pa.record_batch({"path": pa.array([path]), "bytes": pa.array([size], pa.int64()), "records": pa.array([records], pa.int64())})

        for b in batches:
            for page, url, html, ref, revisit in zip(*(b.column(c).to_pylist() for c in ("id", "url", "payload", "refers_to", "revisit"))):
                if out is None:
                    path, size, records = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{path.rpartition('/')[2]}", compression=None)
                made = member(page, url, (html or "").encode(), ref, revisit)
                out.write(made)
                size, records = size + len(made), records + 1
                if size >= FILE_BYTES:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return rows


def write(pages: DataFrame, base: str, scratch: Scratch, least: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write the archive under the folder `base`; returns its manifest (path, bytes, records)."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    key = F.sha2(F.col("payload").cast("binary"), 256)
    slim = scratch.save(rows.select("id", key.alias("sha"), F.octet_length("payload").alias("size"), F.xxhash64("id", "url").alias("tie")))
    first = slim.where(F.col("size") >= least).groupBy("sha").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "tie")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = scratch.save(first.where("n > 1").select(F.col("sha").alias("f_sha"), F.col("first.id").alias("f_id"), F.col("first.tie").alias("f_tie")))
    joined = merged(rows.withColumn("sha", key), first, F.col("sha") == F.col("f_sha"), "left")
    is_first = F.col("id").eqNullSafe(F.col("f_id")) & (F.xxhash64("id", "url") == F.col("f_tie"))
    ready = joined.select("id", "url", "payload", F.col("f_id").alias("refers_to"), (F.col("f_sha").isNotNull() & ~is_first).alias("revisit"))
    return scratch.save(ready.mapInArrow(_files(base), MANIFEST))


def headers(data: bytes) -> dict[str, str] | None:
    """The headers of a record if they are whole and well formed; None if not."""
    end = data.find(b"\r\n\r\n")
    if end < 0 or not re.match(rb"WARC/1\.[01]\r\n", data):
        return None
    out = {}
    for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or " " in name:
            return None
        out[name.strip().lower()] = value.strip()
    return out if "warc-type" in out and out.get("content-length", "").isdigit() else None


class _Source:
    """Forward reading of one open file with a small buffer."""

    def __init__(self, file, at: int):
        self.file, self.at, self.buffer = file, at, b""
        file.seek(at)

    def more(self) -> bool:
        got = self.file.read(CHUNK)
        self.buffer += got
        return bool(got)

    def skip(self, n: int) -> None:
        self.buffer, self.at = self.buffer[n:], self.at + n


def _member_at(src: _Source):
    """(data, bytes of the member) of a record that starts at the buffer's head; None if none does."""
    inflate, used, out, head = zlib.decompressobj(31), 0, [], b""
    checked = None
    while True:
        if used == len(src.buffer) and not src.more():
            return None
        try:
            got = inflate.decompress(src.buffer[used:])
        except zlib.error:
            return None
        used = len(src.buffer) - len(inflate.unused_data)
        out.append(got)
        if checked is None:
            head += got
            if not VERSION.startswith(head[:7]) and not head.startswith(b"WARC/1."):
                return None
            checked = headers(head)
            if checked is None and (b"\r\n\r\n" in head or len(head) > 1 << 20):
                return None
        if inflate.eof:
            return (checked, b"".join(out), used) if checked else None


def scan(file, start: int, end: int):
    """Headers and block of each record that starts in [start, end) of a file."""
    src = _Source(file, start)
    while src.at < end:
        hit = src.buffer.find(MAGIC)
        if hit < 0:
            src.skip(max(0, len(src.buffer) - len(MAGIC) + 1))
            if not src.more():
                return
            continue
        src.skip(hit)
        if src.at >= end:
            return
        found = _member_at(src)
        if found is None:
            src.skip(1)
            continue
        head, data, used = found
        body = data.find(b"\r\n\r\n") + 4
        yield head, data[body : body + int(head["content-length"])]
        src.skip(used)


def _page(name: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(m[1]) if m else None


def _records(keep_payload: bool):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * keep_payload
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * keep_payload

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    def rows(batches):
        from pyarrow.fs import FileSystem

        for b in batches:
            for path, start, end in zip(*(b.column(c).to_pylist() for c in ("path", "start", "end"))):
                fs, name = FileSystem.from_uri(path)
                out, held = [], 0
                with fs.open_input_file(name) as file:
                    for head, block in scan(file, start, end):
                        kind = head["warc-type"]
                        payload = block.partition(b"\r\n\r\n")[2]
                        if kind == "response":
                            size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                            if head.get("warc-payload-digest", f"sha1:{digest}") != f"sha1:{digest}":
                                raise ValueError(f"payload of {head.get('warc-record-id')} in {path} does not match its digest")
                        else:
                            size, digest = int(head["x-payload-length"]), head["warc-payload-digest"].partition(":")[2]
                        out.append((_page(head.get("warc-record-id")), head.get("warc-target-uri"), size, digest, kind, _page(head.get("warc-refers-to")),
                                    payload if kind == "response" else None))
                        held += len(payload) * keep_payload
                        if len(out) >= 4096 or held > 8 << 20:
                            yield batch(out)
                            out, held = [], 0
                if out:
                    yield batch(out)

    return rows


def read(spark: SparkSession, manifest: DataFrame, payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of the files of a manifest: page_id, url, payload_bytes, payload_digest, record_type, refers_to and payload (null for revisits)."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    ranges = manifest.select("path", "bytes", starts.alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, F.col("bytes")).alias("end"))
    kind = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payload
    tasks = max(spark.sparkContext.defaultParallelism, ranges.count())
    return ranges.repartition(tasks, "path", "start").mapInArrow(_records(payload), kind)
