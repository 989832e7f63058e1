"""WARC archives of pages: one gzip member per record, written and read as a stream.

Writing: the smallest page of each payload of `least` bytes or more that occurs again is found by
an aggregate over digests and joined back to its copies; those become revisits without a payload.
A task writes its rows to archives of its own in the shared folder and returns a manifest row for
each; only archives of successful attempts are in the manifest, so a lost executor leaves at most
a file that nobody reads.

Reading: a task takes whole archives, inflates them piece by piece, one member after the other,
frames the header and the block by its content length and verifies both digests. A break in the
framing or a wrong digest raises. Memory is bounded by one record.

Null html is an empty payload, a null url has no target, a null page id counts as the largest and
is kept as null. Rows equal in page and payload are alike: of copies whose page id is the smallest
all are responses. No page gives an empty manifest. Other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.sources.storage import scratch_folder, stage

LEAST = 100
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 1 << 20
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "archive string, records long, bytes long"
RECORDS = "page_id long, target_uri string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _page(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _number(uri: str | None) -> int | None:
    text = uri.strip("<>").rpartition(":")[2] if uri else "none"
    return None if text == "none" else int(text)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member. A revisit has the HTTP header of its page, and no payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        block += payload
    header = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_page(page_id)}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}"] if url else []),
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        *([f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_page(refers_to)}"] if revisit else []),
        f"Content-Length: {len(block)}",
    ]
    return gzip.compress("\r\n".join(header).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", mtime=0)


def members(stream) -> Iterator[bytes]:
    """The records of an archive, inflated."""
    inflate, parts, raw = zlib.decompressobj(31), [], stream.read(READ_BYTES)
    begun = False
    while raw:
        begun = True
        parts.append(inflate.decompress(raw))
        if inflate.eof:
            yield b"".join(parts)
            raw, inflate, parts, begun = inflate.unused_data, zlib.decompressobj(31), [], False
        else:
            raw = b""
        raw = raw or stream.read(READ_BYTES)
    if begun:
        raise ValueError("the archive ends within a record")


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, in lower case, and the block."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise ValueError(f"no record: {data[:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    size = int(fields["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"{fields.get('warc-record-id')}: the block is not {size} bytes long")
    if f"sha256:{hashlib.sha256(block).hexdigest()}" != fields["warc-block-digest"]:
        raise ValueError(f"{fields.get('warc-record-id')}: wrong block digest")
    return fields, block


def _row(data: bytes) -> tuple:
    fields, block = parsed(data)
    head, _, payload = block.partition(b"\r\n\r\n")
    http = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(http["content-length"])):
        raise ValueError(f"{fields['warc-record-id']}: wrong payload")
    whole = payload if kind == "response" else None
    return _number(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, _number(fields.get("warc-refers-to")), int(http["content-length"]), digest, whole


def write_archives(pages: DataFrame, folder: str, least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of `pages` (page_id, url, html) in `folder`; returns their manifest, read back from the shared folder."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"))
    large = rows.where(F.octet_length("html") >= least)
    copied = large.groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first")).where("n > 1").select("digest", "first", F.lit(True).alias("copied"))
    whole = rows.join(copied, "digest", "left").select("page_id", "url", "html", "digest", "first", F.coalesce(F.col("copied") & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False)).alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(folder)
        out, path, n, size = None, "", 0, 0
        done: list[tuple] = []
        for batch in batches:
            for page_id, url, text, digest, first, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out, n, size = files.open_output_stream(f"{base}/{path}", compression=None), 0, 0
                data = record(page_id, url, text.encode("utf-8", "replace"), digest, first, revisit)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{path}", n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{path}", n, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done)], names=["archive", "records", "bytes"])

    files, base = fs.FileSystem.from_uri(folder)
    files.create_dir(base, recursive=True)
    manifest, _ = stage(whole.mapInArrow(run, MANIFEST), "manifest")
    return manifest


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record of the archives that `manifest` names, digests verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)
        for batch in batches:
            for archive, expected in zip(batch.column("archive").to_pylist(), batch.column("records").to_pylist()):
                files, path = fs.FileSystem.from_uri(archive)
                rows, held, n = [], 0, 0
                with files.open_input_stream(path, compression=None) as stream:
                    for data in members(stream):
                        rows.append(_row(data))
                        held, n = held + len(data), n + 1
                        if held > 8 << 20:
                            yield pack(rows)
                            rows, held = [], 0
                if n != expected:
                    raise ValueError(f"{archive}: {n} records instead of {expected}")
                if rows:
                    yield pack(rows)

    archives = max(1, manifest.count())
    spread = manifest.repartitionByRange(min(archives, 10_000), "archive") if archives > 1 else manifest
    return spread.mapInArrow(run, RECORDS)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    folder = scratch_folder(spark, "warc")
    return read_archives(write_archives(pages, folder))
