"""WARC archives: one gzip member a record, read back by a sequential reader.

``write_warc`` turns rows into archives (binary rows of about ARCHIVE_BYTES). ``read_warc`` feeds an archive to an
incremental zlib decompressor, frames each record by its Content-Length and verifies block and payload digests.
Of equal payloads of at least REVISIT_BYTES the one with the largest id is a response, the others are revisit records
that name it; their HTTP header keeps the payload's length.

Cases: a null payload is empty; a null id never is the largest one, and where all ids of a group are null all are
responses; rows that share payload and largest id all are responses; a null URL is written as empty; a record that is
cut off or has a wrong digest comes back with a text in ``error``, and the reader goes on after it where it can;
extra columns are left out; an empty table gives no archives.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cellgrain.llm.common import lookup_join, table
from cellgrain.llm.media import pieces

REVISIT_BYTES, ARCHIVE_BYTES, FEED, LEVEL = 1000, 8 << 20, 16 << 10, 6
#: Records carry no clock, so that a repeated task writes the same bytes.
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = "archive string, record long, page_id string, record_type string, url string, payload_bytes long, payload_digest string, refers_to string, payload binary, error string"


def record(page_id: str | None, url: str, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC record as a gzip member."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {' '.join(url.split())}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def members(data: bytes, feed: int = FEED) -> Iterator[tuple[bytes, str | None]]:
    """Contents of the gzip members, decompressed ``feed`` bytes at a time; a broken one ends with an error."""
    at = 0
    while at < len(data):
        z, parts = zlib.decompressobj(31), []
        try:
            while at < len(data) and not z.eof:
                step = data[at : at + feed]
                parts.append(z.decompress(step))
                at += len(step) - len(z.unused_data)
        except zlib.error as e:
            yield b"".join(parts), f"gzip: {e}"
            at = data.find(b"\x1f\x8b\x08", at + 1)
            if at < 0:
                return
            continue
        yield b"".join(parts), None if z.eof else "gzip: member is cut off"


def parse(content: bytes) -> dict:
    """A record's fields; ValueError says what is wrong."""
    head, mark, rest = content.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or not first.startswith("WARC/"):
        raise ValueError("no WARC header")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    n = int(fields.get("content-length", "-1"))
    if n < 0 or len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"content length {n} doesn't frame the block")
    block = rest[:n]
    if fields.get("warc-block-digest", "").removeprefix("sha1:") != base64.b32encode(hashlib.sha1(block).digest()).decode():
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:"))
    said = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), -1)
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (hashlib.sha1(payload).digest() != digest or len(payload) != said):
        raise ValueError("payload digest or length differs")
    name = lambda k: fields[k].removeprefix("<urn:page:").removesuffix(">") if fields.get(k) else None
    return {"page_id": name("warc-record-id") or None, "record_type": fields["warc-type"], "url": fields.get("warc-target-uri"), "payload_bytes": said, "payload_digest": digest.hex(), "refers_to": name("warc-refers-to") or None, "payload": None if revisit else payload}


def read_archive(data: bytes) -> Iterator[dict]:
    for i, (content, error) in enumerate(members(data)):
        try:
            if error:
                raise ValueError(error)
            yield {"record": i, "error": None} | parse(content)
        except (ValueError, KeyError) as e:
            yield {"record": i, "error": f"{type(e).__name__}: {e}"}


def revisits(pages: DataFrame, payload: str = "html") -> DataFrame:
    """page_id, url and payload with ``refers_to``: the largest id of equal payloads, for all but that one."""
    rows = pages.select("page_id", "url", F.coalesce(payload, F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("_digest", F.sha1("payload"))
    long = F.octet_length("payload") >= REVISIT_BYTES
    groups = rows.where(long).groupBy("_digest").agg(F.max("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    joined = lookup_join(rows, groups, ["_digest"], F.monotonically_increasing_id())
    other: Column = long & F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select("page_id", "url", "payload", F.when(other, F.col("_first")).alias("refers_to"))


def write_warc(rows: DataFrame) -> DataFrame:
    """Archives of rows (page_id, url, payload, refers_to): name, number of records and content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n, size, held = TaskContext.get().partitionId(), 0, 0, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"part-{part:06d}-{n:05d}.warc.gz"]), pa.array([len(held)], pa.int64()), pa.array([b"".join(held)], pa.binary())], names=["archive", "n_records", "content"])

        for whole in batches:
            for b in pieces(whole, "payload"):
                for i, u, p, r in zip(b.column("page_id"), b.column("url"), b.column("payload"), b.column("refers_to"), strict=True):
                    held.append(record(i.as_py(), u.as_py() or "", p.as_py() or b"", r.as_py()))
                    size += len(held[-1])
                    if size >= ARCHIVE_BYTES:
                        yield out()
                        n, size, held = n + 1, 0, []
        if held:
            yield out()

    typed = rows.select(F.col("page_id").cast("string"), "url", F.col("payload").cast("binary"), F.col("refers_to").cast("string"))
    return typed.mapInArrow(run, "archive string, n_records long, content binary")


def read_warc(archives: DataFrame) -> DataFrame:
    """One row a record of the archives (archive, content), as READ lists."""
    kinds = pa.schema([("archive", pa.string()), ("record", pa.int64()), ("page_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("archive").to_pylist(), b.column("content"), strict=True):
                held, size = [], 0
                for r in read_archive(content.as_py() or b""):
                    held.append(r | {"archive": name})
                    size += len(r.get("payload") or b"")
                    if size >= 4 << 20 or len(held) >= 5000:
                        yield pa.RecordBatch.from_pylist(held, schema=kinds)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=kinds)

    return archives.select("archive", "content").mapInArrow(run, READ)


def archived_pages(pages: DataFrame) -> DataFrame:
    """The contract's rows: pages written to archives in the shared folder and read back."""
    kind = dict(pages.dtypes)["page_id"]
    archives = table(write_warc(revisits(pages)), codec="none")
    records = read_warc(archives)
    broken = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("broken record: "), "error")))
    return records.where(broken.isNull()).select(F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind), "url")


SQL = """WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN strlen(html) >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(html) >= 1000 AND page_id <> first_id THEN first_id END AS refers_to, trim(regexp_replace(url, '\\s+', ' ', 'g')) AS url FROM g"""
