"""Media columns: ISO base media files in a binary column.

``write_media`` stores payloads losslessly as a raw 8-bit grey video track: every 192 payload bytes are one
16 x 12 frame, so a frame is one entry of the sample tables. ``read_media`` walks the nested boxes of any ISO media file, decodes the sample
tables (stsd, stts, stsc, stsz/stz2, stco/co64, stss, mdhd) and returns codec, duration and the byte ranges of the
keyframes; sample payloads are never decoded.

Cases: a null payload is stored as an empty one (one frame of spaces); a null or broken file gives nulls and a
text in ``error``; repeated rows are read one by one; extra columns pass through; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

UNIT, WIDTH, HEIGHT, TIMESCALE = 192, 16, 12, 25
#: Every so many frames one is listed in stss as a keyframe, and a chunk ends.
GROUP = 48
#: Boxes that hold boxes; stsd and dref hold entries after a header and are read apart.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta", b"mvex"}


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


def pad(data: bytes) -> bytes:
    """Spaces up to a positive multiple of UNIT."""
    return data + b" " * (-len(data) % UNIT if data else UNIT)


def build(payload: bytes) -> bytes:
    """An ISO media file whose only track holds the payload, one frame per UNIT bytes. No clock enters it."""
    n = len(payload) // UNIT
    chunks, last = divmod(n, GROUP)
    ftyp = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")
    head = struct.pack(">I4sQ", 1, b"mdat", 16 + len(payload))
    first = len(ftyp) + len(head)
    offsets = [first + i * GROUP * UNIT for i in range(chunks + bool(last))]
    runs = ([(1, GROUP)] if chunks else []) + ([(chunks + 1, last)] if last else [])
    matrix = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    entry = box(b"raw ", b"\0" * 6, struct.pack(">H", 1), b"\0" * 16, struct.pack(">HHIIIH", WIDTH, HEIGHT, 0x480000, 0x480000, 0, 1), b"\0" * 32, struct.pack(">Hh", 40, -1))
    stbl = box(
        b"stbl",
        full(b"stsd", struct.pack(">I", 1), entry),
        full(b"stts", struct.pack(">III", 1, n, 1)),
        full(b"stss", struct.pack(">I", len(offsets)), b"".join(struct.pack(">I", 1 + i * GROUP) for i in range(len(offsets)))),
        full(b"stsc", struct.pack(">I", len(runs)), b"".join(struct.pack(">III", a, k, 1) for a, k in runs)),
        full(b"stsz", struct.pack(">II", UNIT, n)),
        full(b"co64", struct.pack(">I", len(offsets)), struct.pack(f">{len(offsets)}Q", *offsets)),
    )
    dinf = box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1)))
    minf = box(b"minf", full(b"vmhd", b"\0" * 8, flags=1), dinf, stbl)
    mdia = box(b"mdia", full(b"mdhd", struct.pack(">4IHH", 0, 0, TIMESCALE, n, 0x55C4, 0)), full(b"hdlr", struct.pack(">I4s12x", 0, b"vide"), b"\0"), minf)
    tkhd = full(b"tkhd", struct.pack(">5I8xHHHH", 0, 0, 1, 0, n, 0, 0, 0, 0), matrix, struct.pack(">II", WIDTH << 16, HEIGHT << 16), flags=3)
    mvhd = full(b"mvhd", struct.pack(">4IIH10x", 0, 0, TIMESCALE, n, 0x10000, 0x100), matrix, b"\0" * 24, struct.pack(">I", 2))
    return b"".join((ftyp, head, payload, box(b"moov", mvhd, box(b"trak", tkhd, mdia))))


def walk(data: memoryview, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, body start, body end) of the boxes between two places: 32- and 64-bit sizes, 0 for "to the end"."""
    while start + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            if start + 16 > end:
                raise ValueError("box header ends early")
            size, head = struct.unpack_from(">Q", data, start + 8)[0], 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            raise ValueError(f"box {kind!r} at {start} leaves its parent")
        yield kind, start + head, start + size
        start += size
    if start != end:
        raise ValueError("bytes left after the last box")


def track(data: memoryview, start: int, end: int, found: dict) -> dict:
    """The leaf boxes of a track by kind, from all depths."""
    for kind, a, b in walk(data, start, end):
        if kind in CONTAINERS:
            track(data, a, b, found)
        else:
            found.setdefault(kind, (a, b))
    return found


def ints(data: memoryview, at: int, end: int, n: int, code: str) -> tuple:
    if n < 0 or at + n * struct.calcsize(">" + code) > end:
        raise ValueError("sample table ends early")
    return struct.unpack_from(f">{n * len(code)}{code[0]}", data, at)


def count(data: memoryview, leaves: dict, kind: bytes) -> int:
    return struct.unpack_from(">I", data, leaves[kind][0] + 4)[0]


def samples(data: memoryview, leaves: dict) -> list[tuple[int, int]]:
    """(offset, length) of each sample, in decoding order."""
    if b"stz2" in leaves and b"stsz" not in leaves:
        a, b = leaves[b"stz2"]
        bits, n = data[a + 7], struct.unpack_from(">I", data, a + 8)[0]
        if bits == 4:
            sizes = [x for byte in data[a + 12 : b] for x in (byte >> 4, byte & 15)][:n]
        else:
            sizes = list(ints(data, a + 12, b, n, {8: "B", 16: "H"}[bits]))
    else:
        a, b = leaves[b"stsz"]
        same, n = struct.unpack_from(">II", data, a + 4)
        sizes = [same] * n if same and n * same <= len(data) else list(ints(data, a + 12, b, n, "I"))
    wide = b"co64" in leaves
    a, b = leaves[b"co64" if wide else b"stco"]
    offsets = ints(data, a + 8, b, count(data, leaves, b"co64" if wide else b"stco"), "Q" if wide else "I")
    a, b = leaves[b"stsc"]
    runs = ints(data, a + 8, b, count(data, leaves, b"stsc"), "III")
    out: list[tuple[int, int]] = []
    for i in range(0, len(runs), 3):
        last = runs[i + 3] - 1 if i + 3 < len(runs) else len(offsets)
        for chunk in range(runs[i] - 1, last):
            at = offsets[chunk]
            for size in sizes[len(out) : len(out) + runs[i + 1]]:
                if at + size > len(data):
                    raise ValueError("a sample lies outside of the file")
                out.append((at, size))
                at += size
    if len(out) != len(sizes):
        raise ValueError("chunks and sample sizes disagree")
    return out


def inspect(content: bytes) -> dict:
    """The first track's codec, clock, samples and keyframes (all samples, where stss is absent), and how many tracks
    follow it. Samples of movie fragments are in no sample table, so a file with fragments is an error."""
    data = memoryview(content)
    top = {kind: (a, b) for kind, a, b in walk(data, 0, len(data))}
    if b"moov" not in top:
        raise ValueError("no moov box")
    inside = list(walk(data, *top[b"moov"]))
    if b"moof" in top or any(kind == b"mvex" for kind, *_ in inside):
        raise ValueError("movie fragments aren't read")
    tracks = [(a, b) for kind, a, b in inside if kind == b"trak"]
    if not tracks:
        raise ValueError("no track")
    trak = tracks[0]
    leaves = track(data, *trak, {})
    a, b = leaves[b"mdhd"]
    timescale, duration = struct.unpack_from(">IQ", data, a + 20) if data[a] == 1 else struct.unpack_from(">II", data, a + 12)
    a, b = leaves[b"stsd"]
    codec = next(kind for kind, *_ in walk(data, a + 8, b)).decode("latin-1")
    all_of = samples(data, leaves)
    a, b = leaves[b"stts"]
    times = ints(data, a + 8, b, count(data, leaves, b"stts"), "II")
    ticks = sum(times[i] * times[i + 1] for i in range(0, len(times), 2))
    keys = all_of
    if b"stss" in leaves:
        a, b = leaves[b"stss"]
        keys = [all_of[k - 1] for k in ints(data, a + 8, b, count(data, leaves, b"stss"), "I")]
    return {"codec": codec, "timescale": timescale, "duration": duration or ticks, "samples": all_of, "keyframes": keys, "further": len(tracks) - 1}


READ = T.StructType([T.StructField("codec", T.StringType()), T.StructField("timescale", T.LongType()), T.StructField("duration", T.LongType()), T.StructField("n_samples", T.LongType()), T.StructField("keyframes", T.ArrayType(T.StructType([T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())]))), T.StructField("sample_bytes", T.LongType()), T.StructField("sample_sha256", T.StringType()), T.StructField("sample_tail_crc32", T.LongType()), T.StructField("media_bytes", T.LongType()), T.StructField("media_sha256", T.StringType()), T.StructField("error", T.StringType())])


def describe(content: bytes | None) -> dict:
    """The columns of READ. ``error`` says what couldn't be read, or that further tracks aren't described."""
    out = dict.fromkeys(READ.fieldNames())
    if content is None:
        return out | {"error": "no content"}
    out |= {"media_bytes": len(content), "media_sha256": hashlib.sha256(content).hexdigest()}
    try:
        x = inspect(content)
    except (ValueError, KeyError, IndexError, StopIteration, struct.error) as e:
        return out | {"error": f"{type(e).__name__}: {e}"}
    sha, tail, at = hashlib.sha256(), b"", 0
    spans: list[list[int]] = []
    for start, size in x["samples"]:  # neighbouring samples are one span
        if spans and spans[-1][1] == start:
            spans[-1][1] += size
        else:
            spans.append([start, start + size])
    for a, b in spans:
        sha.update(content[a:b])
        tail, at = (tail + content[max(a, b - 16) : b])[-16:], at + b - a
    keys = [{"offset": a, "length": n} for a, n in x["keyframes"]]
    return out | {"codec": x["codec"], "timescale": x["timescale"], "duration": x["duration"], "n_samples": len(x["samples"]), "keyframes": keys, "sample_bytes": at, "sample_sha256": sha.hexdigest(), "sample_tail_crc32": zlib.crc32(tail), "error": f"{x['further']} further tracks aren't described" if x["further"] else None}


def pieces(batch: pa.RecordBatch, column: str, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of a column each, so that copies in Python stay small."""
    i = batch.schema.get_field_index(column)
    n = max(1, -(-batch.column(i).nbytes // most))
    step = max(1, batch.num_rows // n)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def write_media(df: DataFrame, payload: str = "payload", media: str = "media") -> DataFrame:
    """Adds ``media``: the binary or text column ``payload``, padded with spaces, as an ISO media file."""
    out = T.StructType([f for f in df.schema.fields if f.name != payload] + [T.StructField("n_bytes", T.LongType()), T.StructField(media, T.BinaryType())])
    names = [f.name for f in df.schema.fields if f.name != payload]

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole, payload):
                data = [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in b.column(payload)]
                cols = [b.column(k) for k in names]
                files = pa.array([build(pad(x)) for x in data], pa.binary())
                yield pa.RecordBatch.from_arrays([*cols, pa.array([len(x) for x in data], pa.int64()), files], names=[*names, "n_bytes", media])

    binary = df.withColumn(payload, F.col(payload).cast("binary"))
    return binary.mapInArrow(store, out)


def read_media(df: DataFrame, media: str = "media") -> DataFrame:
    """Replaces the column ``media`` by what READ lists, taken from the stored bytes. Extra columns that READ
    names are replaced."""
    names = [f.name for f in df.schema.fields if f.name != media and f.name not in READ.fieldNames()]
    out = T.StructType([df.schema[k] for k in names] + READ.fields)
    kinds = pa.schema([pa.field("codec", pa.string()), pa.field("timescale", pa.int64()), pa.field("duration", pa.int64()), pa.field("n_samples", pa.int64()), pa.field("keyframes", pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64())]))), pa.field("sample_bytes", pa.int64()), pa.field("sample_sha256", pa.string()), pa.field("sample_tail_crc32", pa.int64()), pa.field("media_bytes", pa.int64()), pa.field("media_sha256", pa.string()), pa.field("error", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole, media):
                found = pa.RecordBatch.from_pylist([describe(x.as_py()) for x in b.column(media)], schema=kinds)
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in names), *found.columns], names=[*names, *kinds.names])

    return df.select(*names, media).mapInArrow(read, out)


def media_features(docs: DataFrame) -> DataFrame:
    """The contract's rows: texts stored as media and read back. ``feature`` sums up what the reader found."""
    stored = write_media(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("payload")))
    keys = F.coalesce(F.concat_ws(";", F.transform("keyframes", lambda k: F.concat_ws("+", k["offset"], k["length"]))), F.lit(""))
    feature = F.format_string("codec=%s duration=%d/%d samples=%d keyframes=%d ranges=%08x", F.trim("codec"), "duration", "timescale", "n_samples", F.size("keyframes"), F.crc32(keys.cast("binary")))
    return read_media(stored).select("doc_id", "n_bytes", F.col("sample_bytes").alias("payload_bytes"), F.col("sample_sha256").alias("payload_sha256"), F.col("sample_tail_crc32").alias("tail_crc32"), "media_bytes", "media_sha256", feature.alias("feature"), F.trim("codec").alias("codec"), (F.col("duration") / F.col("timescale")).alias("seconds"), "keyframes")
