"""Media columns: payloads as images in tar shards; rows carry digest, offset and length; range reads fill the rest."""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftop.llm import common

#: Samples of an image's row; a payload is padded with blanks to a positive multiple of it.
WIDTH = 192
#: A shard is closed once it holds this many bytes.
SHARD_BYTES = 256 << 20
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def padded(text: bytes) -> bytes:
    """Blanks up to a positive multiple of WIDTH."""
    return text + b" " * (max(1, -(-len(text) // WIDTH)) * WIDTH - len(text))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(body, zlib.crc32(kind)))


def to_png(payload: bytes) -> bytes:
    """An 8-bit greyscale image, WIDTH wide, whose samples are the payload's bytes; rows without filter."""
    lines = b"".join(b"\0" + payload[i : i + WIDTH] for i in range(0, len(payload), WIDTH))
    head = struct.pack(">IIBBBBB", WIDTH, len(payload) // WIDTH, 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines, 1)) + _chunk(b"IEND", b"")


def png_header(head: bytes) -> tuple[int, int, int]:
    """Width, height and bits a sample from an image's first 33 bytes."""
    if head[:8] != _SIGNATURE or head[12:16] != b"IHDR":
        raise ValueError("not a PNG image")
    return struct.unpack(">IIB", head[16:25])


def from_png(media: bytes) -> bytes:
    """The samples of an image that to_png made; the chunks' checksums are verified."""
    width, height, _ = png_header(media[:33])
    at, packed = 8, []
    while at < len(media):
        (n,) = struct.unpack(">I", media[at : at + 4])
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + n]
        if zlib.crc32(body, zlib.crc32(kind)) != struct.unpack(">I", media[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("damaged PNG chunk")
        if kind == b"IDAT":
            packed.append(body)
        at += 12 + n
    lines = zlib.decompress(b"".join(packed))
    return b"".join(lines[i + 1 : i + 1 + width] for i in range(0, height * (width + 1), width + 1))


def feature(payload: bytes) -> str:
    """A difference hash: 64 bits that compare the mean samples of 65 equal stretches of the payload, in hex."""
    bounds = [len(payload) * i // 65 for i in range(66)]
    means = [sum(payload[a:b]) / (b - a) for a, b in zip(bounds, bounds[1:], strict=False)]
    bits = sum(1 << i for i in range(64) if means[i] < means[i + 1])
    return f"{bits:016x}"


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _tar_header(name: str, size: int) -> bytes:
    info = tarfile.TarInfo(name)
    info.size = size
    return info.tobuf(tarfile.USTAR_FORMAT)


class _Shards:
    """Writes tar members to new shards of a folder; a shard's name is unique to the attempt of a task."""

    def __init__(self, root: str):
        self.fs, self.root = _filesystem(root)
        self.fs.create_dir(self.root, recursive=True)
        self.out, self.name, self.at = None, "", 0

    def put(self, digest: str, media: bytes) -> tuple[str, int]:
        if self.out is None:
            self.name, self.at = f"{uuid.uuid4().hex}.tar", 0
            self.out = self.fs.open_output_stream(f"{self.root}/{self.name}")
        start = self.at + tarfile.BLOCKSIZE
        self.out.write(_tar_header(f"{digest}.png", len(media)) + media + b"\0" * (-len(media) % tarfile.BLOCKSIZE))
        self.at = start + len(media) + -len(media) % tarfile.BLOCKSIZE
        name = self.name
        if self.at >= SHARD_BYTES:
            self.close()
        return name, start

    def close(self) -> None:
        if self.out is not None:
            self.out.write(b"\0" * tarfile.BLOCKSIZE * 2)
            self.out.close()
            self.out = None


_ROWS = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("digest", pa.string()), ("shard", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
)
_META = [("media_type", pa.string()), ("width", pa.int64()), ("height", pa.int64()), ("bits", pa.int64())]
_ROWS_DDL = "doc_id long, n_bytes long, digest string, shard string, offset long, length long"


def _write(root: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stores each row's payload: doc_id, digest, body in; the row's place in a shard out."""
    shards = _Shards(root)
    for batch in batches:
        out = []
        for i, digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            body = text.as_buffer().to_pybytes()
            payload = padded(body)
            if hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"payload of {i} differs from its digest")
            media = to_png(payload)
            out.append((i, len(body), digest, *shards.put(digest, media), len(media)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, _ROWS.types, strict=True)],
            schema=_ROWS,
        )
    shards.close()


def store(docs: DataFrame, root: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes each text's payload to tar shards below root; doc_id, n_bytes, digest, shard, offset, length of every row.

    Members are named by the payload's digest, and a digest has one member. Digests of all rows are counted first.
    A payload that one row has is written where that row is read, without a shuffle; of one that several rows have,
    one row's text is shuffled and written, and all its rows are given that member. A repeated task writes
    new shards, and only rows of the task that counted name a shard. Null texts count as empty; repeated rows and null
    ids share members like any rows; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    body = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    fill = F.greatest(F.lit(1), F.ceil(F.octet_length(body) / WIDTH)) * WIDTH - F.octet_length(body)
    digest = F.sha2(F.concat(body, F.encode(F.repeat(F.lit(" "), fill.cast("int")), "UTF-8")), 256)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), digest.alias("digest"), body.alias("body"))
    known = common.written(rows.select("doc_id", F.octet_length("body").cast("long").alias("n_bytes"), "digest"), "digests")
    repeated = known.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first")).where("rows > 1")
    repeated = common.written(repeated, "repeated")
    few = repeated.count() <= common.BROADCAST_ROWS
    side = (lambda df: F.broadcast(df)) if few else (lambda df: df)
    write = common.tidy(lambda x: _write(root, x))
    alone = rows.join(side(repeated.select("digest")), "digest", "left_anti").select("doc_id", "digest", "body")
    alone = common.written(alone.mapInArrow(write, _ROWS_DDL), "media")
    ours = side(repeated.select(F.col("digest").alias("__digest"), F.col("first").alias("__first")))
    once = rows.join(
        ours,
        (F.col("digest") == F.col("__digest")) & F.col("doc_id").eqNullSafe(F.col("__first")),
    ).select("doc_id", "digest", "body").dropDuplicates(["digest"])
    members = common.written(once.mapInArrow(write, _ROWS_DDL), "media").join(repeated.select("digest", "rows"), "digest").select(
        "digest",
        "shard",
        "offset",
        "length",
        "rows",
    )
    many = known.join(side(repeated.select("digest")), "digest", "left_semi")
    many = common.hot_left_join(many, members, ["digest"], "rows", known.count())
    return alone.unionByName(many.select(*_ROWS.names))


def metadata(rows: DataFrame, root: str) -> DataFrame:
    """Adds media_type, width, height and bits, read from the first 33 bytes of each member."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(root)
        for batch in batches:
            heads = [
                png_header(files.read(s, o, 33)) for s, o in zip(batch.column("shard").to_pylist(), batch.column("offset").to_pylist(), strict=True)
            ]
            extra = [pa.array(["image/png"] * len(heads), pa.string()), *[pa.array([h[i] for h in heads], pa.int64()) for i in range(3)]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], schema=pa.schema([*_ROWS, *_META]))
        files.close()

    return rows.mapInArrow(common.tidy(read), f"{_ROWS_DDL}, media_type string, width long, height long, bits long")


class _Files:
    """Range reads of shards, one open at a time."""

    def __init__(self, root: str):
        self.fs, self.root = _filesystem(root)
        self.name, self.file = "", None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            self.name, self.file = name, self.fs.open_input_file(f"{self.root}/{name}")
        return self.file.read_at(length, offset)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.name, self.file = "", None


_OUT = pa.schema(
    [
        *[(n, pa.int64()) for n in ("doc_id", "n_bytes", "payload_bytes")],
        ("payload_sha256", pa.string()),
        ("tail_crc32", pa.int64()),
        ("media_bytes", pa.int64()),
        ("media_sha256", pa.string()),
        ("feature", pa.string()),
        *_META,
    ]
)
_OUT_DDL = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
    "feature string, media_type string, width long, height long, bits long"
)
#: Members whose results a task keeps, the last that it used: copies in a task are mostly decoded once.
KEPT = 1000


def features(rows: DataFrame, root: str) -> DataFrame:
    """Reads every row's member back by range, decodes it and digests the payload."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(root)

        @lru_cache(maxsize=KEPT)
        def decoded(shard: str, offset: int, length: int, digest: str) -> tuple:
            media = files.read(shard, offset, length)
            payload = from_png(media)
            if hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"{shard} at {offset} differs from its digest")
            return len(payload), digest, zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature(payload)

        for batch in batches:
            out = [
                (
                    r["doc_id"],
                    r["n_bytes"],
                    *decoded(r["shard"], r["offset"], r["length"], r["digest"]),
                    *[r[n] for n, _ in _META],
                ) for r in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * len(_OUT), _OUT.types, strict=True)],
                schema=_OUT,
            )
        files.close()

    return rows.mapInArrow(common.tidy(read), _OUT_DDL)


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = common.scratch_path(spark, "shards")
    rows = store(common.table(spark, sf_dir, "documents"), root)
    return features(metadata(rows, root), root)
