"""WARC archives: a deterministic sharded writer and its reader.

Records are range-sorted by page id; each task writes its range as a run of
gzip files (one member per record) and starts a new file once the compressed
size passes ``roll_bytes``. Headers and digests are regenerated from the
payload, so equal input gives equal files. A file is written under a temporary
name of its task attempt and renamed when complete; the manifest that Spark
writes afterwards is the commit, and readers open only files it lists.

Scale: payloads cross the network once (the range shuffle). Which record of a
group of equal payloads is the response is decided on digests alone, with
map-side combine, and a hot payload's ids join back under skew handling.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import prepare, column_bytes, scratch, shuffle_partitions, text_or_empty

_MANIFEST = "file string, n_records long, n_bytes long, sha256 string"
_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                     ("payload", pa.binary())])
_RECORD_DDL = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
               "refers_to long, payload binary")
_SPACE = uuid.UUID("6f1c0f1e-9d0b-5a4e-8f43-2a8f4ad0c7aa")
_LINE = re.compile(rb"[\r\n]+")


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page}/{digest}/{copy}')}>"


def record(page, url: bytes, payload: bytes, refers_to: int | None, copy: int, date: str) -> bytes:
    """One record's bytes: a response with the payload, or a revisit (with ``refers_to``) without it."""
    digest = _digest(payload)
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [b"WARC/1.1",
            b"WARC-Type: " + (b"revisit" if revisit else b"response"),
            b"WARC-Record-ID: " + _record_id(page, digest, copy).encode(),
            b"WARC-Date: " + date.encode(),
            b"WARC-Target-URI: " + _LINE.sub(b" ", url)]
    if page is not None:
        head.append(b"WARC-Page-ID: %d" % page)
    if revisit:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 b"WARC-Refers-To: " + _record_id(refers_to, digest, 0).encode(),
                 b"WARC-Refers-To-Page-ID: %d" % refers_to]
    head += [b"WARC-Payload-Digest: sha1:" + digest.encode(),
             b"WARC-Block-Digest: sha1:" + _digest(block).encode(),
             b"Content-Type: application/http;msgtype=response",
             b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Files:
    """The files of one task: rolled by compressed size, renamed when complete."""

    def __init__(self, folder: str, roll_bytes: int):
        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.shard, self.attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:8]
        self.roll_bytes, self.count, self.out, self.done = roll_bytes, 0, None, []
        self.store.create_dir(f"{self.root}/_temporary", recursive=True)

    def add(self, raw: bytes) -> None:
        if self.out is None:
            self.name = f"pages-{self.shard:06d}-{self.count:05d}.warc.gz"
            self.temp = f"{self.root}/_temporary/{self.attempt}-{self.name}"
            self.out, self.records, self.size, self.sha = self.store.open_output_stream(self.temp, compression=None), 0, 0, hashlib.sha256()
        packer = zlib.compressobj(3, zlib.DEFLATED, 31)    # a gzip member without name and time
        member = packer.compress(raw) + packer.flush()
        self.out.write(member)
        self.sha.update(member)
        self.records, self.size = self.records + 1, self.size + len(member)
        if self.size >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.store.move(self.temp, f"{self.root}/{self.name}")
            self.done.append((self.name, self.records, self.size, self.sha.hexdigest()))
            self.out, self.count = None, self.count + 1


def _write(folder: str, roll_bytes: int, min_bytes: int, date: str):
    def write(batches):
        files = _Files(folder, roll_bytes)
        at, refers, copies = object(), {}, {}
        for batch in batches:
            page, first, key = (batch.column(k).to_pylist() for k in (0, 1, 2))
            url, payload = ((d.tobytes(), o.tolist()) for d, o in (column_bytes(batch.column(k)) for k in (3, 4)))
            for i, p in enumerate(page):
                if p != at:
                    at, refers, copies = p, {}, {}
                if key[i] is not None:            # a reference: it comes before the pages of its id
                    refers[key[i]] = first[i]
                    continue
                body = payload[0][payload[1][i]:payload[1][i + 1]]
                digest = hashlib.sha256(body).digest()
                copy = copies[digest] = copies.get(digest, -1) + 1
                known = refers.get(digest)
                revisit = known is not None and len(body) >= min_bytes and (known != p or copy > 0)
                files.add(record(p, url[0][url[1][i]:url[1][i + 1]], body, known if revisit else None, copy, date))
        files.close()
        if files.done:
            name, n, size, sha = zip(*files.done)
            yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(n, pa.int64()), pa.array(size, pa.int64()),
                                              pa.array(sha)], names=["file", "n_records", "n_bytes", "sha256"])
    return write


def write_warc(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               roll_bytes: int = 64 << 20, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row of ``df`` and return the manifest.

    Of rows with equal payloads (of ``min_bytes`` or more) the one with the
    smallest page id is a response and the others are revisits of it; of rows
    that repeat that id too, one is the response. A null payload or url is
    empty; rows with a null id are written first, as responses. Only the three
    named columns are read; an empty table gives an empty manifest.
    """
    spark = df.sparkSession
    prepare(spark)
    pages = df.select(F.col(id_col).cast("long").alias("page"), text_or_empty(url_col).alias("url"),
                      F.encode(text_or_empty(payload_col), "UTF-8").alias("payload"))
    marks = (pages.where((F.octet_length("payload") >= min_bytes) & F.col("page").isNotNull())
             .select("page", F.unhex(F.sha2("payload", 256)).alias("key")))
    groups = marks.groupBy("key").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    refers = marks.join(groups, "key").select("page", "first", "key").distinct()
    both = (refers.select("page", "first", "key", F.lit("").alias("url"), F.lit(b"").alias("payload"))
            .unionByName(pages.select("page", F.lit(None).cast("long").alias("first"),
                                      F.lit(None).cast("binary").alias("key"), "url", "payload")))
    ordered = (both.repartitionByRange(shuffle_partitions(spark), "page")
               .sortWithinPartitions("page", F.col("key").asc_nulls_last(), "url", "payload"))
    ordered.mapInArrow(_write(folder, roll_bytes, min_bytes, date), _MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def members(stream, step: int = 1 << 20):
    """The gzip members of a file, one after the other, each as bytes."""
    rest = b""
    while True:
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            piece = rest or stream.read(step)
            if not piece:
                if parts:
                    raise ValueError("the archive ends within a record")
                return
            parts.append(unpack.decompress(piece))
            rest = b""
        rest = unpack.unused_data
        yield b"".join(parts)


def parse(raw: bytes) -> tuple:
    """page_id, url, type, payload bytes, payload digest, refers_to, payload of a record; its digests are checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != b"WARC/1.1":
        raise ValueError("not a WARC record")
    field = {k: v for k, _, v in (x.partition(b": ") for x in lines[1:])}
    block = rest[:int(field[b"Content-Length"])]
    if field[b"WARC-Block-Digest"] != b"sha1:" + _digest(block).encode():
        raise ValueError("the block does not match its digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = field[b"WARC-Payload-Digest"].decode().removeprefix("sha1:")
    kind = field[b"WARC-Type"].decode()
    if kind == "response" and digest != _digest(payload):
        raise ValueError("the payload does not match its digest")
    page, refers = field.get(b"WARC-Page-ID"), field.get(b"WARC-Refers-To-Page-ID")
    return (None if page is None else int(page), field[b"WARC-Target-URI"].decode(), kind, size, digest,
            None if refers is None else int(refers), payload if kind == "response" else None)


def read_warc(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the files that the manifest lists (payload null for revisits, or where not asked for)."""

    def read(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for raw in members(stream):
                        row = parse(raw)
                        rows.append(row if payloads else (*row[:-1], None))
                        size += len(raw) if payloads else 0
                        if len(rows) >= 1000 or size > 8 << 20:
                            yield _rows(rows)
                            rows, size = [], 0
                if rows:
                    yield _rows(rows)

    files = manifest.select("file").repartition(shuffle_partitions(manifest.sparkSession), "file")
    return files.mapInArrow(read, _RECORD_DDL)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), _RECORD.types)], schema=_RECORD)


def archive(df: DataFrame, **options) -> DataFrame:
    """Write ``df`` below the shared folder and return the records read back, without payloads."""
    folder = scratch(df.sparkSession, "warc")
    folder = folder if "://" in folder else f"file://{folder}"
    return read_warc(write_warc(df, folder, **options), folder, payloads=False)
