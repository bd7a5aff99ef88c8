"""Token-id output: flat unsigned integer files, 64-bit document offsets, memory-mapped reads.

A shard is three files: ``.bin`` (ids as little-endian unsigned integers, two
bytes wide where the vocabulary allows), ``.idx`` (int64 offsets of the
documents in the shard, one more than documents) and ``.doc`` (int64 document
ids, then one validity byte each). Shards are ranges of ascending document id;
a shard's base (ids before it in the whole corpus) is the prefix sum of the
shard sizes in the manifest.

Scale: one range shuffle of the texts; a task streams its shard, so memory is
one batch plus 16 bytes a document. Files get temporary names of the task
attempt and are renamed when complete; the manifest, written by Spark, is the
commit and the only way to find shards, so a lost executor or a second attempt
leaves no half shard in it.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import prepare, chunks, column_bytes, scratch, shuffle_partitions, text_or_empty
from .lexer import distinct, fast_rows, pretokens, spread

_MANIFEST = "shard int, n_docs long, n_tokens long, width int"
#: words a worker remembers the library's ids of; beyond it the memory starts anew (results are the same)
_MEMORY = 400_000


class LibraryEncoder:
    """ids as the tokenizers library gives them, each distinct word asked once."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        n = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if n <= 1 << 16 else 4
        self.ends = np.zeros(n, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith("</w>")
        self.known: dict[int, bytes] = {}

    def _ask(self, words: list[str]) -> list[bytes]:
        """ids of each word as bytes: words apart by a space never merge, and a word's last id ends a word."""
        out = []
        for a in range(0, len(words), 2000):
            part = words[a:a + 2000]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(stops) == len(part):
                raw = ids.tobytes()
                out += [raw[x:y] for x, y in zip([0, *stops], stops)]
            else:
                out += [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in part]
        return out

    def batch(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All documents' ids in one array, and each document's bounds in it."""
        fast = fast_rows(data, off)
        if not fast.all():
            parts, raw = [], data.tobytes()
            for i in range(len(off) - 1):
                if fast[i]:
                    ids, _ = self._latin(data[off[i]:off[i + 1]], np.array([0, off[i + 1] - off[i]]))
                else:
                    text = raw[off[i]:off[i + 1]].decode("utf-8", "replace")
                    ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                parts.append(ids)
            return (np.concatenate(parts).astype(np.uint32),
                    np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64))
        return self._latin(data, off)

    def _latin(self, data, off):
        low, starts, lens, first = pretokens(data, off)
        hashes, example, number = distinct(low, starts, lens)
        keys = hashes.tolist()
        if len(self.known) > _MEMORY:
            self.known.clear()
        known = self.known
        new = [k for k, h in enumerate(keys) if h not in known]
        if new:
            raw = low.tobytes()
            at, size = starts[example], lens[example]
            words = [raw[at[k]:at[k] + size[k]].decode() for k in new]
            known.update(zip([keys[k] for k in new], self._ask(words)))
        pool = [known[h] for h in keys]
        size = np.fromiter(map(len, pool), np.int64, len(pool)) >> 2
        ids = np.frombuffer(b"".join(pool), "<u4")
        where, bounds = spread(np.cumsum(size) - size, size, number, first)
        return ids[where], bounds


_ENCODERS: dict[str, LibraryEncoder] = {}


def _encoder(vocabulary: str) -> LibraryEncoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = LibraryEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def _write(folder: str, vocabulary: str, end_id: int | None):
    def write(batches):
        store, root = fs.FileSystem.from_uri(folder)
        shard, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:8]
        coder = _encoder(vocabulary)
        dtype = np.dtype("<u2" if coder.width == 2 else "<u4")
        store.create_dir(f"{root}/_temporary", recursive=True)
        temp = {x: f"{root}/_temporary/{shard:06d}-{attempt}.{x}" for x in ("bin", "idx", "doc")}
        sizes, ids = [], []
        with store.open_output_stream(temp["bin"]) as out:
            for batch in batches:
                data, off = column_bytes(batch.column(1))
                ids += batch.column(0).to_pylist()
                for i, j, part, po in chunks(data, off):
                    tokens, bounds = coder.batch(part, po)
                    if end_id is not None:
                        tokens = np.insert(tokens, bounds[1:], end_id)
                        bounds = bounds + np.arange(len(bounds))
                    sizes.append(np.diff(bounds))
                    out.write(tokens.astype(dtype).tobytes())
        if not ids:
            store.delete_file(temp["bin"])
            return
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype("<i8")
        with store.open_output_stream(temp["idx"]) as out:
            out.write(offsets.tobytes())
        with store.open_output_stream(temp["doc"]) as out:
            out.write(np.array([0 if x is None else x for x in ids], "<i8").tobytes())
            out.write(np.array([x is not None for x in ids], "u1").tobytes())
        for x, path in temp.items():
            store.move(path, f"{root}/{shard:06d}.{x}")
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(ids)], pa.int64()),
                                          pa.array([int(offsets[-1])], pa.int64()), pa.array([dtype.itemsize], pa.int32())],
                                         names=["shard", "n_docs", "n_tokens", "width"])

    return write


def write_token_files(df: DataFrame, folder: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int | None = None, shards: int | None = None) -> DataFrame:
    """Encode ``df`` into ``folder`` and return its manifest (one row per shard, with ``base``).

    Texts are encoded whole (null: empty), without special tokens; ``end_id`` is
    appended to each document. Documents are in ascending id order, null ids
    first, rows with the same id in any order. Only the two named columns are
    read. An empty table gives an empty manifest and no files.
    """
    spark = df.sparkSession
    prepare(spark)
    source = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    ordered = source.repartitionByRange(shards or shuffle_partitions(spark), "id").sortWithinPartitions("id")
    ordered.mapInArrow(_write(folder, vocabulary, end_id), _MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark, folder: str) -> DataFrame:
    """Shards with the number of ids before each; a shard holds many documents, so this table stays small."""
    shards = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def open_shard(folder: str, shard: int, width: int, n_docs: int):
    """(ids, offsets, document ids, validity) of a shard; memory-mapped on a mounted file system."""
    store, root = fs.FileSystem.from_uri(folder)
    path, dtype = f"{root}/{shard:06d}", np.dtype(f"<u{width}")

    def load(name, kind):
        if isinstance(store, fs.LocalFileSystem):
            import os

            return np.memmap(f"{path}.{name}", kind, "r") if os.path.getsize(f"{path}.{name}") else np.zeros(0, kind)
        with store.open_input_file(f"{path}.{name}") as f:
            return np.frombuffer(f.read_buffer(), kind)

    tail = load("doc", "u1")
    return load("bin", dtype), load("idx", "<i8"), tail[:8 * n_docs].view("<i8"), tail[8 * n_docs:].astype(bool)


def read_token_files(manifest: DataFrame, folder: str, step: int = 2000) -> DataFrame:
    """One row per document from the files: id, start (ids before it in the corpus), n_tokens, ids_crc32."""

    def read(batches):
        for batch in batches:
            for shard, n_docs, width, base in zip(*(batch.column(k).to_pylist() for k in range(4))):
                ids, offsets, docs, valid = open_shard(folder, shard, width, n_docs)
                for a in range(0, n_docs, step):
                    b = min(n_docs, a + step)
                    bounds = np.asarray(offsets[a:b + 1])
                    crc = [zlib.crc32(np.asarray(ids[x:y]).astype("<u4").tobytes())
                           for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.asarray(docs[a:b]), pa.int64(), mask=~np.asarray(valid[a:b])),
                        pa.array(bounds[:-1] + base), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())],
                        names=["id", "start", "n_tokens", "ids_crc32"])

    shards = manifest.select("shard", "n_docs", "width", "base").repartition(
        shuffle_partitions(manifest.sparkSession), "shard")
    return shards.mapInArrow(read, "id long, start long, n_tokens long, ids_crc32 long")


def token_digest(df: DataFrame, vocabulary: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files below the shared folder and describe each document from what is read back."""
    folder = scratch(df.sparkSession, "tokens")
    folder = folder if "://" in folder else f"file://{folder}"
    manifest = write_token_files(df, folder, vocabulary, id_col, text_col, end_id)
    return read_token_files(manifest, folder).withColumnRenamed("id", id_col)
