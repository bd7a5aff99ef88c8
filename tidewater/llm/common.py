"""Helpers shared by the training-data operators: stage tables and Arrow columns as numpy arrays."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.session import checkpoint_dir

#: bytes of text that one numpy step works on (temporaries are about 40 times that)
CHUNK = 1 << 19


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder path below the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tidewater-{uuid.uuid4().hex[:12]}/{name}"


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, so that a batch of long texts fits a Python worker; the package on the workers' path."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > 1000:
        spark.conf.set(key, "1000")
    context, root = spark.sparkContext, Path(__file__).resolve().parents[2]
    known = [Path.cwd(), *map(Path, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep)))]
    if root in known or getattr(context, "_tidewater_shipped", False):
        return
    context._tidewater_shipped = True
    path = Path(tempfile.mkdtemp(prefix="tidewater-code-")) / "tidewater-code.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in (root / "tidewater").rglob("*.py"):
            z.write(f, f.relative_to(root))
    context.addPyFile(str(path))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Drop what the driver no longer refers to, so that Spark removes the shuffle files of finished steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as (uint8 data, int64 offsets); nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(data: np.ndarray, off: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split documents into runs of about ``limit`` bytes: (first, last+1, bytes, offsets)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i]+lens[i]-1, one run after the other."""
    total = int(lens.sum())
    first = np.cumsum(lens) - lens
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, lens)


# -- hashing ---------------------------------------------------------------

_MULT = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of a fixed odd multiplier, modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS), 1024)
        step = np.full(size, _MULT, np.uint64)
        step[0] = 1
        _POWERS = np.cumprod(step, dtype=np.uint64)
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (shift, multiply), element by element."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def runs(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal True runs of ``mask`` that do not cross a document's border."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mask[:-1]
    starts = np.flatnonzero(mask & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mask[1:]
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    return starts, ends


#: bytes over which running sums of hashes go before their weights start anew
_RUN = 1 << 20
_INVERSE = np.uint64(pow(int(_MULT), -1, 1 << 64))
_RUN_WEIGHTS: list[np.ndarray] = []


def _run_weights() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, one for each byte of a run."""
    if not _RUN_WEIGHTS:
        back = np.full(_RUN, _INVERSE, np.uint64)
        back[0] = 1
        _RUN_WEIGHTS.extend([powers(_RUN)[:_RUN], np.cumprod(back, dtype=np.uint64)])
    return _RUN_WEIGHTS[0], _RUN_WEIGHTS[1]


def _gathered_sums(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    first = np.cumsum(lens) - lens
    pos = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(first, lens)
    vals = data[np.repeat(starts, lens) + pos].astype(np.uint64)
    vals += np.uint64(1)
    vals *= powers(int(lens.max()))[pos]
    return np.add.reduceat(vals, first)


def span_hash(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty byte span: a polynomial of its bytes, from differences of a running sum where spans are dense."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    if 4 * int(lens.sum()) < len(data):
        sums = _gathered_sums(data, starts, lens)
    else:
        forward, back = _run_weights()
        running = np.zeros(len(data) + 1, np.uint64)
        for a in range(0, len(data), _RUN):
            part = data[a:a + _RUN].astype(np.uint64)
            part += np.uint64(1)
            part *= forward[:len(part)]
            np.cumsum(part, out=running[a + 1:a + 1 + len(part)])
            if a:
                running[a + 1:a + 1 + len(part)] += running[a]
        sums = (running[starts + lens] - running[starts]) * back[starts % _RUN]
        across = np.flatnonzero(starts // _RUN != (starts + lens - 1) // _RUN)
        if len(across):                            # spans over the border of two runs: weights differ there
            sums[across] = _gathered_sums(data, starts[across], lens[across])
    return mix(sums + lens.astype(np.uint64) * _MULT)


#: bytes that separate words: ASCII white space
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: bytes that separate tokens where punctuation does not count
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:128] = True
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
#: ASCII capitals to small letters
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, off: np.ndarray, separators: np.ndarray = SPACE):
    """Words of all documents: (starts, lens, words before each document's first)."""
    starts, ends = runs(~separators[data], off)
    return starts, ends - starts, np.searchsorted(starts, off)


# -- groups in sorted partitions, components, fixed-size filters ------------------


def whole_groups(batches, keys: list[str], rows: int = 20_000, size: int = 24 << 20) -> Iterator[pa.Table]:
    """Tables of whole groups from a partition sorted by the integer columns ``keys``."""
    held, n, held_bytes, need_rows, need_bytes = [], 0, 0, rows, size
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n, held_bytes = n + batch.num_rows, held_bytes + batch.nbytes
        if n < need_rows and held_bytes < need_bytes:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        new = np.zeros(n - 1, bool)
        for k in keys:
            v = table.column(k).to_numpy()
            new |= v[1:] != v[:-1]
        cut = np.flatnonzero(new)
        if not len(cut):                       # one group that has not ended: look again when there is twice as much
            need_rows, need_bytes = max(need_rows, 2 * n), max(need_bytes, 2 * held_bytes)
            continue
        at = int(cut[-1]) + 1
        yield table.slice(0, at)
        rest = table.slice(at)
        held, n, held_bytes = rest.to_batches(), rest.num_rows, held_bytes * rest.num_rows // max(n, 1)
        need_rows, need_bytes = rows, size
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def group_numbers(table: pa.Table, keys: list[str]) -> np.ndarray:
    """0, 1, 2 ... for the groups of a sorted table."""
    new = np.zeros(table.num_rows, np.int64)
    for k in keys:
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.cumsum(new)


def smallest_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each of n nodes, the smallest node that links (a, b) lead to."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def components(edges: DataFrame, name: str, most_rounds: int = 200) -> DataFrame:
    """node and root (the smallest node of its component) for the long columns u, v; nodes without an edge are left out.

    Large-star and small-star rounds (Kiveris et al. 2014): a round needs a
    minimum by node, with map-side combine, and one join; rounds grow with the
    logarithm of the number of nodes. They end when a round changes no edge;
    beyond ``most_rounds`` it raises. Nothing is gathered on the driver.
    """
    edges = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    for k in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.withColumnRenamed("m", "v")).where("u <> v").distinct())
        before, edges = edges, materialize(small, f"{name}-{k}")
        if edges.count() == before.count() and edges.join(before, ["u", "v"], "left_anti").isEmpty():
            break
    else:
        raise RuntimeError(f"components of {name} did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


FILTER_BITS = 25


def bit_filter(df: DataFrame, hash_col: str) -> np.ndarray:
    """A table of 2**FILTER_BITS bits (4 MB at any input size) in which the bits of all hashes are set.

    It only turns rows away early; an exact join follows. When it fills up it
    turns fewer away.
    """
    bit = F.col(hash_col).bitwiseAND((1 << FILTER_BITS) - 1)
    words = (df.select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, cast({hash_col} & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toPandas())
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[words.w.to_numpy(np.int64)] = words.b.to_numpy(np.int64).view(np.uint64)
    return out


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    h = hashes.view(np.uint64) if hashes.dtype != np.uint64 else hashes
    slot = h & np.uint64((1 << FILTER_BITS) - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)) > 0


def tiled(df: DataFrame, key: str, member: str, tiles: str) -> DataFrame:
    """Rows dealt to pairs of tiles (a <= b) of their group, so that any two members meet in exactly one pair.

    A group of n rows in k tiles makes k * n rows for k * (k + 1) / 2 tasks'
    worth of work. Adds a, b and left (whether the row is of tile a).
    """
    t = F.pmod(F.xxhash64(key, member), F.col(tiles)).cast("int")
    return (df.withColumn("t", t).withColumn("o", F.explode(F.sequence(F.lit(0), F.col(tiles).cast("int") - 1)))
            .withColumn("a", F.least("t", "o")).withColumn("b", F.greatest("t", "o"))
            .withColumn("left", F.col("t") == F.col("a")).drop("t", "o"))
