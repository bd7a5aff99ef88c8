"""Exact dedup by deterministic block naming.

Each normalised text is cut into blocks of a fixed number of bytes. Blocks are
sorted into integer names (equal blocks, and only those, share a name); then
adjacent names are paired and the pairs are named the same way, round after
round, until every document has one name. With the text's length that name is
the document's identity: no hash decides equality, so nothing can collide.

Scale: block bytes cross the network once, after each map task has reduced its
own blocks to distinct ones under local names; everything later moves integers.
A hot group of copies therefore costs one block a task, and its integer rows
are split by the skew join. Rounds grow with the logarithm of the longest text.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACE, prepare, chunks, column_bytes, materialize, shuffle_partitions, text_or_empty

_CUT = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("n_bytes", pa.int64()), ("sha", pa.string()),
                  ("scope", pa.int64()), ("names", pa.list_(pa.int32())), ("lname", pa.int32()), ("block", pa.binary())])
_CUT_DDL = "row long, id long, n_bytes long, sha string, scope long, names array<int>, lname int, block binary"
#: bytes of blocks that one local naming scope holds in memory
_SCOPE_BYTES = 16 << 20


def squeeze(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace each run of white space (within a document) by one space."""
    if not len(data):
        return data, off
    space = SPACE[data]
    again = np.zeros(len(data), bool)
    again[1:] = space[1:] & space[:-1]
    heads = off[:-1][off[:-1] < len(data)]
    again[heads] = False
    keep = ~again
    out = np.where(space, np.uint8(32), data)[keep]
    return out, np.concatenate([[0], np.cumsum(keep)])[off]


def _cut(block_bytes: int):
    def cut(batches):
        pid = TaskContext.get().partitionId()
        rows, scope = 0, pid << 24
        docs: list[tuple] = []
        seen: dict[bytes, int] = {}
        held = 0

        def flush():
            nonlocal scope, docs, seen, held
            if not docs:
                return
            order = {i: rank for rank, i in enumerate(seen[b] for b in sorted(seen))}
            blocks = sorted(seen)
            n, m = len(docs), len(blocks)
            row, ident, size, sha, names = zip(*docs)
            yield pa.RecordBatch.from_arrays([
                pa.array(list(row), pa.int64()), pa.array(list(ident), pa.int64()), pa.array(list(size), pa.int64()),
                pa.array(list(sha), pa.string()), pa.array([scope] * n, pa.int64()),
                pa.array([[order[i] for i in x] for x in names], pa.list_(pa.int32())),
                pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=_CUT)
            step = max(1, (4 << 20) // block_bytes)
            for a in range(0, m, step):
                part = blocks[a:a + step]
                k = len(part)
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.string()),
                    pa.array([scope] * k, pa.int64()), pa.nulls(k, pa.list_(pa.int32())),
                    pa.array(range(a, a + k), pa.int32()), pa.array(part, pa.binary())], schema=_CUT)
            scope, docs, seen, held = scope + 1, [], {}, 0

        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, off = column_bytes(batch.column(1))
            for i, j, part, po in chunks(data, off):
                part, po = squeeze(part, po)
                raw = part.tobytes()
                for k in range(j - i):
                    text = raw[po[k]:po[k + 1]]
                    names = []
                    for a in range(0, max(1, len(text)), block_bytes):
                        block = text[a:a + block_bytes]
                        if block not in seen:
                            held += len(block) + 64
                        names.append(seen.setdefault(block, len(seen)))
                    docs.append(((pid << 40) + rows, ids[i + k], len(text), hashlib.sha256(text).hexdigest(), names))
                    rows += 1
                if held > _SCOPE_BYTES or len(docs) > 50_000:
                    yield from flush()
        yield from flush()

    return cut


def _named(distinct: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Integer names by sorting: equal keys, and only those, get one ``name``."""
    bucket: Column = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    ranked = distinct.withColumn("bucket", bucket)
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*keys))
    return ranked.withColumn("name", F.shiftleft(F.col("bucket"), 36) + rank).drop("bucket")


def identities(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 4096) -> DataFrame:
    """One row per input row: row (own number), id, n_bytes, sha, name; equal texts share (n_bytes, name)."""
    spark = df.sparkSession
    prepare(spark)
    buckets = 8 * shuffle_partitions(spark)
    source = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    table = materialize(source.mapInArrow(_cut(block_bytes), _CUT_DDL), "blocks")
    rows = table.where("row IS NOT NULL").select("row", "id", "n_bytes", "sha", "scope", "names")

    blocks = table.where("row IS NULL").select("scope", "lname", "block")
    names = _named(blocks, ["block"], buckets).select("scope", "lname", "name")
    local = rows.select("row", "scope", F.posexplode("names").alias("i", "lname"))
    state = materialize(_regroup(local.join(names, ["scope", "lname"])), "names-0")

    longest = rows.agg(F.max("n_bytes")).first()[0] or 0
    rounds = max(0, math.ceil(math.log2(max(1, math.ceil(longest / block_bytes)))))
    done = [state.where(F.size("names") == 1).select("row", F.element_at("names", 1).alias("name"))]
    for k in range(rounds):
        many = state.where(F.size("names") > 1)
        pairs = many.select("row", F.posexplode(F.transform(
            F.sequence(F.lit(1), F.size("names"), F.lit(2)),
            lambda p: F.struct(F.element_at("names", p).alias("a"),
                               F.coalesce(F.try_element_at("names", p + 1), F.lit(-1)).alias("b")))).alias("i", "p"))
        pairs = pairs.select("row", "i", "p.a", "p.b")
        named = _named(pairs.select("a", "b").distinct(), ["a", "b"], buckets)
        state = materialize(_regroup(pairs.join(named, ["a", "b"])), f"names-{k + 1}")
        done.append(state.where(F.size("names") == 1).select("row", F.element_at("names", 1).alias("name")))
    final = done[0]
    for part in done[1:]:
        final = final.unionByName(part)
    return rows.drop("scope", "names").join(final, "row")


def _regroup(named: DataFrame) -> DataFrame:
    """Names of a document in block order; a document of one block needs no shuffle of others."""
    lists = named.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("i", "name"))).alias("x"))
    return lists.select("row", F.col("x.name").alias("names"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 4096) -> DataFrame:
    """Which row of each group of equal texts stays.

    Texts are compared after each run of [\\x20\\x09-\\x0D] became one space; null
    counts as empty, and empty texts form a group. Of equal texts the row with
    the smallest id stays (a null id counts as largest; of rows with the same
    id one stays). Other columns are not read. Returns one row per input row:
    id, keep_id, group_size, kept, text_sha256. An empty table gives no rows.
    """
    rows = materialize(identities(df, id_col, text_col, block_bytes), "identities")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))
    groups = rows.groupBy("n_bytes", "name").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
    return (rows.join(groups, ["n_bytes", "name"])
            .select(F.col("id").alias(id_col), F.col("first.id").alias("keep_id"), "group_size",
                    (F.col("row") == F.col("first.row")).alias("kept"), F.col("sha").alias("text_sha256")))
