"""Hard-negative mining by slot-decomposed selection.

Each anchor has a few positives: the best-scored other rows of its label. For
each of them the hardest negatives are wanted whose score lies in a window below
the positive's own score. The windows of one anchor overlap; their upper limits
split the scores into disjoint slots. One pass keeps the first k rows of each
slot, and merging the slots from a window's own one downwards gives the first k
below its limit; what lies below the window's lower limit is the end of that list
and is cut off. So all windows of an anchor are answered from one set of slots,
and a row is looked at once for each anchor, not once for each window.

Scores are exact integers: components are floor(scale * x).

Scale: anchors are a stated query set, dealt into blocks of bounded size; a block
is broadcast and all rows are scanned against it. A task keeps k rows a slot and
anchor, whatever number of rows it reads, and rows are read in as many tasks as
the cluster has cores, so what is shuffled grows with the anchors alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize, prepare, scratch

#: anchors of a block, and bytes of their vectors
BLOCK_ROWS, BLOCK_BYTES = 8192, 16 << 20
#: scores of a step: anchors times rows
_STEP = 1 << 20
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_HUGE = float(np.finfo(np.float64).max)
_PART = "anchor long, slot int, score long, other long"


def taking_part(df: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """id, label and v (the vector) of the rows that take part."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    whole = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (df.where(F.col(f"`{id_col}`").isNotNull() & label.isNotNull() & F.col(f"`{vector_col}`").isNotNull() & whole)
            .select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("v")))


def _blocks(anchors: DataFrame, block_rows: int) -> DataFrame:
    """Anchors with the number of their block: (task, count within it)."""
    parts = max(1, -(-anchors.count() * 6 // (5 * block_rows)))

    def number(batches):
        from pyspark import TaskContext

        block, rows, size, me = 0, 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            lens = np.diff(batch.column(2).offsets.to_numpy())
            out = np.zeros(batch.num_rows, np.int64)
            for k, n in enumerate(lens.tolist()):
                if rows and (rows >= block_rows or size + 8 * n > BLOCK_BYTES):
                    block, rows, size = block + 1, 0, 0
                rows, size = rows + 1, size + 8 * n
                out[k] = me << 40 | block
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=["id", "label", "v", "block"])

    return materialize(anchors.repartition(parts).mapInArrow(number, "id long, label long, v array<double>, block long"), "hard-anchors")


def scaled(lists: pa.Array, width: int, scale: float) -> np.ndarray:
    """floor(scale * x) of all vectors, as rows of a matrix; shorter ones are filled with zeros, longer ones cut (the rest meets only zeros)."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    off = lists.offsets.to_numpy().astype(np.int64)
    flat, lens = lists.values.to_numpy(zero_copy_only=False), np.diff(off)
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(flat * scale), -_HUGE, _HUGE)
    if (lens == width).all():
        return flat[off[0]:off[-1]].reshape(len(lens), width)
    out = np.zeros((len(lens), width))
    for k, (a, n) in enumerate(zip(off.tolist(), np.minimum(lens, width).tolist())):
        out[k, :n] = flat[a:a + n]
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of a and b, held at the ends of 64 bits beyond them."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in m.tolist()] for m in (a, b)]      # rare: numbers of any length
    return np.array([[min(max(sum(x * y for x, y in zip(p, q)), _LEAST), _MOST) for q in whole[1]] for p in whole[0]], np.int64)


class SlotTop:
    """The first ``k`` rows by (score descending, id) of each slot of each anchor, kept while rows stream by."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.slots, self.k = slots, k
        self.group = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.other = np.zeros(0, np.int64)
        self.least = np.full(anchors * slots, _LEAST, np.int64)       # the k-th score of a full slot

    def add(self, anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, other: np.ndarray) -> None:
        group = anchor * self.slots + slot
        ok = score >= self.least[group]
        if not ok.any():
            return
        group, score = np.concatenate([self.group, group[ok]]), np.concatenate([self.score, score[ok]])
        other = np.concatenate([self.other, other[ok]])
        order = np.lexsort((other, ~score, group))                    # ~score falls as score rises and never overflows
        group, score, other = group[order], score[order], other[order]
        start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        rank = np.arange(len(group)) - np.repeat(start, np.diff(np.append(start, len(group))))
        keep = rank < self.k
        full = rank == self.k - 1
        self.group, self.score, self.other = group[keep], score[keep], other[keep]
        self.least[group[full]] = score[full]

    def batch(self, ids: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids[self.group // self.slots]), pa.array((self.group % self.slots).astype(np.int32)),
                                           pa.array(self.score), pa.array(self.other)], names=["anchor", "slot", "score", "other"])


def _scan(rows: DataFrame, shared, slots: int, k: int, scale: float, slot_of) -> DataFrame:
    """The first k rows of each slot of each task, for the anchors of a broadcast block."""
    def run(batches):
        ids, labels, vectors, limits = shared.value
        top = SlotTop(len(ids), slots, k)
        for batch in batches:
            step = max(1, _STEP // max(1, len(ids)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                other, label = part.column(0).to_numpy(), part.column(1).to_numpy()
                score = inner(vectors, scaled(part.column(2), vectors.shape[1], scale))
                slot = slot_of(score, ids[:, None], labels[:, None], other[None, :], label[None, :], limits)
                a, r = np.nonzero(slot >= 0)
                top.add(a, slot[a, r].astype(np.int64), score[a, r], other[r])
        yield top.batch(np.arange(len(ids)))

    tasks = rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(tasks).mapInArrow(run, _PART)


def _positive(score, anchor, label, other, other_label, _):
    return np.where((label == other_label) & (anchor != other), 0, -1)


def _negative(score, anchor, label, other, other_label, limits):
    """The last window whose upper limit holds the score, if its lower limit, the lowest of the windows that reach it, does too."""
    low, high = limits                                                # by anchor and positive; limits fall from left to right
    slot = np.full(score.shape, -1, np.int8)
    for k in range(high.shape[1]):
        slot += score <= high[:, k, None]
    ok = (slot >= 0) & (label != other_label)
    reach = np.take_along_axis(low, np.maximum(slot, 0).astype(np.int64), axis=1)
    return np.where(ok & (score >= reach), slot, -1)


def window_limits(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer n with low * score <= 100 * n <= high * score, without overflow."""
    tens, ones = score // 100, score % 100
    return tens * low + -(-(ones * low) // 100), tens * high + (ones * high) // 100


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
                   anchor: Column | None = None, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   scale: float = 256.0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.

    ``anchor`` is the condition on ``id`` and ``label`` that makes a row an anchor (an id divisible by 100 unless given). Its
    positives are the first ``positives`` other rows of its label, by score, then
    id; for each, the first ``negatives`` rows of other labels with
    low % * positive score <= score <= high % * positive score are returned.
    A positive without such rows gives none, nor does one below zero (its window is empty).

    Rows with a null id, label or vector, or a null or non-finite component take
    no part. Other rows are those with another id. Rows that repeat an id are rows
    like others: each is an anchor, a positive or a negative of its own. A vector
    that is shorter than another counts as filled with zeros. Scores beyond 64
    bits are held at the ends of that range. Other columns are not read; an empty
    table gives no rows.
    """
    spark = df.sparkSession
    prepare(spark)
    rows = taking_part(df, id_col, vector_col, F.col("label") if label is None else label)
    anchors = _blocks(rows.where(F.col("id") % 100 == 0 if anchor is None else anchor), block_rows)
    folder = scratch(spark, "hard-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(folder)
    for (block,) in sorted(anchors.select("block").distinct().collect()):
        _answer(rows, anchors.where(F.col("block") == block), positives, negatives, low, high, scale).write.mode("append").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def _first(parts: DataFrame, k: int) -> DataFrame:
    """The first k rows of each slot over all tasks, as a sorted array of (score, other): tasks sent k each at most."""
    best = F.sort_array(F.collect_list(F.struct((-F.col("score") - 1).alias("down"), "other")))     # -score-1 never overflows
    return parts.groupBy("anchor", "slot").agg(F.slice(best, 1, k).alias("best"))


def _answer(rows: DataFrame, anchors: DataFrame, positives: int, negatives: int, low: int, high: int, scale: float) -> DataFrame:
    """Positives, then negatives of one block of anchors."""
    spark = rows.sparkSession
    block = anchors.sort("id", "label").toArrow()                     # bounded: BLOCK_ROWS anchors, BLOCK_BYTES of vectors
    ids, labels = block.column("id").to_numpy(), block.column("label").to_numpy()
    lists = block.column("v").combine_chunks()
    vectors = scaled(lists, int(np.diff(lists.offsets.to_numpy()).max(initial=0)), scale)

    shared = spark.sparkContext.broadcast((ids, labels, vectors, None))
    best = _first(_scan(rows, shared, 1, positives, scale, _positive), positives)
    got = best.select("anchor", F.posexplode("best").alias("slot", "p")).select("anchor", "slot", "p.down", "p.other").toArrow()
    at, score = (got.column("anchor").to_numpy(), got.column("slot").to_numpy()), -got.column("down").to_numpy() - 1
    floor, ceiling = np.full((len(ids), positives), _MOST), np.full((len(ids), positives), _LEAST)
    floor[at], ceiling[at] = window_limits(score, low, high)          # at most ``positives`` windows an anchor of the block
    windows = spark.createDataFrame(pa.table({"anchor": at[0], "slot": at[1], "anchor_id": ids[at[0]], "positive_id": got.column("other"),
                                              "positive_score": score, "floor": floor[at]}))

    shared = spark.sparkContext.broadcast((ids, labels, vectors, (floor, ceiling)))
    slots = _first(_scan(rows, shared, positives, negatives, scale, _negative), negatives)
    # a window's rows: its own slot and all below, best first, down to its lower limit
    by_anchor = slots.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "best"))).alias("slots"))
    below = F.flatten(F.transform(F.filter("slots", lambda s: s["slot"] >= F.col("slot")), lambda s: s["best"]))
    inside = F.filter(F.slice(below, 1, negatives), lambda x: -x["down"] - 1 >= F.col("floor"))
    return (windows.join(by_anchor, "anchor").select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("at", "n"))
            .select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("n.other").alias("negative_id"), "positive_score",
                    (-F.col("n.down") - 1).alias("negative_score")))
