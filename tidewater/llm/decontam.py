"""Benchmark decontamination with spaced seeds.

Texts become lower-case alphanumeric tokens. Fixed masks over windows of up to
thirteen tokens keep seven or eight positions and ignore the others. Together
they hold a seed for every placement of substitutions in a stretch of 13 tokens
or more of which 80 % are equal (a stretch of 26 or more has a half that is equal
enough, so 13 to 25 decide). Other parameters take runs of the length that some
run between the substitutions must have. Training windows
whose seed is one of the benchmark's are hits; around each hit the document and
the item are laid side by side and the longest stretch with enough equal tokens
is measured.

Scale: the benchmark is the stated query set. It is taken in blocks of a bounded
number of seeds, each block is broadcast, and all blocks are tried in the same
scan, so texts are read once and nothing is shuffled. A bit table of fixed size
turns away almost every window before the sorted seeds are searched.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import LOWER, NOT_ALNUM, prepare, chunks, column_bytes, mix, powers, span_hash, text_or_empty, word_spans

#: fixed masks: 1 takes a token, 0 ignores it
MASKS = ("111011011001", "110100110111", "101110010111", "111100101011", "11101111", "11010100111", "1100011111",
         "1011001100011", "1111100000101")
#: the masks hold a seed of every stretch from this length and share of equal tokens on
COVERED, COVERED_IDENTITY = 13, 0.8
#: shorter items must be found whole
SPAN = 12
#: seeds of a block: 8 + 8 bytes each are broadcast
BLOCK_SEEDS = 1 << 20
_BITS = 22

HITS = "array<struct<item_id:bigint,overlap:int,matched:int>>"


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all documents and each document's first token."""
    low = LOWER[data]
    starts, lens, first = word_spans(low, off, NOT_ALNUM)
    return span_hash(low, starts, lens), first


def seeds(wh: np.ndarray, mask: str) -> np.ndarray:
    """The seed of the window at each token (as many as fit)."""
    n = len(wh) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(int(mask, 2) * 2 + 1), np.uint64)
    weight = powers(len(mask) + 2)
    for j, bit in enumerate(mask):
        if bit == "1":
            out += wh[j:j + n] * weight[j + 1]
    return mix(out)


def substitutions(length: int, identity: float) -> int:
    """The most tokens in which a stretch may differ."""
    return int((1 - identity) * length + 1e-9)


def stretch_masks(least: int, identity: float) -> tuple[str, ...]:
    """Masks that hold a seed of every stretch of ``least`` tokens or more (a longer one than twice that has a half that counts)."""
    if least >= COVERED and identity >= COVERED_IDENTITY:
        return MASKS
    runs_ = []
    for n in range(least, 2 * least):
        s = substitutions(n, identity)
        runs_.append(-(-(n - s) // (s + 1)))
    return ("1" * max(1, min(runs_)),)


def whole_masks(size: int, identity: float) -> tuple[str, ...]:
    """Masks for items of ``size`` tokens that must be found whole: of two blocks more than substitutions, two are equal."""
    if not substitutions(size, identity):                  # four tokens or fewer at 0.8: the whole run
        return ("1" * size,)
    if size >= COVERED and identity >= COVERED_IDENTITY:
        return MASKS
    count = min(size, substitutions(size, identity) + 2)
    cut = [size * k // count for k in range(count + 1)]
    if count < substitutions(size, identity) + 2:
        return ("1",)
    return tuple("".join("1" if any(cut[b] <= j < cut[b + 1] for b in two) else "0" for j in range(size))
                 for two in itertools.combinations(range(count), 2))


class Block:
    """Seeds and tokens of some benchmark items."""

    def __init__(self, ids: list[int], texts: list[str], min_tokens: int, min_overlap: int = 13, identity: float = 0.8):
        raw = [t.encode() for t in texts]
        off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        wh, first = tokens(np.frombuffer(b"".join(raw), np.uint8), off)
        self.ids, self.wh, self.first = np.array(ids, np.int64), wh, first
        size = np.diff(first)
        taken: dict[str, list[int]] = {}
        for i in np.flatnonzero(size >= min_tokens).tolist():
            n = int(size[i])
            for mask in whole_masks(n, identity) if n < max(SPAN, min_overlap) else stretch_masks(min_overlap, identity):
                taken.setdefault(mask, []).append(i)
        self.masks, self.tables = list(taken), []
        for mask, rows in taken.items():
            got = [seeds(wh[first[i]:first[i + 1]], mask) for i in rows]
            key = np.concatenate(got)
            place = np.concatenate([np.arange(first[i], first[i] + len(g)) for i, g in zip(rows, got)])
            item = np.concatenate([np.full(len(g), i) for i, g in zip(rows, got)])
            order = np.argsort(key, kind="stable")
            bits = np.zeros(1 << _BITS, bool)
            bits[key >> np.uint64(64 - _BITS)] = True
            self.tables.append((key[order], place[order], item[order], np.packbits(bits, bitorder="little")))

    def hits(self, wh: np.ndarray, first: np.ndarray, min_overlap: int, identity: float) -> dict[int, dict[int, tuple]]:
        """Per document, the items that it overlaps, with the overlap's length and equal tokens."""
        found: dict[int, dict[int, tuple]] = {}
        tried: set[tuple[int, int, int]] = set()
        for mask, table in zip(self.masks, self.tables):
            keys, place, item, bits = table
            h = seeds(wh, mask)
            top = h >> np.uint64(64 - _BITS)
            at = np.flatnonzero(bits[(top >> np.uint64(3)).astype(np.int64)] >> (top & np.uint64(7)).astype(np.uint8) & 1)
            lo, hi = np.searchsorted(keys, h[at], "left"), np.searchsorted(keys, h[at], "right")
            doc = np.searchsorted(first, at, "right") - 1
            inside = (hi > lo) & (at + len(mask) <= first[doc + 1])
            for t, d, a, b in zip(at[inside].tolist(), doc[inside].tolist(), lo[inside].tolist(), hi[inside].tolist()):
                for s in range(a, b):
                    i = int(item[s])
                    shift = t - int(place[s])
                    if (d, i, shift) in tried:
                        continue
                    tried.add((d, i, shift))
                    got = self._overlap(wh, int(first[d]), int(first[d + 1]), i, shift, t, min_overlap, identity)
                    if got and got > found.setdefault(d, {}).get(i, (0, 0)):
                        found[d][i] = got
        return {d: x for d, x in found.items() if x}

    def _overlap(self, wh, d0, d1, i, shift, t, min_overlap, identity):
        """The longest stretch of the item along this diagonal that is equal enough and long enough."""
        a, b = int(self.first[i]), int(self.first[i + 1])
        lo, hi = max(a, d0 - shift), min(b, d1 - shift)
        same = wh[lo + shift:hi + shift] == self.wh[lo:hi]
        need = min(min_overlap, b - a)
        n = hi - lo
        if n < need:
            return None
        total = np.concatenate([[0], np.cumsum(same)])
        # stretch [x, y): equal >= identity * length  <=>  f(y) >= f(x) with f = equal - identity * tokens
        f = total - identity * np.arange(n + 1)
        low = np.minimum.accumulate(f)
        best = None
        for y in range(need, n + 1):
            x = int(np.searchsorted(-low[:y - need + 1], -f[y] - 1e-9))
            if x <= y - need and (best is None or y - x > best[0]):
                best = (y - x, int(total[y] - total[x]))
        return best


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", min_tokens: int = 1,
           block_seeds: int = BLOCK_SEEDS, min_overlap: int = 13, identity: float = 0.8) -> list[Block]:
    """The benchmark in blocks; how many follows from its size, and each is bounded."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text")).where("id IS NOT NULL")
    letters = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, math.ceil(letters / 2 * len(MASKS) / block_seeds))   # a token and its gap take two letters at least
    out = []
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k).orderBy("id", "text").collect()
        if rows:
            out.append(Block([r.id for r in rows], [r.text for r in rows], min_tokens, min_overlap, identity))
    return out


def contamination(df: DataFrame, benchmark: DataFrame, text_col: str = "text", min_overlap: int = 13,
                  identity: float = 0.8, min_tokens: int = 1, out_col: str = "contamination") -> DataFrame:
    """``df`` with an array of the benchmark items that each text overlaps.

    An item counts where a stretch of at least ``min_overlap`` tokens (the whole
    item if it is shorter) has ``identity`` or more equal tokens side by side.
    Items of fewer tokens than that must be found whole, with as many substitutions
    as ``identity`` allows (none below five tokens at 0.8), through masks of their
    own length. Items without a token or with a null id say nothing and are left out
    (with ``min_tokens``, shorter ones too). A null or empty text overlaps nothing (empty array);
    repeated rows and ties are answered alike; an empty table stays empty. A
    column called ``out_col`` is replaced.
    """
    spark = df.sparkSession
    prepare(spark)
    found = [_looker(spark.sparkContext.broadcast(block), min_overlap, identity)(text_or_empty(text_col))
             for block in blocks(benchmark, min_tokens=min_tokens, min_overlap=min_overlap, identity=identity)]
    hits = F.concat(*found) if found else F.array().cast(HITS)
    return df.withColumn(out_col, hits)


def _looker(shared, min_overlap: int, identity: float):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("overlap", pa.int32()), ("matched", pa.int32())]))

    @F.arrow_udf(HITS)
    def look(column: pa.Array) -> pa.Array:
        data, off = column_bytes(column)
        out = []
        for i, j, part, po in chunks(data, off):
            wh, first = tokens(part, po)
            hits = shared.value.hits(wh, first, min_overlap, identity)
            ids = shared.value.ids
            for d in range(j - i):
                got = sorted((int(ids[k]), *v) for k, v in hits[d].items()) if d in hits else []
                out.append([{"item_id": a, "overlap": b, "matched": c} for a, b, c in got])
        return pa.array(out, kind)

    return look


def contamination_report(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``df``: id, contaminated, n_items, item_ids, best_overlap (tokens)."""
    got = contamination(df.select(F.col(id_col), F.col(text_col)), benchmark, text_col, **options)
    hits = F.col("contamination")
    return got.select(id_col, (F.size(hits) > 0).alias("contaminated"), F.size(hits).alias("n_items"),
                      F.array_sort(F.array_distinct(hits["item_id"])).alias("item_ids"),
                      F.coalesce(F.array_max(hits["overlap"]), F.lit(0)).alias("best_overlap"))
