"""Removal of long repeated byte strings by a column-wise suffix structure.

Every window of ``length`` bytes has an anchor: its k-byte string with the
smallest hash. Equal windows have equal anchors, so consecutive windows with one
anchor hash make a segment (at most ``2 * length`` bytes), and windows need to be
compared only within segments of the same anchor hash. Segments whose anchor
occurs once in the corpus are never sent; equal segments are sent once a task.

Inside a task the segments of its anchors are a collection of short documents.
They are cut into phrases at content-defined places, and the collection's
Burrows-Wheeler transform and common prefixes are built column by column: each
round inserts the next phrase (from the right) of every document, by sequential
passes over external files. The common prefixes tell which windows' phrases
occur twice; those windows are checked exactly, byte by byte.

The group of an anchor is bounded: where its distinct segments are more than
HOT_BYTES (a passage that stands between ever different neighbours), they are
spread over all tasks and their windows meet by hash instead, then by digest.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import (bit_filter, chunks, column_bytes, materialize, mix, passes, powers, prepare, ragged, shuffle_partitions,
                     span_hash, text_or_empty, whole_groups)
from .common import _MULT

ANCHOR = 100
#: a phrase border has the smallest hash of GRAM bytes among REACH places on either side
GRAM, REACH = 8, 16
#: entries of the external files that one step reads
STEP = 1 << 17
#: bytes of distinct segments of one anchor that a task takes at once
HOT_BYTES = 4 << 20
#: windows with one digest that a task takes at once
HOT_WINDOWS = 10_000

_INVERSE = np.uint64(pow(int(_MULT), -1, 1 << 64))
_INVERSES = np.ones(1, np.uint64)


def _inverses(n: int) -> np.ndarray:
    global _INVERSES
    if len(_INVERSES) < n:
        step = np.full(max(n, 2 * len(_INVERSES)), _INVERSE, np.uint64)
        step[0] = 1
        _INVERSES = np.cumprod(step, dtype=np.uint64)
    return _INVERSES


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each string of ``width`` bytes."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[:len(data)], out=total[1:])
    return mix((total[width:] - total[:-width]) * _inverses(n)[:n])


def sliding_min(key: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    done, out = 1, key
    while 2 * done <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def segments(data: np.ndarray, off: np.ndarray, length: int):
    """Windows of all documents cut into segments: (document, first window, windows, anchor hash, inner).

    ``inner``: the anchor stands at several places of the segment, so two of its
    own windows may be equal (in other segments they cannot be).
    """
    none = np.zeros(0, np.int64)
    nothing = none, none, none, np.zeros(0, np.uint64), np.zeros(0, bool)
    if len(data) < length:
        return nothing
    h = rolling(data, ANCHOR)
    bits = np.uint64(max(1, int(len(h)).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    best = sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), length - ANCHOR + 1)
    size = np.diff(off)
    docs = np.flatnonzero(size >= length)
    count = size[docs] - length + 1
    window = ragged(off[:-1][docs], count)
    if not len(window):
        return nothing
    doc = np.repeat(docs, count)
    place = (best[window] & low).astype(np.int64)
    anchor = h[place]
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(new)
    run = np.diff(np.append(start, len(window)))
    most = length - ANCHOR + 1                       # longer runs (periodic text) are cut
    pieces = -(-run // most)
    inner = np.repeat(place[start] != place[start + run - 1], pieces)
    start = ragged_steps(start, pieces, most)
    run = np.diff(np.append(start, len(window)))
    return doc[start], window[start], run, anchor[start], inner


def ragged_steps(start: np.ndarray, pieces: np.ndarray, step: int) -> np.ndarray:
    return np.repeat(start, pieces) + step * (np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces))


# -- the column-wise construction --------------------------------------------------


class Columns:
    """Flat files of the sorted suffixes so far: preceding symbol, document, symbols left, common prefix with the one before."""

    KINDS = {"bwt": np.int32, "doc": np.int32, "left": np.int32, "lcp": np.int32}

    def __init__(self, folder: str):
        self.folder = folder

    def path(self, name: str, version: int) -> str:
        return os.path.join(self.folder, f"{name}-{version}")

    def read(self, name: str, version: int):
        """A function that gives the next n entries."""
        f = open(self.path(name, version), "rb")
        return f, lambda n: np.fromfile(f, self.KINDS[name], n)

    def write(self, name: str, version: int):
        return open(self.path(name, version), "wb")

    def drop(self, name: str, version: int) -> None:
        os.unlink(self.path(name, version))


def build(symbols: np.ndarray, start: np.ndarray, length: np.ndarray, folder: str, step: int = STEP):
    """The collection's sorted suffixes: (bwt, doc, left, lcp), read from the last files.

    ``symbols`` are positive integers; document d has ``length[d]`` of them from
    ``start[d]``. Round j inserts, for every document that has j symbols, the
    suffix of its last j symbols. A new suffix goes behind the suffixes of
    smaller first symbols and behind those of the same symbol whose remainder
    sorts before its own, which a count of that symbol in the transform before
    the remainder's place gives. Empty suffixes are ordered by document.
    """
    files, n = Columns(folder), len(start)
    sigma = int(symbols.max(initial=0)) + 1
    first = np.zeros(sigma, np.int64)
    first[0] = n
    place = np.arange(n)
    for name, values in (("bwt", np.zeros(n)), ("doc", np.arange(n)), ("left", np.zeros(n)), ("lcp", np.zeros(n))):
        with files.write(name, 0) as out:
            values.astype(np.int32).tofile(out)
    total, version = n, 0
    for j in range(1, int(length.max(initial=0)) + 1):
        act = np.flatnonzero(length >= j)
        act = act[np.argsort(place[act], kind="stable")]
        at, put = place[act], symbols[start[act] + length[act] - j].astype(np.int64)

        # first pass: write each document's next symbol before its last suffix, and count that symbol up to there
        rank, seen = np.empty(len(act), np.int64), np.zeros(sigma, np.int64)
        source, take = files.read("bwt", version)
        with source, files.write("bwt", -1) as out:
            for x in range(0, total, step):
                part = take(step)
                a, b = np.searchsorted(at, [x, x + len(part)])
                part[at[a:b] - x] = put[a:b]
                order = np.argsort(part, kind="stable")
                ordered = part[order]
                head = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
                within = np.empty(len(part), np.int64)
                within[order] = np.arange(len(part)) - np.repeat(head, np.diff(np.append(head, len(part))))
                rank[a:b] = seen[put[a:b]] + within[at[a:b] - x]
                seen[ordered[head]] += np.diff(np.append(head, len(part)))
                part.tofile(out)
        files.drop("bwt", version)
        os.replace(files.path("bwt", -1), files.path("bwt", version))

        first += np.bincount(put, minlength=sigma)
        to = (np.cumsum(first) - first)[put] + rank
        order = np.argsort(to)
        to, act = to[order], act[order]
        place[act] = to

        # second pass: the new suffixes take their places among the old ones
        new_values = {"bwt": np.zeros(len(act), np.int32), "doc": act.astype(np.int32), "left": np.full(len(act), j, np.int32),
                      "lcp": np.full(len(act), -1, np.int32)}
        after = total + len(act)
        for name in files.KINDS:
            source, take = files.read(name, version)
            with source, files.write(name, version + 1) as out:
                for x in range(0, after, step):
                    y = min(after, x + step)
                    a, b = np.searchsorted(to, [x, y])
                    part = np.empty(y - x, np.int32)
                    is_new = np.zeros(y - x, bool)
                    is_new[to[a:b] - x] = True
                    part[is_new] = new_values[name][a:b]
                    part[~is_new] = take(y - x - (b - a))
                    part.tofile(out)
            files.drop(name, version)
        total, version = after, version + 1

        # third pass: common prefixes of pairs of neighbours that are new
        readers = [files.read(name, version) for name in ("doc", "left", "lcp")]
        before = None
        with readers[0][0], readers[1][0], readers[2][0], files.write("lcp", -1) as out:
            for x in range(0, total, step):
                doc, left, lcp = (take(step) for _, take in readers)
                if before is None:
                    doc_before, left_before = np.append(doc[:1], doc[:-1]), np.append(np.int32(0), left[:-1])
                else:
                    doc_before, left_before = np.append(before[0], doc[:-1]), np.append(before[1], left[:-1])
                todo = np.flatnonzero((left == j) | (left_before == j))
                p = start[doc_before[todo]] + length[doc_before[todo]] - left_before[todo]
                q = start[doc[todo]] + length[doc[todo]] - left[todo]
                lcp[todo] = common_prefix(symbols, p, q, np.minimum(left_before[todo], left[todo]))
                lcp.tofile(out)
                before = doc[-1:], left[-1:]
        files.drop("lcp", version)
        os.replace(files.path("lcp", -1), files.path("lcp", version))
    out = []
    for name in files.KINDS:
        source, take = files.read(name, version)
        with source:
            out.append(take(-1))
    return out


def common_prefix(symbols: np.ndarray, p: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
    out = np.zeros(len(p), np.int32)
    live, k = np.flatnonzero(most > 0), 0
    while len(live):
        live = live[symbols[p[live] + k] == symbols[q[live] + k]]
        k += 1
        out[live] = k
        live = live[most[live] > k]
    return out


def borders(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase borders of all segments, and each segment's first: strict minima of the hash of the GRAM bytes before."""
    h = rolling(data, GRAM)
    if len(h) < 2 * REACH + 1:
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    side = sliding_min(h, REACH)
    centre = np.arange(REACH, len(h) - REACH)
    strict = centre[(h[centre] < side[centre - REACH]) & (h[centre] < side[centre + 1])]
    at = strict + GRAM
    seg = np.searchsorted(off, at, "right") - 1
    ok = (at - GRAM - REACH >= off[seg]) & (at + REACH <= off[np.minimum(seg + 1, len(off) - 1)])
    at = at[ok]
    return at, np.searchsorted(at, off)


def repeated_windows(data: np.ndarray, off: np.ndarray, length: int, folder: str) -> np.ndarray:
    """For each byte of distinct segments, whether the window that starts there occurs a second time among them."""
    n = len(off) - 1
    at, first = borders(data, off)
    size = np.maximum(np.diff(first) - 1, 0)                     # phrases lie between two borders
    begin = ragged(first[:-1], size)
    reach = np.zeros(len(at) + 1, np.int64)                      # where the phrases that are shared from a border on end
    reach[:len(at)] = at
    if len(begin):
        names = np.unique(span_hash(data, at[begin], at[begin + 1] - at[begin]), return_inverse=True)[1] + 1
        starts = np.cumsum(size) - size
        _, doc, left, lcp = build(names.astype(np.int64), starts, size, folder)
        shared = np.maximum(lcp, np.append(lcp[1:], 0)).astype(np.int64)
        shared = np.minimum(shared, left)
        border = first[doc] + size[doc] - left
        some = left > 0
        reach[border[some]] = at[border[some] + shared[some]]
    count = np.diff(off) - length + 1
    window = ragged(off[:-1], count)
    a = np.searchsorted(at, window + GRAM + REACH)               # borders that the window's own bytes decide
    b = np.searchsorted(at, window + length - REACH, "right") - 1
    inside = a < b
    maybe = window[~inside | (reach[np.minimum(a, len(at))] >= at[b] if len(at) else True)]
    out = np.zeros(len(data) + 1, bool)
    out[_same_bytes(data, off, maybe, length)] = True
    return out[:len(data)]


def _same_bytes(data: np.ndarray, off: np.ndarray, window: np.ndarray, length: int) -> np.ndarray:
    """Those of the windows that equal another, byte by byte."""
    if len(window) < 2:
        return window[:0]
    h = np.empty(len(window), np.uint64)
    for i, j, part, _ in chunks(data, off):
        x, y = np.searchsorted(window, [off[i], off[j]])
        if y > x:
            h[x:y] = rolling(part, length)[window[x:y] - off[i]]
    order = np.argsort(h, kind="stable")
    head = np.concatenate([[True], h[order][1:] != h[order][:-1]])
    group = np.cumsum(head) - 1
    twin = np.empty(len(window), np.int64)
    twin[order] = window[order[np.flatnonzero(head)]][group]      # the first window with this hash
    many = np.bincount(group)
    cand = np.zeros(len(window), bool)
    cand[order] = many[group] > 1
    w, t = window[cand], twin[cand]
    other = w != t
    # equal pairs come in chains (w, t), (w + 1, t + 1) ...: whole strings at a chain's head, one byte further on
    chain = np.zeros(len(w), bool)
    chain[1:] = (w[1:] == w[:-1] + 1) & (t[1:] == t[:-1] + 1)
    heads = np.flatnonzero(~chain)
    good = data[w + length - 1] == data[t + length - 1]
    for s in range(0, len(heads), 4096):
        k = heads[s:s + 4096]
        grid = np.arange(length)
        good[k] = (data[w[k][:, None] + grid] == data[t[k][:, None] + grid]).all(axis=1)
    if good.all():
        return w
    same: dict[bytes, list[int]] = {}                              # two different strings with one hash: settle by the bytes
    bad = np.isin(t, t[~good])
    raw = data.tobytes()
    for x in w[bad].tolist():
        same.setdefault(raw[x:x + length], []).append(x)
    return np.concatenate([w[~bad], np.array([x for v in same.values() if len(v) > 1 for x in v], np.int64)])


# -- Spark ---------------------------------------------------------------------------


def _anchors(length: int):
    def run(batches):
        for batch in batches:
            data, off = column_bytes(batch.column(0))
            for _, _, part, po in chunks(data, off):
                _, _, _, anchor, inner = segments(part, po, length)
                anchor, number = np.unique(anchor, return_inverse=True)
                if len(anchor):
                    n = np.bincount(number, 1 + inner).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n)], names=["anchor", "n"])
    return run


def _segments(length: int, bits):
    """Places of segments whose anchor may be repeated; the bytes only where this task has not sent them yet."""
    def run(batches):
        sent: set[bytes] = set()
        for batch in batches:
            data, off = column_bytes(batch.column(2))
            for i, j, part, po in chunks(data, off):
                doc, window, run_, anchor, inner = segments(part, po, length)
                ok = passes(bits.value, anchor)
                doc, window, run_, anchor, inner = doc[ok], window[ok], run_[ok], anchor[ok], inner[ok]
                if not len(doc):
                    continue
                raw, digests, bodies = part.tobytes(), [], []
                for a, n in zip(window.tolist(), run_.tolist()):
                    body = raw[a:a + n + length - 1]
                    d = hashlib.blake2b(body, digest_size=16).digest()
                    digests.append(d)
                    bodies.append(None if d in sent else body)
                    sent.add(d)
                if len(sent) > 500_000:
                    sent.clear()
                rows = pa.array(doc + i)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(rows), batch.column(1).take(rows), pa.array(window - po[doc]), pa.array(run_),
                    pa.array(anchor.view(np.int64)), pa.array(digests, pa.binary()), pa.array(inner), pa.array(bodies, pa.binary())],
                    names=["id", "th", "window", "n", "anchor", "seg", "inner", "body"])
    return run


def _matches(length: int):
    """Per segment, the runs of its windows that occur a second time among the distinct segments of the task."""
    def run(batches):
        for table in whole_groups(batches, ["anchor"], rows=1 << 30, size=6 << 20):
            anchor, seg = table.column("anchor").to_numpy(), table.column("seg").to_pylist()
            keep, number = [], {}
            for k, key in enumerate(zip(anchor.tolist(), seg)):
                if key not in number:
                    number[key] = len(keep)
                    keep.append(k)
            keep = np.array(keep, np.int64)
            values, group, many = np.unique(anchor[keep], return_inverse=True, return_counts=True)
            inner = table.column("inner").to_numpy(zero_copy_only=False)
            keep = keep[(many[group] > 1) | inner[keep]]          # else there is nothing to compare it with
            if not len(keep):
                continue
            data, off = column_bytes(table.column("body").combine_chunks().take(pa.array(keep)))
            with tempfile.TemporaryDirectory() as folder:
                hit = repeated_windows(data, off, length, folder)
            edge = np.zeros(len(hit) + 1, bool)
            edge[off] = True
            begin = np.flatnonzero(hit & (~np.append(False, hit[:-1]) | edge[:-1]))
            end = np.flatnonzero(hit & (~np.append(hit[1:], False) | edge[1:])) + 1
            owner = np.searchsorted(off, begin, "right") - 1
            if len(begin):
                heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                bounds = pa.array(np.append(heads, len(owner)), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array([seg[k] for k in keep[owner[heads]]], pa.binary()),
                    pa.ListArray.from_arrays(bounds, pa.array(begin - off[owner], pa.int32())),
                    pa.ListArray.from_arrays(bounds, pa.array(end - off[owner], pa.int32()))], names=["seg", "begin", "end"])
    return run


def _windows(data: np.ndarray, off: np.ndarray, length: int):
    """The segment, place and hash of each window of some segments."""
    count = np.maximum(np.diff(off) - length + 1, 0)
    window = ragged(off[:-1], count)
    return np.repeat(np.arange(len(count)), count), window, rolling(data, length)[window]


def _window_hashes(length: int):
    def run(batches):
        for batch in batches:
            data, off = column_bytes(batch.column(0))
            for _, _, part, po in chunks(data, off):
                h, n = np.unique(_windows(part, po, length)[2], return_counts=True)
                if len(h):
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["w", "n"])
    return run


def _window_digests(length: int, bits):
    """Segment, place in it and digest of the windows whose hash may be repeated."""
    def run(batches):
        for batch in batches:
            data, off = column_bytes(batch.column(1))
            for i, _, part, po in chunks(data, off):
                owner, window, h = _windows(part, po, length)
                ok = passes(bits.value, h)
                owner, window = owner[ok], window[ok]
                if not len(owner):
                    continue
                raw = part.tobytes()
                digests = [hashlib.blake2b(raw[a:a + length], digest_size=16).digest() for a in window.tolist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner + i)), pa.array((window - po[owner]).astype(np.int32)),
                                                  pa.array(digests, pa.binary())], names=["row", "at", "d"])
    return run


def _runs(batches):
    """Sorted places of a segment's windows as runs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        places = batch.column(1)
        at, size = places.flatten().to_numpy(), places.value_lengths().to_numpy()
        owner = np.repeat(np.arange(len(size)), size)
        head = np.ones(len(at), bool)
        head[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(head)
        last = np.append(first[1:], len(at)) - 1
        bounds = pa.array(np.append(0, np.cumsum(np.bincount(owner[first], minlength=len(size)))), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(bounds, pa.array(at[first], pa.int32())),
                                          pa.ListArray.from_arrays(bounds, pa.array(at[last] + 1, pa.int32()))], names=["seg", "begin", "end"])


def split_hot(bodies: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Segments of the anchors with at most ``limit`` bytes of them, and those of the others if there are any."""
    hot = materialize(bodies.groupBy("anchor").agg(F.sum(F.length("body")).alias("bytes")).where(F.col("bytes") > limit).select("anchor"),
                      "suffix-hot-anchors")
    if hot.isEmpty():
        return bodies, None
    return bodies.join(F.broadcast(hot), "anchor", "left_anti"), bodies.join(F.broadcast(hot), "anchor", "left_semi")


def hot_matches(bodies: DataFrame, length: int) -> DataFrame:
    """What ``_matches`` gives, window by window: no group grows with an anchor's segments."""
    context = bodies.sparkSession.sparkContext
    distinct = bodies.groupBy("seg").agg(F.any_value("body").alias("body")).withColumn("row", F.monotonically_increasing_id())
    distinct = materialize(distinct, "suffix-hot-segments")
    twice = (distinct.select("body").mapInArrow(_window_hashes(length), "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
             .where("n > 1").select("w"))
    bits = context.broadcast(bit_filter(twice, "w"))
    windows = materialize(distinct.select("row", "body").mapInArrow(_window_digests(length, bits), "row long, at int, d binary"),
                          "suffix-hot-windows")
    repeated = materialize(windows.groupBy("d").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "suffix-hot-repeated")
    often = F.broadcast(repeated.where(F.col("n") > HOT_WINDOWS).select("d"))
    hits = (windows.join(often, "d", "left_semi")
            .unionByName(windows.join(often, "d", "left_anti").join(repeated.where(F.col("n") <= HOT_WINDOWS).select("d"), "d", "left_semi")))
    places = hits.groupBy("row").agg(F.sort_array(F.collect_list("at")).alias("places"))
    return (places.join(distinct.select("row", "seg"), "row").select("seg", "places")
            .mapInArrow(_runs, "seg binary, begin array<int>, end array<int>"))


def _cut(length: int, keep_text: bool):
    def run(batches):
        for batch in batches:
            data, off = column_bytes(batch.column(1))
            raw = data.tobytes()
            rows = []
            for k, spans in enumerate(batch.column(2).to_pylist()):
                body = raw[off[k]:off[k + 1]]
                kept, at, removed, runs = [], 0, 0, 0
                end = -1
                for s in sorted((x["begin"], x["end"]) for x in spans or []):
                    a, b = s[0], s[1] + length - 1          # windows a .. s[1]-1 cover the bytes a .. b-1
                    if a > end:
                        kept.append(body[at:a])
                        runs += 1
                        removed += b - a
                        at = end = b
                    elif b > end:
                        removed += b - end
                        at = end = b
                kept.append(body[at:])
                left = b"".join(kept)
                rows.append((len(body), removed, runs, hashlib.sha256(left).hexdigest(), left if keep_text else None))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                pa.array(cols[3], pa.string()), pa.array(cols[4], pa.binary())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def repeated_spans(source: DataFrame, length: int) -> DataFrame:
    """id, th and the runs of repeated windows (begin, end of the starts) of the documents that have some."""
    spark = source.sparkSession
    parts = shuffle_partitions(spark)
    twice = (source.select("text").mapInArrow(_anchors(length), "anchor long, n long").groupBy("anchor")
             .agg(F.sum("n").alias("n")).where("n > 1").select("anchor"))
    bits = spark.sparkContext.broadcast(bit_filter(twice, "anchor"))
    found = materialize(source.mapInArrow(_segments(length, bits), "id long, th long, window long, n long, anchor long, seg binary, inner boolean, body binary"),
                        "suffix-segments")
    places = found.select("id", "th", "window", "n", "seg")
    copies = places.groupBy("seg").agg(F.count(F.lit(1)).alias("copies"))
    cold, hot = split_hot(found.where("body IS NOT NULL").select("anchor", "seg", "inner", "body"), HOT_BYTES)
    matches = (cold.repartition(parts, "anchor")
               .sortWithinPartitions("anchor").mapInArrow(_matches(length), "seg binary, begin array<int>, end array<int>"))
    if hot is not None:
        matches = matches.unionByName(hot_matches(hot, length))
    marks = copies.join(matches, "seg", "left").where("copies > 1 OR begin IS NOT NULL")
    marks = materialize(marks.select("seg", "copies", F.arrays_zip("begin", "end").alias("runs")), "suffix-marks")
    whole = F.array(F.struct(F.col("window").alias("begin"), (F.col("window") + F.col("n")).alias("end")))
    part = F.transform("runs", lambda r: F.struct((F.col("window") + r["begin"]).alias("begin"), (F.col("window") + r["end"]).alias("end")))
    return (places.join(marks, "seg").select("id", "th", F.explode(F.when(F.col("copies") > 1, whole).otherwise(part)).alias("run"))
            .groupBy("id", "th").agg(F.collect_list("run").alias("runs")))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                   keep_text: bool = True) -> DataFrame:
    """One row per row of ``df``: id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes).

    A text is its UTF-8 bytes, null is empty. Removed is each byte of a string
    of ``length`` bytes that also starts anywhere else, in the same document,
    another or a repeated row; strings are judged on the input. n_spans counts
    maximal removed runs. Texts shorter than ``length`` stay whole; rows that
    repeat an id or have a null one are rows like others; other columns are not
    read; an empty table gives no rows. ``length`` must be 200 or more.
    """
    if length < 2 * ANCHOR:
        raise ValueError(f"length must be {2 * ANCHOR} or more")
    prepare(df.sparkSession)
    text = text_or_empty(text_col)
    source = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    spans = materialize(repeated_spans(source, length), "suffix-spans").withColumnsRenamed({"id": "span_id", "th": "span_th"})
    joined = source.join(spans, F.col("th").eqNullSafe(F.col("span_th")) & F.col("id").eqNullSafe(F.col("span_id")), "left")
    out = joined.select("id", "text", "runs").mapInArrow(
        _cut(length, keep_text), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumnRenamed("id", id_col)
