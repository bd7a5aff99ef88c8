"""Line dedup by an exact set-similarity join.

A line is the set of its words. Its words are ordered by rarity in the corpus;
two lines whose Jaccard similarity reaches the threshold must share one of their
few rarest words (prefix filter), at places that leave room for the overlap
needed (positional filter), and be of similar size (length filter). What passes
these, and a parity bitmap of the two sets, is verified exactly. A line goes
when an earlier line of the corpus (by document id, then line number) is similar
to it, whether or not that one stays.

Rarity comes from exact word counts hashed into a table of fixed size, so it can
be broadcast at any corpus size; a shared slot only makes the order less sharp,
never wrong. A word that occurs once cannot be shared and is not sent.

Scale: only words of prefixes (about 30 bytes each, packed) are shuffled, never texts;
equal lines are one set. Words with many lines in their group are dealt to pairs
of tiles, by the number of sets, not of lines. Of each line only the earliest few
candidates of a group are written; where a line has more, the group's records are
written once as well, and lines that match none of their candidates are looked at
again in them, with sixteen times as many, until none is left. So a group of
thousands of variants costs rows in proportion to its lines, no match is lost and
no text is read again. A set of
so few words that only its equal is similar (fewer than four at 0.8) has no pairs:
equal sets are found by their key.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import (SPACE, bit_filter, chunks, column_bytes, materialize, mix, passes, prepare, ragged, release, shuffle_partitions,
                     span_hash, text_or_empty, whole_groups, word_spans)
from .ngram_join import group_pairs

#: slots of the table of word counts (one byte each when broadcast)
RARITY_BITS = 22
#: lines of a word's group that one tile holds
TILE = 1024
#: bytes of text that one step works on: its temporaries stay in the cores' caches
STEP = 1 << 18
_NO_ID = (1 << 63) - 1
#: line number of the row that stands for a whole document
DOCUMENT = -1


def line_words(data: np.ndarray, off: np.ndarray):
    """Word hashes, the line of each word, each line's number in its document, and first lines of documents."""
    breaks = np.flatnonzero(data == 10) + 1
    heads = np.sort(np.concatenate([off[:-1], breaks]), kind="stable")
    doc = np.searchsorted(breaks, off, "right")            # line breaks of the documents before each
    owner_first = doc[:-1] + np.arange(len(off) - 1)
    number = np.arange(len(heads)) - np.repeat(owner_first, np.diff(np.append(owner_first, len(heads))))
    starts, lens, _ = word_spans(data, off, SPACE)
    line = np.searchsorted(heads, starts, "right") - 1
    return span_hash(data, starts, lens), line, number, owner_first


def slot(wh: np.ndarray) -> np.ndarray:
    return (wh >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


#: slots of the table that travel together
_SLOTS = 1 << 16


def rarity(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Per slot a rank by word count: 0 for a count of at most one, then four ranks to each doubling.

    A task sends its own counts once, by ranges of slots (place and count of
    those in use); each range is summed and ranked in one task.
    """
    spark = df.sparkSession
    prepare(spark)

    def count(batches):
        table = np.zeros(1 << RARITY_BITS, np.int64)
        for batch in batches:
            data, off = column_bytes(batch.column(0))
            for _, _, part, po in chunks(data, off, STEP):
                starts, lens, _ = word_spans(part, po)
                np.add.at(table, slot(span_hash(part, starts, lens)), 1)
        for k in range(len(table) // _SLOTS):
            part = table[k * _SLOTS:(k + 1) * _SLOTS]
            at = np.flatnonzero(part)
            if len(at):
                wide = part[at].max() >= 1 << 32
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([at.astype("<u2").tobytes()], pa.binary()),
                                                  pa.array([part[at].astype("<u8" if wide else "<u4").tobytes()], pa.binary())], names=["part", "at", "n"])

    def rank(batches):
        part, total = None, np.zeros(_SLOTS, np.int64)

        def done():
            ranks = np.zeros(_SLOTS, np.uint8)
            many = total > 1
            ranks[many] = np.minimum(254, 1 + np.floor(4 * np.log2(total[many])))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([ranks.tobytes()], pa.binary())], names=["part", "ranks"])

        for batch in batches:
            for k, at, n in zip(*(c.to_pylist() for c in batch.columns)):
                if k != part:
                    if part is not None:
                        yield done()
                    part, total = k, np.zeros(_SLOTS, np.int64)
                at = np.frombuffer(at, "<u2")
                total[at] += np.frombuffer(n, "<u4" if len(n) == 4 * len(at) else "<u8").astype(np.int64)
        if part is not None:
            yield done()

    counts = df.select(text_or_empty(text_col).alias("text")).mapInArrow(count, "part int, at binary, n binary")
    ranks = (counts.repartition(min(shuffle_partitions(spark), (1 << RARITY_BITS) // _SLOTS), "part").sortWithinPartitions("part")
             .mapInArrow(rank, "part int, ranks binary"))
    out = np.zeros(1 << RARITY_BITS, np.uint8)
    for part, some in ranks.toLocalIterator():
        out[part * _SLOTS:(part + 1) * _SLOTS] = np.frombuffer(some, np.uint8)
    return out


def line_sets(data: np.ndarray, off: np.ndarray, ranks: np.ndarray | None, min_words: int):
    """Distinct words of the lines that are judged: (words rarest first, their order, bounds, set key, number, document, words with repeats, words of each document)."""
    wh, line, number, owner_first = line_words(data, off)
    words = np.bincount(line, minlength=len(number)) if len(line) else np.zeros(len(number), np.int64)
    rank = np.zeros(len(wh), np.uint64) if ranks is None else ranks[slot(wh)].astype(np.uint64)
    order_key = rank << np.uint64(56) | wh >> np.uint64(8)
    order = None
    if len(number) < 1 << 16:                  # one number holds line, rank and most of the word: sort it alone
        short = line.astype(np.uint64) << np.uint64(48) | order_key >> np.uint64(16)
        order = np.argsort(short)
        same = (short[order][1:] == short[order][:-1]) & (wh[order][1:] != wh[order][:-1])
        order = None if same.any() else order
    if order is None:
        order = np.lexsort((wh, order_key, line))
    wh, line, order_key = wh[order], line[order], order_key[order]
    new = np.ones(len(wh), bool)
    new[1:] = (wh[1:] != wh[:-1]) | (line[1:] != line[:-1])
    wh, line, order_key = wh[new], line[new], order_key[new]
    size = np.bincount(line, minlength=len(number)) if len(line) else np.zeros(len(number), np.int64)
    judged = size >= min_words
    keep = judged[line] if len(line) else np.zeros(0, bool)
    wh, line, order_key = wh[keep], line[keep], order_key[keep]
    lines = np.flatnonzero(judged)
    bounds = np.concatenate([[0], np.cumsum(size[lines])])
    key = mix(np.add.reduceat(mix(wh), bounds[:-1])) if len(lines) else np.zeros(0, np.uint64)
    document = np.searchsorted(owner_first, lines, "right") - 1
    return wh, order_key, bounds, key, number[lines], document, words[lines], np.add.reduceat(words, owner_first) if len(words) else words


def least_overlap(total: np.ndarray, num: int, den: int) -> np.ndarray:
    """The smallest overlap of two sets of ``total`` words together whose Jaccard similarity reaches num / den."""
    return -(-num * total // (num + den))


def prefix_size(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Words of a set of n that must meet a similar set: n - ceil(t n) + 1."""
    return n - (-(-num * n // den)) + 1


def least_joining(num: int, den: int) -> int:
    """Words of the smallest set that can be similar to another: n / (n + 1) >= num / den. Smaller ones have only their equals."""
    return -(-num // max(1, den - num))


def _lines(ranks, min_words: int, joining: int, num: int, den: int):
    """Every judged line; the first of each set in a chunk carries the frequent ones among its prefix words."""
    often = 1 + int(4 * np.log2(TILE))

    def run(batches):
        for batch in batches:
            data, off = column_bytes(batch.column(2))
            for i, j, part, po in chunks(data, off, STEP):
                wh, order_key, bounds, key, number, document, words, total = line_sets(part, po, ranks.value, min_words)
                n = np.diff(bounds)
                once = np.zeros(len(n), bool)
                once[np.unique(key, return_index=True)[1]] = True
                pos = np.arange(len(wh)) - np.repeat(bounds[:-1], n)
                hot = (pos < np.repeat(prefix_size(n, num, den) * (once & (n >= joining)), n)) & (order_key >> np.uint64(56) >= often)
                hot_off = np.concatenate([[0], np.cumsum(hot)])[bounds] if len(n) else np.zeros(1, np.int64)
                breaks = np.searchsorted(np.flatnonzero(part == 10), po)
                # a row of each document: its number of lines and its words
                rows = pa.array(np.concatenate([document, np.arange(j - i)]) + i)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(rows), batch.column(1).take(rows), pa.array(np.concatenate([number, np.full(j - i, DOCUMENT)]), pa.int32()),
                    pa.array(np.concatenate([key.view(np.int64), np.diff(breaks) + 1])), pa.array(np.concatenate([words, total])),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([hot_off, np.full(j - i, hot_off[-1])]), pa.int32()),
                                             pa.array(order_key[hot].view(np.int64)))],
                    names=["id", "th", "line", "k", "words", "hot"])
    return run


#: a prefix word's record in the blocks of a group that later rounds read, field by field
_RECORD = (("word", "<u8"), ("k", "<u8"), ("id", "<i8"), ("parity", "<u8"), ("parity2", "<u8"), ("line", "<u4"), ("n", "<u4"),
           ("pos", "<u4"), ("flags", "<u1"))
_PACKED = np.dtype(list(_RECORD))
_ASKED, _LEFT, _INNER = 1, 2, 4
#: frequent words that are broadcast with their number of tiles
_HOT_WORDS = 100_000


def pack(cols: dict[str, np.ndarray], cuts: list[int]) -> list[bytes]:
    """Records from each cut to the next as bytes."""
    out = np.empty(cuts[-1], _PACKED)
    for name, _ in _RECORD:
        out[name] = cols[name]
    raw, width = out.tobytes(), _PACKED.itemsize
    return [raw[a * width:b * width] for a, b in zip(cuts, cuts[1:])]


def unpack(blobs: list[bytes]) -> dict[str, np.ndarray]:
    rows = np.frombuffer(b"".join(blobs), _PACKED)
    return {name: np.ascontiguousarray(rows[name]) for name, _ in _RECORD}


#: words of a set up to which 32, and 64, parity bits tell it from others; beyond that, 128 do
_PARITY_32, _PARITY_64 = 20, 72


def fold_parity(n: np.ndarray, parity: np.ndarray, parity2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bitmaps in as many bits as sets of n words have: halves laid on each other are the bitmap of half the length."""
    wide = n > _PARITY_64
    low, high = np.where(wide, parity, parity ^ parity2), np.where(wide, parity2, np.uint64(0))
    return np.where(n > _PARITY_32, low, (low ^ low >> np.uint64(32)) & np.uint64(0xFFFFFFFF)), high


#: head of a shuffled block: its smallest id, then layout and number of records by length of their parity bitmaps
_HEAD = np.dtype([("base", "<i8"), ("layout", "<u2", 3), ("records", "<u4", 3)])
#: numbers of a shuffled record that take as many bytes as the largest of its chunk needs
_FITTED = ("id", "line", "n", "pos")


@functools.cache
def _layout(layout: int) -> np.dtype:
    fitted = [(c, f"<u{1 << (layout >> 2 * i & 3)}") for i, c in enumerate(_FITTED)]
    parity = ([("parity", "<u4")], [("parity", "<u8")], [("parity", "<u8"), ("parity2", "<u8")])[layout >> 8]
    return np.dtype([("high", "<u4"), ("low", "<u2"), ("k", "<u8"), *parity, *fitted])


def pack_blocks(cols: dict[str, np.ndarray], buckets: int) -> tuple[np.ndarray, list[bytes]]:
    """Records as one block for each bucket of words that occurs: (buckets, blocks).

    A block holds 48 bits of a word's hash (the bucket tells more), ids as
    distances from the smallest, and places with the tile flags below them.
    """
    word = mix(cols["word"])
    bucket = (word % np.uint64(buckets)).astype(np.int64)
    kind = (cols["n"] > _PARITY_32).astype(np.int64) + (cols["n"] > _PARITY_64)
    base = int(cols["id"].min())
    fitted = {"id": cols["id"].view(np.uint64) - np.array(base).view(np.uint64), "line": cols["line"], "n": cols["n"],
              "pos": cols["pos"] << 2 | (cols["flags"] >> 1).astype(np.int64)}
    used, number = np.unique(bucket, return_inverse=True)
    heads = np.zeros(len(used), _HEAD)
    heads["base"] = base
    parts = [heads.tobytes()]
    for c in range(3):
        rows = np.flatnonzero(kind == c)
        rows = rows[np.argsort(number[rows], kind="stable")]
        layout = c << 8
        for i, name in enumerate(_FITTED):                      # 0 .. 3 for 1, 2, 4 or 8 bytes
            layout |= (max(0, int(fitted[name][rows].max(initial=0)).bit_length() - 1) // 8).bit_length() << 2 * i
        out = np.empty(len(rows), _layout(layout))
        out["high"], out["low"] = word[rows] >> np.uint64(32), word[rows] >> np.uint64(16) & np.uint64(0xFFFF)
        for name in out.dtype.names[2:]:
            out[name] = (fitted if name in fitted else cols)[name][rows]
        heads["layout"][:, c], heads["records"][:, c] = layout, np.bincount(number[rows], minlength=len(used))
        parts.append(out.tobytes())
    parts[0] = heads.tobytes()
    width = [_HEAD.itemsize, *(_layout(int(x)).itemsize for x in heads["layout"][0])]
    ends = [np.arange(1, len(used) + 1) * width[0], *(np.cumsum(heads["records"][:, c].astype(np.int64)) * width[c + 1] for c in range(3))]
    cuts = [[0, *e.tolist()] for e in ends]
    return used, [b"".join([part[cut[i]:cut[i + 1]] for part, cut in zip(parts, cuts)]) for i in range(len(used))]


def unpack_blocks(buckets: np.ndarray, blobs: list[bytes]) -> dict[str, np.ndarray]:
    """The records of some blocks, in any order; the word's hash is of its 48 bits and the bucket."""
    heads = np.frombuffer(b"".join([b[:_HEAD.itemsize] for b in blobs]), _HEAD)
    raw = memoryview(b"".join(blobs))
    size = np.array([len(b) for b in blobs], np.int64)
    at = np.cumsum(size) - size + _HEAD.itemsize
    out: dict[str, list[np.ndarray]] = {name: [] for name, _ in _RECORD}
    for c in range(3):
        layouts, many = heads["layout"][:, c], heads["records"][:, c].astype(np.int64)
        for layout in np.unique(layouts).tolist():
            kind = _layout(layout)
            some = np.flatnonzero(layouts == layout)
            stop = at[some] + many[some] * kind.itemsize
            rows = np.frombuffer(b"".join([raw[a:b] for a, b in zip(at[some].tolist(), stop.tolist())]), kind)
            at[some] = stop
            bucket, base = np.repeat(buckets[some], many[some]), np.repeat(heads["base"][some], many[some])
            out["word"].append(rows["high"].astype(np.uint64) << np.uint64(32) | rows["low"].astype(np.uint64) << np.uint64(16)
                               | bucket.astype(np.uint64) & np.uint64(0xFFFF))
            out["k"].append(rows["k"])
            out["id"].append((base.view(np.uint64) + rows["id"].astype(np.uint64)).view(np.int64))
            out["parity"].append(rows["parity"].astype(np.uint64))
            out["parity2"].append(rows["parity2"] if c == 2 else np.zeros(len(rows), np.uint64))
            out["line"].append(rows["line"].astype(np.uint32))
            out["n"].append(rows["n"].astype(np.uint32))
            out["pos"].append((rows["pos"] >> 2).astype(np.uint32))
            out["flags"].append(((rows["pos"] & 3) << 1).astype(np.uint8) | np.uint8(_ASKED))
    return {name: np.concatenate(v) for name, v in out.items()}


def _prefixes(ranks, hot, min_words: int, num: int, den: int, buckets: int):
    """Prefix words of the distinct sets of a chunk, each with its first place, size, position and parity bitmap.

    A frequent word's records go to all pairs of tiles that their tile is in;
    records leave in packed blocks, one for each bucket of words. The bitmaps of
    small sets are folded: fewer bits tell them apart as well.
    """
    def run(batches):
        hot_words, hot_tiles = hot.value
        for batch in batches:
            ids = batch.column(0).fill_null(_NO_ID).to_numpy()
            data, off = column_bytes(batch.column(2))
            for i, j, part, po in chunks(data, off, STEP):
                wh, order_key, bounds, key, number, document, _, _ = line_sets(part, po, ranks.value, min_words)
                if not len(key):
                    continue
                doc_id = ids[i + document]
                first = np.lexsort((number, doc_id, key))
                first = first[np.concatenate([[True], key[first][1:] != key[first][:-1]])]
                n = np.diff(bounds)
                bit = np.uint64(1) << (wh & np.uint64(63))
                second = (wh >> np.uint64(6) & np.uint64(1)) > 0
                parity = np.bitwise_xor.reduceat(np.where(second, np.uint64(0), bit), bounds[:-1])
                parity2 = np.bitwise_xor.reduceat(np.where(second, bit, np.uint64(0)), bounds[:-1])
                parity, parity2 = fold_parity(n, parity, parity2)
                mine = np.zeros(len(n), bool)
                mine[first] = True
                pos = np.arange(len(wh)) - np.repeat(bounds[:-1], n)
                send = np.flatnonzero((pos < np.repeat(prefix_size(n, num, den), n)) & (order_key >> np.uint64(56) > 0) & np.repeat(mine, n))
                line = np.repeat(np.arange(len(n)), n)[send]
                word, pos = order_key[send], pos[send]
                flags = np.full(len(send), _LEFT | _INNER, np.uint8)
                at = np.searchsorted(hot_words, word)
                often = np.flatnonzero(hot_words[np.minimum(at, len(hot_words) - 1)] == word) if len(hot_words) else at[:0]
                if len(often):
                    tiles = hot_tiles[at[often]]
                    rest = np.setdiff1d(np.arange(len(word)), often, assume_unique=True)
                    own = np.repeat((mix(key[line[often]] ^ word[often]) % tiles.astype(np.uint64)).astype(np.int64), tiles)
                    other = np.arange(int(tiles.sum())) - np.repeat(np.cumsum(tiles) - tiles, tiles)
                    copies = np.repeat(often, tiles)
                    tile = mix(word[copies] ^ mix((np.minimum(own, other) << 32 | np.maximum(own, other)).astype(np.uint64)))
                    flags = np.concatenate([flags[rest], ((own <= other) * _LEFT | (own == other) * _INNER).astype(np.uint8)])
                    line, pos, word = np.concatenate([line[rest], line[copies]]), np.concatenate([pos[rest], pos[copies]]), np.concatenate([word[rest], tile])
                if not len(word):
                    continue
                used, blobs = pack_blocks({"word": word, "k": key[line], "id": doc_id[line], "parity": parity[line], "parity2": parity2[line],
                                           "line": number[line], "n": n[line], "pos": pos, "flags": flags}, buckets)
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "block"])
    return run


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


#: pairs that a step holds before it cuts them to the earliest of each line
_PAIRS = 1 << 20


def _earliest(x: np.ndarray, y: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``most`` y of each x, sorted, with their rank."""
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    start = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    rank = np.arange(len(x)) - np.repeat(start, np.diff(np.append(start, len(x))))
    take = rank < most
    return x[take], y[take], rank[take]


def _group_candidates(col: dict[str, np.ndarray], num: int, den: int, most: int):
    """Candidates of records sorted by word and place: (x, y, rank, whether x has more), indexes into the records."""
    word, flags = col["word"], col["flags"]
    group = np.cumsum(np.concatenate([[True], word[1:] != word[:-1]])) - 1
    n, pos, asked = col["n"].astype(np.int64), col["pos"].astype(np.int64), flags & _ASKED > 0
    p, p2 = col["parity"], col["parity2"]
    xs, ys, held = [], [], 0
    for y, x in group_pairs(group, flags & _LEFT > 0, flags & _INNER > 0):
        x, y = np.maximum(x, y), np.minimum(x, y)      # y is earlier
        total = n[x] + n[y]
        need = least_overlap(total, num, den)
        ok = np.flatnonzero(asked[x] & (pos[x] + need <= n[x]) & (pos[y] + need <= n[y]))
        x, y = x[ok], y[ok]
        low, high = fold_parity(np.minimum(n[x], n[y]), p[x] ^ p[y], p2[x] ^ p2[y])
        ok = _popcount(low) + _popcount(high) <= total[ok] - 2 * need[ok]
        xs.append(x[ok])
        ys.append(y[ok])
        held += len(xs[-1])
        if held > _PAIRS:
            x, y, _ = _earliest(np.concatenate(xs), np.concatenate(ys), most + 1)
            xs, ys, held = [x], [y], 0
    x, y, rank = _earliest(np.concatenate([*xs, np.zeros(0, np.int64)]), np.concatenate([*ys, np.zeros(0, np.int64)]), most + 1)
    full = np.zeros(len(word), bool)
    full[x[rank == most]] = True
    keep = rank < most
    return x[keep], y[keep], rank[keep], full[x[keep]]


_CANDIDATES = "x long, y long, more boolean, word long, rank long, block binary"


def _pairs_batch(col, x, y, rank, more) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(col["k"][x].view(np.int64)), pa.array(col["k"][y].view(np.int64)), pa.array(more), pa.array(col["word"][x].view(np.int64)),
        pa.array(rank), pa.nulls(len(x), pa.binary())], names=["x", "y", "more", "word", "rank", "block"])


def _by_word_and_place(col: dict[str, np.ndarray]) -> np.ndarray:
    """Order by word, then id, line and set key."""
    n, place = len(col["word"]), None
    if n and col["id"].min() >= 0 and col["id"].max() < 1 << 42 and col["line"].max() < 1 << 21:
        place = col["id"] << 21 | col["line"].astype(np.int64)       # one number: sorted alone, unless a place holds two sets
        by_place = np.argsort(place)
        same = place[by_place][1:] == place[by_place][:-1]
        if (same & (col["k"][by_place][1:] != col["k"][by_place][:-1])).any():
            place = None
    if place is None:
        by_place = np.lexsort((col["k"], col["line"], col["id"]))
    rank = np.empty(n, np.int64)
    rank[by_place] = np.arange(n)
    by_word = np.argsort(col["word"])
    group = np.empty(n, np.int64)
    group[by_word] = np.cumsum(np.concatenate([[False], col["word"][by_word][1:] != col["word"][by_word][:-1]]))[:n]
    return np.argsort(group << 32 | rank)


def _candidates(num: int, den: int, most: int):
    """Of each line the ``most`` earliest candidates of its group, and whether there are more.

    Where a line has more, its group's records follow (a block) with the sets in
    it (x without y), so that a later round needs no text.
    """
    def run(batches):
        for table in whole_groups(batches, ["bucket"], rows=1 << 30, size=4 << 20):
            col = unpack_blocks(table.column("bucket").to_numpy(), table.column("block").to_pylist())
            # groups in order, lines in corpus order; of equal sets from several tasks the earliest place stands for all
            order = _by_word_and_place(col)
            col = {c: v[order] for c, v in col.items()}
            _, first, same = np.unique(mix(col["word"] ^ mix(col["k"])), return_index=True, return_inverse=True)
            if len(first) < len(order):
                pos = np.full(len(first), np.iinfo(np.uint32).max, np.uint32)
                np.minimum.at(pos, same, col["pos"])
                by_place = np.argsort(first)
                col = {c: v[first[by_place]] for c, v in col.items()} | {"pos": pos[by_place]}
            x, y, rank, more = _group_candidates(col, num, den, most)
            if not len(x):
                continue
            yield _pairs_batch(col, x, y, rank, more)
            words = np.unique(col["word"][x[more]])
            if not len(words):
                continue
            member = np.flatnonzero(np.isin(col["word"], words))
            cut = np.flatnonzero(np.concatenate([[True], col["word"][member][1:] != col["word"][member][:-1]]))
            blocks = pack({c: v[member] for c, v in col.items()}, [*cut.tolist(), len(member)])
            sets = np.unique(col["k"][member])
            m, none = len(blocks), len(sets)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(sets.view(np.int64))]), pa.nulls(m + none, pa.int64()), pa.nulls(m + none, pa.bool_()),
                pa.concat_arrays([pa.array(words.view(np.int64)), pa.nulls(none, pa.int64())]), pa.nulls(m + none, pa.int64()),
                pa.concat_arrays([pa.array(blocks, pa.binary()), pa.nulls(none, pa.binary())])],
                names=["x", "y", "more", "word", "rank", "block"])
    return run


def _candidates_again(num: int, den: int, most: int):
    """As ``_candidates``, for the lines (xs) of one group's block that are still open."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                block, xs = batch.column(1)[k].as_py(), batch.column(2)[k].values.to_numpy()
                col = unpack([block])
                col["flags"] = np.where(np.isin(col["k"], xs.view(np.uint64)), col["flags"], col["flags"] & (_LEFT | _INNER))
                x, y, rank, more = _group_candidates(col, num, den, most)
                if len(x):
                    yield _pairs_batch(col, x, y, rank, more)
    return run


def _place(th: np.ndarray, line: np.ndarray) -> np.ndarray:
    return mix(th.view(np.uint64) ^ mix(line.astype(np.uint64) + np.uint64(1)))


def _with_place(batches):
    """k and th with a hash of the place (document and line)."""
    for batch in batches:
        place = _place(batch.column(1).to_numpy(), batch.column(2).to_numpy())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(place.view(np.int64))], names=["k", "th", "place"])


def _wanted_sets(filters, min_words: int):
    """Words of the lines that may be wanted: first in their document and line, of a wanted set key; once for each chunk."""
    def run(batches):
        documents, places, keys = filters.value
        for batch in batches:
            th = batch.column(0).to_numpy()
            rows = np.flatnonzero(passes(documents, th))
            th, (data, off) = th[rows], column_bytes(batch.column(1).take(pa.array(rows)))
            for i, j, part, po in chunks(data, off, STEP):
                breaks = np.flatnonzero(part == 10) + 1
                heads = np.sort(np.concatenate([po[:-1], breaks]), kind="stable")
                ends = np.append(heads[1:], len(part))
                owner_first = np.searchsorted(breaks, po, "right")[:-1] + np.arange(j - i)
                owner = np.repeat(np.arange(j - i), np.diff(np.append(owner_first, len(heads))))
                some = np.flatnonzero(passes(places, _place(th[i + owner], np.arange(len(heads)) - owner_first[owner])))
                size = ends[some] - heads[some]
                lines, at = part[ragged(heads[some], size)], np.concatenate([[0], np.cumsum(size)])
                lines = np.where(lines == 10, np.uint8(32), lines)       # its own end
                wh, _, bounds, key, *_ = line_sets(lines, at, None, min_words)
                if not len(key):
                    continue
                one = np.unique(key, return_index=True)[1]
                one = one[passes(keys, key[one])]
                n = np.diff(bounds)[one]
                if len(one):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key[one].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()),
                                                 pa.array(wh[ragged(bounds[:-1][one], n)].view(np.int64)))],
                        names=["k", "words"])
    return run


def _similar(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The x of pairs whose sets reach the threshold, exactly."""
    both = (pairs.select("x", "y").distinct().join(sets.withColumnsRenamed({"k": "x", "words": "wx"}), "x")
            .join(sets.withColumnsRenamed({"k": "y", "words": "wy"}), "y"))
    common = F.size(F.array_intersect("wx", "wy"))
    return both.where((num + den) * common >= num * (F.size("wx") + F.size("wy"))).select("x").distinct()


def _few_similar(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """As ``_similar``, for pairs of a small part of the sets: only those are shuffled."""
    pairs = materialize(pairs.select("x", "y").distinct(), "line-few-pairs")
    keys = materialize(pairs.select(F.col("x").alias("k")).unionByName(pairs.select(F.col("y").alias("k"))).distinct(), "line-few-keys")
    return _similar(pairs, sets.join(keys, "k", "left_semi"), num, den)


def later_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: tuple[int, int] = (4, 5),
                min_words: int = 1, most: int = 16) -> tuple[DataFrame, DataFrame]:
    """Documents (id, th: hash of the text, n_lines, words) and, of those that lose lines, id, th, ``removed`` (sorted line
    numbers from 0) and ``lost`` (words in them).

    Nulls, ties, repeated rows and empty tables: see ``line_report``.
    """
    spark = df.sparkSession
    prepare(spark)
    num, den = threshold
    joining = max(min_words, least_joining(num, den))
    parts = shuffle_partitions(spark)
    text = text_or_empty(text_col)
    source = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    ranks = spark.sparkContext.broadcast(rarity(df, text_col))
    lines = materialize(source.mapInArrow(_lines(ranks, min_words, joining, num, den), "id long, th long, line int, k long, words long, hot array<long>"),
                        "lines")
    documents = lines.where(F.col("line") == DOCUMENT).select("id", "th", F.col("k").alias("n_lines"), "words").dropDuplicates(["id", "th"])
    lines = lines.where(F.col("line") != DOCUMENT)
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "line", "th", "words")
    firsts = materialize(lines.groupBy("k").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("many")), "line-sets")
    # sets, not lines, count: a line that stands a million times is one member of its words' groups
    sets_once = lines.where(F.size("hot") > 0).select("k", "hot").dropDuplicates(["k"])
    hot = materialize(sets_once.select(F.explode("hot").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("many"))
                      .where(F.col("many") > TILE), "line-frequent-words")

    tile = TILE
    while hot.where(F.col("many") > tile).count() > _HOT_WORDS:      # keeps what is broadcast bounded
        tile *= 4
    often = hot.where(F.col("many") > tile).orderBy("word").toPandas()
    words = often.word.to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    frequent = spark.sparkContext.broadcast((words[order], -(-often.many.to_numpy(np.int64) // tile)[order]))

    blocks = source.mapInArrow(_prefixes(ranks, frequent, joining, num, den, 4 * parts), "bucket int, block binary")
    found = materialize(blocks.repartition(parts, "bucket").sortWithinPartitions("bucket")
                        .mapInArrow(_candidates(num, den, most), _CANDIDATES), "line-pairs")
    del blocks
    release(spark)
    pairs, groups = found.where("y IS NOT NULL"), found.where("block IS NOT NULL").select("word", "block")
    keys = found.where("x IS NOT NULL").select(F.col("x").alias("k")).unionByName(pairs.select(F.col("y").alias("k"))).distinct()
    keys = keys.join(firsts, "k").select("k", F.col("first.th").alias("th"), F.col("first.line").alias("line"))
    keys = materialize(keys.mapInArrow(_with_place, "k long, th long, place long"), "line-wanted")
    filters = spark.sparkContext.broadcast(tuple(bit_filter(keys, c) for c in ("th", "place", "k")))
    sets = materialize(source.select("th", "text").mapInArrow(_wanted_sets(filters, joining), "k long, words array<long>")
                       .groupBy("k").agg(F.any_value("words").alias("words")), "line-words")
    resolved = None
    while True:
        # most lines match one of their two earliest candidates; only the others' pairs are looked at further
        similar = _similar if resolved is None else _few_similar
        matched = materialize(similar(pairs.where("rank < 2"), sets, num, den), "line-matches")
        rest = _few_similar(pairs.where("rank >= 2").join(matched, "x", "left_anti"), sets, num, den)
        matched = materialize(matched.unionByName(rest), "line-matches-all")
        resolved = matched if resolved is None else resolved.unionByName(matched).distinct()
        left = materialize(pairs.where("more").select("x", "word").distinct().join(matched, "x", "left_anti"), "line-open")
        if left.isEmpty():
            break
        most *= 16
        again = groups.join(left.groupBy("word").agg(F.collect_set("x").alias("xs")), "word").select("word", "block", "xs")
        pairs = materialize(again.mapInArrow(_candidates_again(num, den, most), _CANDIDATES).drop("block"), "line-pairs-again")

    copies = lines.join(firsts.where("many > 1"), "k").where(~place.eqNullSafe(F.col("first"))).select("id", "th", "line", "words")
    similar = firsts.join(resolved.withColumnRenamed("x", "k"), "k", "left_semi").select("first.id", "first.th", "first.line", "first.words")
    gone = (copies.unionByName(similar).groupBy("id", "th").agg(F.collect_set(F.struct("line", "words")).alias("gone"))
            .select("id", "th", F.sort_array("gone.line").alias("removed"), F.aggregate("gone.words", F.lit(0).cast("long"), lambda a, x: a + x).alias("lost")))
    return documents, materialize(gone, "line-removals")


def line_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, n_lines, n_removed and removed (line numbers from 0).

    Lines end at ``\\n``; words are separated by ASCII white space. Lines of
    fewer than ``min_words`` (1 or more) distinct words are not judged and stay:
    with the default blank lines alone. A null or empty text has one empty line. Rows that repeat
    both id and text are one document; null ids come last in corpus order; of
    lines at the same place (an id with two texts) order is by a hash. Other
    columns are not read; an empty table gives no rows.
    """
    docs, gone = later_lines(df, id_col, text_col, **options)
    gone = gone.withColumnsRenamed({"id": "gone_id", "th": "gone_th"})
    got = docs.join(gone, docs["th"].eqNullSafe(gone["gone_th"]) & docs["id"].eqNullSafe(gone["gone_id"]), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return got.select(F.col("id").alias(id_col), "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_left: tuple[int, int] = (0, 1), **options) -> DataFrame:
    """``df`` without its later lines (see ``line_report``).

    A document that had words and keeps none is left out, and so is one that
    loses lines and keeps less than the share ``least_left`` (numerator,
    denominator) of its words: what is left of a near copy is no document. Its
    own lines go with it, also where a later document repeats them. Rows that
    repeat id and text become one row. Other columns stay as they are.
    """
    words, gone = later_lines(df, id_col, text_col, **options)
    same = words["th"].eqNullSafe(gone["th"]) & words["id"].eqNullSafe(gone["id"])
    num, den = least_left
    enough = (F.col("lost") < F.col("words")) & (den * (F.col("words") - F.col("lost")) >= num * F.col("words"))
    gone = words.join(gone, same).select(words["id"].alias("__tw_id"), words["th"].alias("__tw_th"), F.col("removed").alias("__tw_gone"), enough.alias("__tw_left"))
    docs = df.withColumn("__tw_key", F.col(id_col).cast("long")).withColumn("__tw_hash", F.xxhash64(text_or_empty(text_col)))
    if not docs.groupBy("__tw_key", "__tw_hash").count().where("count > 1").isEmpty():
        docs = docs.dropDuplicates(["__tw_key", "__tw_hash"])
    docs = docs.join(gone, F.col("__tw_hash").eqNullSafe(F.col("__tw_th")) & F.col("__tw_key").eqNullSafe(F.col("__tw_id")), "left")
    kept = F.concat_ws("\n", F.filter(F.split(text_or_empty(text_col), "\n", -1), lambda _, i: ~F.array_contains("__tw_gone", i)))
    docs = docs.withColumn("__tw_text", F.when(F.col("__tw_gone").isNull(), F.col(text_col)).otherwise(kept))
    docs = docs.where(F.coalesce("__tw_left", F.lit(True)))
    return docs.select(*[F.col("__tw_text").alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns])
