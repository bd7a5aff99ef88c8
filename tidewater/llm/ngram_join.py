"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles; two are linked when the Jaccard
similarity of their sets is 0.8 or more. Equal texts are one class from the
start, so only different texts are compared. MinHash values are cut into bands;
documents that share a band are candidates. A candidate pair's values are
compared 16 at a time, and the pair is dropped as soon as the posterior
probability that its similarity reaches the threshold falls below ``tolerance``
(uniform prior, one byte kept of each value, accidental matches included). The
rest are verified exactly on the shingle sets.

What the pruning leaves is a superset of the links, so its connected components
contain every link. Verification works inside them, in tiles of bounded size,
and counts links without writing pairs: a group of thousands of near copies
gives one row per document and tile. The chance that a pair at exactly the
threshold shares no band is (1 - 0.8^4)^32, under 1e-7; above it falls off fast.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import (bit_filter, chunks, column_bytes, components, group_numbers, materialize, mix, passes, powers, prepare,
                     shuffle_partitions, smallest_reachable, span_hash, text_or_empty, tiled, whole_groups, word_spans)

WORDS = 5
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
#: documents, and shingles, of a tile
TILE_DOCS, TILE_SHINGLES = 1024, 1 << 20

_A = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_B = mix(np.arange(1001, HASHES + 1001, dtype=np.uint64))


def shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all documents and each document's first one.

    Words are separated by ASCII white space and compared as they are. A text of
    one to four words has one shingle, all its words; a text without words none.
    """
    starts, lens, first = word_spans(data, off)
    wh = span_hash(data, starts, lens)
    words = np.diff(first)
    count = np.where(words >= WORDS, words - WORDS + 1, (words > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(count)])
    weight = powers(WORDS + 1)
    out = np.zeros(int(bounds[-1]), np.uint64)
    if len(out):
        at = np.arange(len(out)) + np.repeat(first[:-1] - bounds[:-1], count)
        padded = np.concatenate([wh, np.zeros(WORDS, np.uint64)])
        size = np.repeat(np.minimum(words, WORDS), count)
        for j in range(WORDS):
            out += np.where(j < size, padded[at + j] * weight[j + 1], np.uint64(0))
        out = mix(out + size.astype(np.uint64))
    return out, bounds


def minhash(sh: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """HASHES MinHash values (32 bits) of each document; all ones for an empty set."""
    n = len(bounds) - 1
    out = np.full((n, HASHES), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(bounds) > 0)
    heads = bounds[:-1][full]
    if len(full):
        for k in range(HASHES):
            out[full, k] = np.minimum.reduceat(((sh * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), heads)
    return out


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """After STEP, 2 STEP ... values: the fewest matches at which the pair may still reach the threshold."""
    j = (np.arange(4000) + 0.5) / 4000
    p = j + (1 - j) / 256                       # a kept byte also matches by accident
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        m = np.arange(n + 1)[:, None]
        logs = m * np.log(p) + (n - m) * np.log1p(-p)
        weight = np.exp(logs - logs.max(axis=1, keepdims=True))
        reach = weight[:, j >= threshold].sum(axis=1) / weight.sum(axis=1)
        out.append(int(np.argmax(reach >= tolerance)))
    return out


def unpruned(sig: np.ndarray, i: np.ndarray, j: np.ndarray, least: list[int]) -> np.ndarray:
    """Which pairs (i, j) of signature rows survive the step-wise comparison."""
    alive, same = np.arange(len(i)), np.zeros(len(i), np.int64)
    for k, need in enumerate(least):
        a, b = sig[i[alive], k * STEP:(k + 1) * STEP], sig[j[alive], k * STEP:(k + 1) * STEP]
        same = same + (a == b).sum(axis=1)
        go = same >= need
        alive, same = alive[go], same[go]
    return alive


def group_pairs(group: np.ndarray, left: np.ndarray, inner: np.ndarray, most: int = 200_000):
    """Index pairs of each group, some at a time: within a tile, or across its two tiles.

    Small groups go together, by distance in the sorted rows; a group of more
    than 64 rows is walked by itself in strips.
    """
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(first, len(group)))
    big = size > 64
    small = np.repeat(~big, size)
    for d in range(1, int(size[~big].max(initial=1))):
        i = np.flatnonzero(small[:-d] & (group[:-d] == group[d:]))
        i = i[inner[i] | (left[i] != left[i + d])]
        for s in range(0, len(i), most):
            yield i[s:s + most], i[s:s + most] + d
    for a, n in zip(first[big].tolist(), size[big].tolist()):
        rows = np.arange(a, a + n)
        same = inner[a]
        x, y = (rows, rows) if same else (rows[left[a:a + n]], rows[~left[a:a + n]])
        strip = max(1, most // max(1, len(y)))
        for s in range(0, len(x), strip):
            i, j = (v.ravel() for v in np.meshgrid(x[s:s + strip], y, indexing="ij"))
            if same:
                i, j = i[i < j], j[i < j]
            yield i, j


def _signatures(batches):
    pid, rows = TaskContext.get().partitionId(), 0
    for batch in batches:
        data, off = column_bytes(batch.column(2))
        for i, j, part, po in chunks(data, off):
            sh, bounds = shingles(part, po)
            n = j - i
            mins = minhash(sh, bounds)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(rows, rows + n) + (pid << 40)), batch.column(0).slice(i, n), batch.column(1).slice(i, n),
                pa.array(np.diff(bounds)), pa.array([m.tobytes() for m in mins], pa.binary())],
                names=["row", "id", "th", "n", "mins"])
            rows += n


def _bands(batches):
    seed = mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(77))
    for batch in batches:
        if batch.num_rows:
            mins = np.frombuffer(column_bytes(batch.column(1))[0].tobytes(), np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64)
            key = np.broadcast_to(seed, mins.shape[:2]).copy()
            for r in range(ROWS):
                key = mix(key + mins[:, :, r] * np.uint64(0x9E3779B97F4A7C15))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64).ravel()),
                                              pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], names=["key", "rep"])


def _sketch(col: str):
    """One byte of each MinHash value."""
    @F.arrow_udf("binary")
    def sketch(mins: pa.Array) -> pa.Array:
        data, off = column_bytes(mins)
        low = data.reshape(-1, 4 * HASHES)[:, ::4] if len(data) else np.zeros((0, HASHES), np.uint8)
        return pa.array([x.tobytes() for x in low], pa.binary())

    return sketch(F.col(col))


def _candidates(threshold: float, tolerance: float):
    """Per group, a link from each document to the smallest that unpruned pairs lead to."""
    keys = ["key", "a", "b"]

    def run(batches):
        least = least_matches(threshold, tolerance)
        for table in whole_groups(batches, keys):
            rep = table.column("rep").to_numpy()
            sig = column_bytes(table.column("sig"))[0].reshape(-1, HASHES)
            left = table.column("left").to_numpy(zero_copy_only=False)
            inner = table.column("a").to_numpy() == table.column("b").to_numpy()
            got = [(i[k], j[k]) for i, j in group_pairs(group_numbers(table, keys), left, inner)
                   for k in [unpruned(sig, i, j, least)]]
            i = np.concatenate([x for x, _ in got]) if got else np.zeros(0, np.int64)
            j = np.concatenate([x for _, x in got]) if got else i
            to = smallest_reachable(len(rep), i, j)
            at = np.flatnonzero(to != np.arange(len(rep)))
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(rep[at]), pa.array(rep[to[at]])], names=["u", "v"])

    return run


def _sets(filter_bits):
    """Distinct shingles of the documents whose text is wanted."""
    def run(batches):
        bits = filter_bits.value
        for batch in batches:
            want = np.flatnonzero(passes(bits, batch.column(1).to_numpy()))
            if not len(want):
                continue
            batch = batch.take(pa.array(want))
            data, off = column_bytes(batch.column(2))
            for i, j, part, po in chunks(data, off):
                sh, bounds = shingles(part, po)
                sets = [np.unique(sh[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary())], names=["th", "n", "sh"])
    return run


def linked(sets: list[np.ndarray], left: np.ndarray, inner: bool, threshold_num: int, threshold_den: int) -> np.ndarray:
    """Exact links of a group as a boolean matrix, from the sizes of intersections."""
    size = np.array([len(s) for s in sets], np.int64)
    n = len(sets)
    owner = np.repeat(np.arange(n), size)
    values, number, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    new = np.cumsum(many > 1) - 1
    keep = many[number] > 1
    owner, column = owner[keep], new[number[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((n, n), np.float32)
    width = max(256, (16 << 20) // (4 * n))
    total = int((many > 1).sum())
    for a in range(0, total, width):
        lo, hi = np.searchsorted(column, [a, a + width])
        block = np.zeros((n, min(width, total - a)), np.float32)
        block[owner[lo:hi], column[lo:hi] - a] = 1
        common += block @ block.T
    # c / (x + y - c) >= num / den  <=>  (num + den) c >= num (x + y); counts are exact in float32 below 2**24
    out = (threshold_num + threshold_den) * common.astype(np.int64) >= threshold_num * (size[:, None] + size[None, :])
    out &= size[:, None] > 0
    np.fill_diagonal(out, False)
    if not inner:
        out &= left[:, None] != left[None, :]
    return out


def _verified(num: int, den: int):
    keys = ["root", "a", "b"]

    def run(batches):
        for table in whole_groups(batches, keys, rows=4000):
            rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
            left = table.column("left").to_numpy(zero_copy_only=False)
            inner = table.column("a").to_numpy() == table.column("b").to_numpy()
            data, off = column_bytes(table.column("sh"))
            raw = data.tobytes()
            group = group_numbers(table, keys)
            first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])).tolist()
            links, to = np.zeros(len(rep), np.int64), np.arange(len(rep))
            for x, y in zip(first, [*first[1:], len(rep)]):
                if y - x > 1:
                    sets = [np.frombuffer(raw[off[k]:off[k + 1]], np.uint64) for k in range(x, y)]
                    m = linked(sets, left[x:y], bool(inner[x]), num, den)
                    links[x:y] = m @ copies[x:y]
                    i, j = np.nonzero(np.triu(m))
                    to[x:y] = x + smallest_reachable(y - x, i, j)
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(links), pa.array(rep[to])], names=["rep", "links", "to"])

    return run


def ngram_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: tuple[int, int] = (4, 5),
               tolerance: float = 1e-9) -> DataFrame:
    """One row per row of ``df``: id, class_id, class_size, n_links, kept and text_key.

    ``threshold`` is a fraction. A class is a connected component of links;
    class_id is its smallest id (null ids count as largest) and that row is the
    one kept (of rows that repeat it, one). n_links counts the other rows whose
    similarity reaches the threshold, equal texts among them. A text without
    words (null, empty, blank) has no links and is a class of its own. text_key
    is the SHA-256 of the text. Other columns are not read; an empty table gives
    no rows.
    """
    spark = df.sparkSession
    prepare(spark)
    num, den = threshold
    share, parts = num / den, shuffle_partitions(spark)
    text = text_or_empty(text_col)
    source = df.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.sha2(text, 256)).alias("th"), text.alias("text"))
    sigs = materialize(source.mapInArrow(_signatures, "row long, id long, th binary, n long, mins binary"), "ngram-signatures")
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    reps = materialize(sigs.where("n > 0").groupBy("th").agg(
        F.min(first).alias("first"), F.count(F.lit(1)).alias("copies"), F.any_value("n").alias("n"), F.any_value("mins").alias("mins"))
        .select(F.col("first.row").alias("rep"), "first", "th", "copies", "n", "mins"), "ngram-texts")

    # candidates: documents that share a band, compared step by step
    bands = reps.select("rep", "mins").mapInArrow(_bands, "key long, rep long")
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    members = materialize(bands.join(shared, "key"), "ngram-buckets")
    sketches = reps.join(members.select("rep").distinct(), "rep", "left_semi").select("rep", _sketch("mins").alias("sig"))
    dealt = tiled(members.withColumn("tiles", F.ceil(F.col("many") / TILE_DOCS)), "key", "rep", "tiles")
    dealt = dealt.join(sketches, "rep").select("key", "a", "b", "left", "rep", "sig")
    edges = (dealt.repartition(parts, "key", "a", "b").sortWithinPartitions("key", "a", "b")
             .mapInArrow(_candidates(share, tolerance), "u long, v long"))
    comps = materialize(components(edges, "ngram-candidates"), "ngram-components")

    # verification: exact links inside the components of candidates
    wanted = comps.withColumnRenamed("node", "rep").join(reps.select("rep", "th", "copies", "n"), "rep")
    wanted = materialize(wanted.withColumn("h", F.xxhash64("th")), "ngram-wanted")
    bits = spark.sparkContext.broadcast(bit_filter(wanted, "h"))
    sets = (source.select("th", F.xxhash64("th").alias("h"), "text").mapInArrow(_sets(bits), "th binary, n long, sh binary")
            .groupBy("th").agg(F.any_value("sh").alias("sh")))
    sizes = wanted.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / TILE_DOCS),
                                                  F.ceil(F.sum("n") / TILE_SHINGLES)).alias("tiles"))
    dealt = tiled(wanted.join(sets, "th").join(sizes, "root"), "root", "rep", "tiles")
    checked = materialize(dealt.select("root", "a", "b", "left", "rep", "copies", "sh")
                          .repartition(parts, "root", "a", "b").sortWithinPartitions("root", "a", "b", "rep")
                          .mapInArrow(_verified(num, den), "rep long, links long, to long"), "ngram-verified")
    links = checked.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(checked.select(F.col("rep").alias("u"), F.col("to").alias("v")), "ngram-classes")

    named = (reps.select("rep", "first", "th", "copies").join(classes.withColumnRenamed("node", "rep"), "rep", "left")
             .join(links, "rep", "left").withColumn("root", F.coalesce("root", "rep")))
    named = materialize(named, "ngram-named")
    heads = named.groupBy("root").agg(F.min("first").alias("head"), F.sum("copies").alias("class_size"))
    answer = materialize(named.join(heads, "root").select(
        "th", "head", "class_size", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "ngram-answer")
    alone = F.col("head").isNull()
    return (sigs.select("row", "id", "th").join(answer, "th", "left")
            .select(F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("head.id")).alias("class_id"),
                    F.coalesce("class_size", F.lit(1)).alias("class_size"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    (alone | (F.col("row") == F.col("head.row"))).alias("kept"), F.lower(F.hex("th")).alias("text_key")))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that are kept, with all its columns; rows that repeat id and text become one."""
    found = ngram_join(df, id_col, text_col, **options)
    keys = materialize(found.groupBy(F.col(id_col).alias("__tw_id"), F.col("text_key").alias("__tw_key")).agg(
        F.max("kept").alias("__tw_kept"), F.count(F.lit(1)).alias("__tw_rows")), "ngram-kept")
    repeated = not keys.where("__tw_kept AND __tw_rows > 1").isEmpty()
    gone = keys.where("NOT __tw_kept").select(F.col("__tw_id").alias("__tw_gone"), F.col("__tw_key").alias("__tw_gone_key"))
    rows = df.withColumn("__tw_id", F.col(id_col).cast("long")).withColumn("__tw_key", F.sha2(text_or_empty(text_col), 256))
    if repeated:
        rows = rows.dropDuplicates(["__tw_id", "__tw_key"])
    rows = rows.join(gone, F.col("__tw_key").eqNullSafe(F.col("__tw_gone_key")) & F.col("__tw_id").eqNullSafe(F.col("__tw_gone")), "left_anti")
    return rows.drop("__tw_id", "__tw_key")
