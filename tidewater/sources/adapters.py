"""Test tables -> landed API pages.

The driver's tables (TPC-H-like plus events/documents/conversations) are
re-shaped into the raw landing format ``(entity, parent_id, page_no, body)``
with JSON text bodies, so registered queries exercise the real parse path
(``from_json`` on envelopes and records) and not a shortcut. Adapters are
narrow per-row transforms except where a page must hold several records.
Rules that vary record shape by key parity (``% 2``, ``% 3``, ...) only choose
*which* edge case a row carries; every row of every table is processed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TS_FMT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


# Tables whose row count does not grow with the scale factor
# (25 nations, 5 regions), never worth a shuffle.
FIXED_SIZE_TABLES = ("nation", "region")


# bytes of a Parquet input per task: some 100,000s of rows, each of which is written and parsed as JSON
TASK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str, spread_input: bool = True) -> DataFrame:
    """A test table; ``spread_input=False`` when a hash shuffle follows anyway."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    return spread(df, path) if spread_input and name not in FIXED_SIZE_TABLES else df


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files under ``path`` (a listing: no content is read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def spread(df: DataFrame, path: str | None = None) -> DataFrame:
    """Round-robin an input that scans as fewer partitions than its rows need,
    so the per-row JSON work that follows runs on every core, and in tasks that
    do not get longer as the input grows: one per core at least, and one per
    ``TASK_BYTES`` of the files at ``path``. A no-op for inputs already split
    at least that finely."""
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # e.g. a Spark Connect session: no RDD view, leave the input as is
        return df
    if path is not None:
        target = max(target, -(-input_bytes(df.sparkSession, path) // TASK_BYTES))
    return df.repartition(target) if splits < target else df


def iso_utc(ts: Column | str) -> Column:
    """Naive UTC timestamp -> ``yyyy-MM-dd'T'HH:mm:ss.SSSSSS+0000``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(F.date_format(ts, TS_FMT), F.lit("+0000"))


def rec(**fields: Column) -> Column:
    """JSON text of one record from Spark values (structs/arrays nest);
    NULL fields are left out, i.e. the key is absent."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def json_value(c: Column) -> Column:
    """JSON text of a string value (quoted and escaped); NULL stays NULL."""
    arr = F.to_json(F.array(c.cast("string")))
    return F.when(c.isNotNull(), arr.substr(F.lit(2), F.length(arr) - 2))


def json_num(c: Column) -> Column:
    """JSON text of a numeric value; NULL stays NULL."""
    return c.cast("string")


def rec_text(parts: dict[str, Column]) -> Column:
    """JSON object text from key -> JSON-value-text parts (NULL parts omitted).
    Used where one field's shape differs between rows."""
    items = [F.when(v.isNotNull(), F.concat(F.lit(f'"{k}":'), v)) for k, v in parts.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *items), F.lit("}"))


def page_body(records: list[Column] | Column, next_link: Column | None = None) -> Column:
    """Envelope text ``{"data":[...],"paging":{"next":...}}`` from record texts."""
    data = records if isinstance(records, Column) else F.concat_ws(",", *records)
    paging = F.lit("{}") if next_link is None else rec(next=next_link)
    return F.concat(F.lit('{"data":['), data, F.lit('],"paging":'), paging, F.lit("}"))


def landing(df: DataFrame, entity: str, parent: Column | None, page_no: Column,
            records: list[Column] | Column, next_link: Column | None = None,
            renumber: bool = False) -> DataFrame:
    """One landed page per input row.

    ``renumber``: number each parent's pages 0..n-1 in ``page_no`` order (as a
    lander counts pages), done on the narrow input columns before any JSON
    is built.
    """
    parent_col = parent.cast("string") if parent is not None else F.lit(None).cast("string")
    if renumber:
        df = df.withColumn("_lp", parent_col).withColumn("_pn", page_no.cast("bigint"))
        df = with_ordinal(df, ["_lp"], ["_pn"], F.floor(F.col("_pn") / F.lit(1 << 16)), "_page_ord")
        parent_col, page_no = F.col("_lp"), F.col("_page_ord") - 1
    return df.select(
        F.lit(entity).alias("entity"),
        parent_col.alias("parent_id"),
        page_no.cast("bigint").alias("page_no"),
        page_body(records, next_link).alias("body"),
    )


def with_ordinal(df: DataFrame, keys: list[str], order: list[str], bucket: Column,
                 name: str = "_ord", weight: str | None = None) -> DataFrame:
    """Add the 1-based position of each row among rows sharing ``keys``, in ``order``.
    With ``weight`` a row takes so many positions, and gets the first of them.

    Skew-safe prefix sum instead of one ``row_number()`` over the whole key
    group: ``bucket`` must be monotone in ``order`` (e.g. a range of the first
    order column). Rows are ranked only inside (keys, bucket); each bucket is
    offset by the row count of the buckets before it, from a count table with
    one row per (keys, bucket) after the key's first that is joined back. A key
    holding a third of all rows is thus spread over many small windows, and keys
    of one bucket cost the join nothing.
    """
    from pyspark.sql import Window

    # the keys as one struct: null-safe under a plain "=", so the join asks for the partitioning that the windows have and moves no row again
    columns, order = df.columns, [F.col("_k")[c] if c in keys else F.col(c) for c in order]
    ranged = df.select(F.struct(*keys).alias("_k"), bucket.alias("_bk"), *[c for c in columns if c not in keys])
    counts = ranged.groupBy("_k", "_bk").agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
    before = Window.partitionBy("_k").orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_k").alias("_o_k"), F.col("_bk").alias("_o_bk"), F.sum("_n").over(before).alias("_off")).where(F.col("_off").isNotNull())
    # rows without a bucket get no position, but they come before the others and count
    inside = Window.partitionBy("_k", "_bk").orderBy(*order)
    rank = F.coalesce(F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1 if weight else F.row_number().over(inside)
    ranked = ranged.where(F.col("_bk").isNotNull()).withColumn("_r", rank)
    joined = ranked.join(offsets, (F.col("_k") == F.col("_o_k")) & (F.col("_bk") == F.col("_o_bk")), "left")
    return joined.select(*[F.col("_k")[c].alias(c) if c in keys else F.col(c) for c in columns],
                         (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_r")).alias(name))


def number_pages(pages: DataFrame, bucket: int = 1 << 16) -> DataFrame:
    """Renumber each parent's pages 0..n-1 in ``page_no`` order, as a lander
    counts pages while it follows ``next`` links (skew-safe, see ``with_ordinal``)."""
    numbered = with_ordinal(pages, ["entity", "parent_id"], ["page_no"],
                            F.floor(F.col("page_no") / F.lit(bucket)), "_ord")
    return numbered.select("entity", "parent_id", (F.col("_ord") - 1).cast("bigint").alias("page_no"), "body")
