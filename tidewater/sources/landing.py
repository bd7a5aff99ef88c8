"""Landed API pages -> typed raw records (SRC-1 ... SRC-9).

A landing row is one page of one endpoint for one parent:
``(entity, parent_id, page_no, body)`` with ``body`` the page envelope
``{"data": [...], "paging": {"next": ...}}``. The lander (outside this
package) writes them as Parquet or JSON lines under ``entity=/run_date=``
folders so a scan prunes by entity and day.

Every record keeps its arrival position ``(_parent, _page, _pos)``; keep-first
dedup and last-row-wins pivots order by it, so results never depend on how
Spark happened to partition the pages.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.schemas import ENVELOPE, LANDING

SEQ_COLS = ("_parent", "_page", "_pos")
#: a landed page with the day of the run that fetched it (a partition column; NULL: any run)
LANDED = T.StructType([*LANDING.fields, T.StructField("run_date", T.DateType())])
#: one fetch: an endpoint read for a parent by a run
FETCH = ("entity", "run_date", "parent_id")


def read_landing(spark: SparkSession, path: str, entity: str | None = None,
                 fmt: str = "parquet", run_date: dt.date | None = None) -> DataFrame:
    """SRC-9 for landings: schema-explicit scan, optional entity and run filters
    (partition filters when the landing is laid out by ``entity=/run_date=``).

    A run fetches every parent afresh, so ``run_date`` reads that run's pages
    alone: page numbers of different runs never mix and completeness is judged
    for the run. Pages that carry no run date belong to every run.
    """
    df = spark.read.schema(LANDED).format(fmt).load(path)
    if run_date is not None:
        df = df.where(F.col("run_date").isNull() | (F.col("run_date") == F.lit(run_date)))
    df = df.select(*LANDING.fieldNames())
    return df.where(F.col("entity") == entity) if entity else df


def _with_envelope(pages: DataFrame) -> DataFrame:
    return pages.withColumn("_env", F.from_json("body", ENVELOPE))


def rejected_pages(pages: DataFrame) -> DataFrame:
    """Pages whose ``data`` is not a list, with their body (jobs record the parent, see ``fetched_parents``)."""
    return (_with_envelope(pages).where(F.col("_env.data").isNull())
            .select("entity", "parent_id", "page_no", "body", F.lit("data_not_a_list").alias("reason")))


def page_rows(pages: DataFrame) -> DataFrame:
    """One envelope parse per page, shared by SRC-1 and SRC-5.

    One row per record (``_pos``, record text ``_rec``) and one row with
    ``_rec`` NULL for a page whose ``data`` is empty or not a list (``_bad``),
    so page-level facts (``_has_next``) survive for pages without records.
    """
    # posexplode_outer and no filter here: for a plain generator Catalyst
    # infers `size(data) > 0` and pushes it below the projection, which
    # parses every envelope twice.
    env = _with_envelope(pages)
    return env.select(
        F.col("parent_id").alias("_parent"),
        F.col("page_no").alias("_page"),
        F.col("_env.paging.next").isNotNull().alias("_has_next"),
        F.col("_env.data").isNull().alias("_bad"),
        F.posexplode_outer("_env.data").alias("_pos", "_rec"),
    )


def parse_records(rows: DataFrame, schema: T.StructType | None = None,
                  keep_text: bool = True) -> DataFrame:
    """Record rows of ``page_rows`` -> ``_parent, _page, _pos, _has_next``, the
    record text ``_rec`` (column pruning drops it when unused) and, with
    ``schema``, the raw record fields."""
    recs = rows.where(F.col("_rec").isNotNull()).select("_parent", "_page", "_has_next", "_pos", "_rec")
    if schema is None:
        return recs
    # a generator and no plain projection: Catalyst would push a filter on a field
    # below the projection, with one more parse of the record for every use of the field
    cols = [*SEQ_COLS, "_has_next"] + (["_rec"] if keep_text else [])
    return recs.select(*cols, F.inline_outer(F.array(F.from_json("_rec", schema))))


def explode_pages(pages: DataFrame, schema: T.StructType | None = None,
                  keep_text: bool = True) -> DataFrame:
    """SRC-1: one row per record, in page order (see ``parse_records``)."""
    return parse_records(page_rows(pages), schema, keep_text)


def landed_parents(pages: DataFrame, parents: DataFrame, parent_col: str) -> DataFrame:
    """The parents of landed pages, with ``staged`` true where ``parents`` holds them; bodies are not read."""
    ids = read_ids(parents, parent_col, "parent_id").withColumn("_there", F.lit(True))
    return read_ids(pages, "parent_id", "parent_id").join(ids, "parent_id", "left").select("parent_id", F.col("_there").isNotNull().alias("staged"))


def pages_of(pages: DataFrame, landed: DataFrame, n_staged: int, n_others: int) -> DataFrame:
    """SRC-2 + SRC-4 before the parse: landed pages whose parent is staged.

    ``landed``: ``landed_parents`` of the pages, of which ``n_staged`` are staged and
    ``n_others`` are not. The fewer are broadcast, up to ``FEW_PARENTS``, so page bodies
    are not shuffled; beyond that it is a semi join like others. The envelopes of
    other parents are not parsed.
    """
    if not n_others:
        return pages.where(F.col("parent_id").isNotNull())
    staged = landed.where("staged").select("parent_id")
    if n_others < n_staged and n_others <= FEW_PARENTS:
        return pages.where(F.col("parent_id").isNotNull()).join(F.broadcast(landed.where("not staged").select("parent_id")), "parent_id", "left_anti")
    return pages.join(F.broadcast(staged) if n_staged <= FEW_PARENTS else staged, "parent_id", "left_semi")


def parent_scoped(records: DataFrame, parents: DataFrame, parent_col: str = "id") -> DataFrame:
    """SRC-2: keep records whose landing parent is in the parent list.

    One distributed semi join replaces the per-parent request loop; every
    record keeps its parent tag in ``_parent``.
    """
    keys = parents.select(F.col(parent_col).cast("string").alias("_parent")).where(
        F.col("_parent").isNotNull())
    return records.join(keys, "_parent", "left_semi")


def complete_parent_rows(rows: DataFrame) -> DataFrame:
    """SRC-5 over ``page_rows``: parents whose landing is complete: pages
    0..n-1 all present, every ``data`` a list, and the last page without a
    ``next`` link. One aggregate with a partial step (a parent with millions
    of pages is pre-reduced per task). Output: ``parent_id``."""
    return _finished(_first_of_page(rows), ["_parent"]).select(F.col("_parent").alias("parent_id"))


def fetched_parents(pages: DataFrame) -> DataFrame:
    """SRC-5 over landed pages of one entity: every ``parent_id`` with the ``reason`` why its landing is not complete, or NULL."""
    return _fetches(_page_facts(pages), ["_parent"]).select(F.col("_parent").alias("parent_id"), "reason")


def _page_facts(pages: DataFrame, *keys: str) -> DataFrame:
    """What the completeness of a fetch depends on, one row per page, without its records."""
    return _with_envelope(pages).select(
        *keys, F.col("parent_id").alias("_parent"), F.col("page_no").alias("_page"), F.col("_env.paging.next").isNotNull().alias("_has_next"),
        F.col("_env.data").isNull().alias("_bad"))


def _first_of_page(rows: DataFrame) -> DataFrame:
    """One row per page: its first record (_pos 0) or the NULL row of an empty page."""
    return rows.where(F.coalesce(F.col("_pos"), F.lit(0)) == 0)


def _fetches(per_page: DataFrame, keys: list[str]) -> DataFrame:
    """Each fetch (``keys``) with the reason why it is not complete, or NULL.

    Distinct pages are counted as the bits of 64 pages in a row, so a task hands on one row for 64 pages of a fetch.
    """
    per_block = per_page.groupBy(*keys, F.shiftright("_page", 6).alias("_block")).agg(
        F.max_by(F.col("_has_next"), F.col("_page")).alias("last_has_next"),
        F.max("_page").alias("max_page"),
        F.bit_or(F.expr("shiftleft(1L, CAST(_page & 63 AS INT))")).alias("pages"),
        F.min("_page").alias("min_page"),
        F.count_if(F.col("_bad")).alias("bad_pages"),
    )
    per_fetch = per_block.groupBy(*keys).agg(
        F.max_by(F.col("last_has_next"), F.col("max_page")).alias("last_has_next"),
        F.max("max_page").alias("max_page"),
        F.coalesce(F.sum(F.bit_count("pages")), F.lit(0)).alias("n_pages"),
        F.min("min_page").alias("min_page"),
        F.sum("bad_pages").alias("bad_pages"),
    )
    whole = (F.col("min_page") == 0) & (F.col("n_pages") == F.col("max_page") + 1)
    reason = (F.when(F.col("bad_pages") > 0, "data_not_a_list").when(~F.coalesce(whole, F.lit(False)), "page_missing")
              .when(F.coalesce("last_has_next", F.lit(True)), "not_finished"))
    return per_fetch.select(*keys, reason.alias("reason"))


def _finished(per_page: DataFrame, keys: list[str]) -> DataFrame:
    return _fetches(per_page, keys).where(F.col("reason").isNull()).select(*keys)


def finished_fetches(pages: DataFrame) -> DataFrame:
    """SRC-5 over landed pages of several entities and runs: the ``FETCH`` keys
    (entity, run, parent) of which every page is there."""
    return _finished(_page_facts(pages, *FETCH), list(FETCH))


def pages_without(pages: DataFrame, gone: DataFrame, keys: Sequence[str] = FETCH) -> DataFrame:
    """Pages whose ``keys`` (null-safe: root endpoints have no parent) ``gone`` does not hold."""
    gone = gone.select(*[F.col(k).alias(f"_gone_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_gone_{k}")) for k in keys]
    return pages.join(gone, reduce(lambda a, b: a & b, same), "left_anti")


def complete_parents(pages: DataFrame) -> DataFrame:
    """SRC-5 on landed pages (see ``complete_parent_rows``)."""
    return complete_parent_rows(page_rows(pages))


def _semi_done(records: DataFrame, done: DataFrame) -> DataFrame:
    done = done.select(F.col("parent_id").alias("_done"))
    # null-safe: root-scoped endpoints (accounts) land with a NULL parent
    return records.join(done, records["_parent"].eqNullSafe(done["_done"]), "left_semi")


def keep_complete(records: DataFrame, pages: DataFrame) -> DataFrame:
    """Records of complete parents only: nothing is stored for a parent whose
    fetch did not finish (the stated intent, see SRC-5)."""
    return _semi_done(records, complete_parents(pages))


def complete_records(rows: DataFrame, schema: T.StructType | None = None,
                     keep_text: bool = True) -> DataFrame:
    """SRC-1 + SRC-5 from one ``page_rows`` frame: records of complete parents,
    gated before the record parse. Persist ``rows`` when it feeds both sides
    so the envelopes are parsed once."""
    gated = _semi_done(rows.where(F.col("_rec").isNotNull()), complete_parent_rows(rows))
    return parse_records(gated, schema, keep_text)


#: incomplete parents that may be broadcast (their ids take a few MB)
FEW_PARENTS = 100_000


def without_parents(rows: DataFrame, missing: DataFrame, n: int) -> DataFrame:
    """Record rows of ``page_rows`` whose parent is not among the ``n`` parents of ``missing``.

    Fetches that did not complete are few as a rule: with none the rows pass as
    they are, with up to ``FEW_PARENTS`` their ids are broadcast, so record text is not
    shuffled by parent; beyond that it is a join like others.
    """
    records = rows.where(F.col("_rec").isNotNull())
    if not n:
        return records
    gone = missing.select(F.col("parent_id").alias("_gone"))
    gone = F.broadcast(gone) if n <= FEW_PARENTS else gone
    return records.join(gone, F.col("_parent").eqNullSafe(F.col("_gone")), "left_anti")  # null-safe: root endpoints have no parent


def entitled_parents(parents: DataFrame, availability: DataFrame, key: str,
                     flag_col: str = "available", default: bool = False) -> DataFrame:
    """SRC-6: parents that have their own credential, else the default.

    ``availability`` is (key, flag) — a boolean, never the secret itself.
    Parents resolving to false are skipped (see ``skipped_parents``).
    """
    avail = availability.select(key, F.col(flag_col).alias("_flag"))
    joined = parents.join(avail, key, "left")
    return joined.where(F.coalesce(F.col("_flag"), F.lit(default))).drop("_flag")


def skipped_parents(parents: DataFrame, availability: DataFrame, key: str,
                    flag_col: str = "available", default: bool = False) -> DataFrame:
    avail = availability.select(key, F.col(flag_col).alias("_flag"))
    joined = parents.join(avail, key, "left")
    return joined.where(~F.coalesce(F.col("_flag"), F.lit(default))).drop("_flag")


def explode_metric_values(records: DataFrame, values_col: str = "values") -> DataFrame:
    """SRC-7: one row per (metric, value) in array order: ``_vpos``, ``_v``."""
    return (records.select("*", F.posexplode_outer(values_col).alias("_vpos", "_v"))
            .where(F.col("_v").isNotNull()).drop(values_col))


def last_metric_value(values: Column | str, value: Column | str) -> Column:
    """SRC-8: ``values[-1].value`` if the array is non-empty, else ``value``.

    Not ``coalesce``: a non-empty array whose last entry is NULL stays NULL
    (and the row is then skipped by the caller).
    """
    values = F.col(values) if isinstance(values, str) else values
    value = F.col(value) if isinstance(value, str) else value
    return F.when(F.size(values) > 0, F.try_element_at(values, F.lit(-1))["value"]).otherwise(value)


def read_ids(df: DataFrame, column: str, alias: str = "id") -> DataFrame:
    """SRC-4 / DD-3: distinct, non-null ids as strings."""
    return (df.select(F.col(column).cast("string").alias(alias))
            .where(F.col(alias).isNotNull()).distinct())


__all__ = [
    "SEQ_COLS", "LANDED", "FETCH", "read_landing", "rejected_pages", "page_rows", "parse_records", "explode_pages",
    "landed_parents", "pages_of", "parent_scoped", "complete_parent_rows", "fetched_parents", "without_parents", "complete_parents", "finished_fetches", "pages_without",
    "keep_complete", "complete_records",
    "entitled_parents", "skipped_parents", "explode_metric_values", "last_metric_value", "read_ids",
]
