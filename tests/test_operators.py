"""Operators on small inline frames: incremental, windows, dedup, joins, landing completeness."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.operators import dedup, incremental, joins, windows
from tidewater.sources import landing as L
from tidewater.sources import adapters as A


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_watermarks_normalize_then_max(spark):
    staged = spark.createDataFrame(
        [("act_1", dt.datetime(2026, 1, 10)), ("1", dt.datetime(2026, 1, 5)), (None, dt.datetime(2026, 1, 1)),
         ("2", None)], "AdAccountID string, UpdatedTime timestamp_ntz")
    wm = incremental.watermarks(staged, "AdAccountID")
    assert rows(wm, "parent_id", "watermark") == [("1", dt.datetime(2026, 1, 10))]


def test_updated_since_strict_and_created_since_inclusive(spark):
    wm = spark.createDataFrame([("1", dt.datetime(2026, 1, 10))], incremental.WATERMARK_SCHEMA)
    recs = spark.createDataFrame(
        [("act_1", 1, dt.datetime(2026, 1, 9)), ("act_1", 2, dt.datetime(2026, 1, 9, 0, 0, 1)),
         ("act_2", 3, dt.datetime(2000, 1, 1))], "p string, id int, t timestamp_ntz")
    kept = incremental.updated_since(recs, wm, "p", "t", dt.timedelta(days=1))
    assert [r[0] for r in kept.orderBy("id").select("id").collect()] == [2, 3]
    kept = incremental.created_since(recs, wm, "p", "t", dt.timedelta(days=1))
    assert [r[0] for r in kept.orderBy("id").select("id").collect()] == [1, 2, 3]


def test_full_refresh_passes_everything(spark):
    recs = spark.createDataFrame([("1", 1, dt.datetime(2000, 1, 1))], "p string, id int, t timestamp_ntz")
    kept = incremental.updated_since(recs, incremental.empty_watermarks(spark), "p", "t", dt.timedelta(hours=6))
    assert kept.count() == 1


def test_weekly_full_refresh():
    assert incremental.resolve_full_refresh(None, dt.date(2026, 12, 3)) is True
    assert incremental.resolve_full_refresh(False, dt.date(2026, 12, 3)) is False
    assert incremental.resolve_full_refresh(None, dt.date(2026, 12, 2)) is False


def test_daily_window():
    assert windows.daily_window(run_date=dt.date(2026, 9, 10)) == (dt.date(2026, 9, 9), dt.date(2026, 9, 10))
    with pytest.raises(ValueError):
        windows.daily_window("2026-09-01", None)
    with pytest.raises(ValueError):
        windows.daily_window("2026-09-01", "2026-09-01")


def test_date_chunks(spark):
    r = spark.createDataFrame([(1, dt.date(2026, 8, 1), dt.date(2026, 9, 1))], "k int, s date, e date")
    got = rows(windows.date_chunks(r, "s", "e", 10), "chunk_since", "chunk_until")
    assert got == [(dt.date(2026, 8, 1), dt.date(2026, 8, 10)), (dt.date(2026, 8, 11), dt.date(2026, 8, 20)),
                   (dt.date(2026, 8, 21), dt.date(2026, 8, 30)), (dt.date(2026, 8, 31), dt.date(2026, 9, 1))]


def test_period_end_day(spark):
    df = spark.createDataFrame([("2026-09-02T07:00:00+0000",)], "t string")
    assert df.select(windows.period_end_day("t")).first()[0] == dt.date(2026, 9, 1)


def test_dedup_first_and_last_null_keys_group(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "p"), (None, 4, "q")],
                               "k string, seq int, v string")
    assert rows(dedup.dedup_first(df, ["k"], ["seq"]), "k", "v") == sorted([("a", "x"), (None, "p")], key=str)
    assert rows(dedup.dedup_last(df, ["k"], ["seq"]), "k", "v") == sorted([("a", "y"), (None, "q")], key=str)


def test_dedup_independent_of_partitioning(spark):
    df = spark.range(0, 2000).select((F.col("id") % 37).alias("k"), F.col("id").alias("seq"),
                                     (F.col("id") * 7 % 101).alias("v"))
    a = rows(dedup.dedup_first(df.repartition(1), ["k"], ["seq"]), "k", "seq", "v")
    b = rows(dedup.dedup_first(df.repartition(17), ["k"], ["seq"]), "k", "seq", "v")
    assert a == b and len(a) == 37 and all(seq == k for k, seq, _ in a)


def test_conform_semi_and_quarantine(spark):
    kids = spark.createDataFrame([(1, "10"), (2, "11"), (3, None), (4, "")], "id int, campaign_id string")
    parents = spark.createDataFrame([(10,)], "CampaignID long")
    assert rows(joins.conform_semi(kids, "campaign_id", parents, "CampaignID"), "id") == [(1,)]
    assert rows(joins.conform_quarantine(kids, "campaign_id", parents, "CampaignID"), "id") == [(2,), (3,), (4,)]


def test_conform_flag_splits_like_semi_and_anti(spark):
    """One flagged join: true rows = the semi join, false rows = the quarantine;
    duplicate parent keys never multiply a child."""
    kids = spark.createDataFrame([(1, "10"), (2, "11"), (3, None), (4, ""), (5, "10")], "id int, campaign_id string")
    parents = spark.createDataFrame([(10,), (10,), (None,)], "CampaignID long")
    flagged = joins.conform_flag(kids, "campaign_id", parents, "CampaignID")
    assert flagged.count() == 5
    assert rows(flagged.where("_conformed"), "id") == rows(
        joins.conform_semi(kids, "campaign_id", parents, "CampaignID"), "id")
    assert rows(flagged.where("not _conformed"), "id") == rows(
        joins.conform_quarantine(kids, "campaign_id", parents, "CampaignID"), "id")
    assert rows(flagged.where("_conformed"), "id") == [(1,), (5,)]


def test_lookup_match_wins_even_null(spark):
    recs = spark.createDataFrame([(1, "a1", "7"), (2, "zz", "7")], "id int, adset string, own string")
    lookup = spark.createDataFrame([("a1", None)], "AdSetID string, CampaignID string")
    out = joins.lookup_match_wins(recs, "adset", lookup, "AdSetID", {"campaign": ("CampaignID", "own")})
    assert rows(out, "id", "campaign") == sorted([(1, None), (2, "7")], key=str)


def test_complete_parents(spark):
    base = spark.createDataFrame(
        [("p1", 0, True), ("p1", 1, False), ("p2", 0, True), ("p2", 1, True), ("p3", 1, False)],
        "parent string, page int, has_next boolean")
    pages = A.landing(base, "x", F.col("parent"), F.col("page"), [A.rec(id=F.col("page"))],
                      F.when(F.col("has_next"), F.lit("next")))
    assert rows(L.complete_parents(pages), "parent_id") == [("p1",)]


def test_rejected_pages(spark):
    pages = spark.createDataFrame([("x", "p", 0, '{"data":{"a":1}}'), ("x", "p", 1, '{"data":[]}')],
                                  "entity string, parent_id string, page_no long, body string")
    assert L.rejected_pages(pages).count() == 1
    assert L.explode_pages(pages).count() == 0


def test_complete_parents_root_scoped(spark):
    base = spark.createDataFrame([(0, False)], "page int, has_next boolean")
    pages = A.landing(base, "account", None, F.col("page"), [A.rec(id=F.lit("act_1"))])
    recs = L.keep_complete(L.explode_pages(pages), pages)
    assert recs.count() == 1


def test_number_pages_prefix_sum_matches_row_number(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000).select(
        F.lit("x").alias("entity"), (F.col("id") % 3).cast("string").alias("parent_id"),
        (F.col("id") * 7919 % 100003).alias("page_no"), F.col("id").cast("string").alias("body"))
    got = A.number_pages(df, bucket=64)
    want = df.withColumn("page_no", (F.row_number().over(
        Window.partitionBy("entity", "parent_id").orderBy("page_no")) - 1).cast("bigint"))
    assert rows(got, "parent_id", "page_no", "body") == rows(want, "parent_id", "page_no", "body")
