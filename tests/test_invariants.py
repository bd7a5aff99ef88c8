"""Invariants from the test strategy, plus reference quirks and our decisions on them."""
import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewater.functions import coerce as C
from tidewater.operators import incremental, loads, selection
from tidewater.plans import entities
from tidewater.plans.pipeline import RunContext, run_backfill
from tidewater.schemas import RAW_CAMPAIGN, TABLES
from tidewater.sources import adapters as A
from tidewater.sources import landing as L
from tidewater.sources.store import StagingStore

SF = "/root/testdata/sf0.001"


def _campaign_records(spark):
    from tidewater.plans.queries import _campaign_pages
    return L.explode_pages(_campaign_pages(A.table(spark, SF, "orders")), RAW_CAMPAIGN)


def test_full_refresh_contains_incremental(spark):
    recs = _campaign_records(spark)
    staged = entities.campaign(recs).where(F.col("UpdatedTime") < F.lit(dt.datetime(1998, 1, 1)))
    wms = incremental.watermarks(staged, "AdAccountID")
    inc = incremental.updated_since(recs, wms, "_parent", C.as_datetime("updated_time"), incremental.CAMPAIGN_BUFFER)
    full = incremental.updated_since(recs, incremental.empty_watermarks(spark), "_parent",
                                     C.as_datetime("updated_time"), incremental.CAMPAIGN_BUFFER)
    inc_ids = {r.id for r in inc.select("id").collect()}
    full_ids = {r.id for r in full.select("id").collect()}
    assert inc_ids < full_ids


def test_entity_keys_unique_and_partitioning_independent(spark):
    recs = _campaign_records(spark)
    a = entities.campaign(recs.repartition(1))
    b = entities.campaign(recs.repartition(17))
    assert a.count() == a.select("CampaignID").distinct().count()
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_upsert_twice_equals_once_except_load_date(spark):
    target = E.queries()["proj_campaign"](spark, SF)
    batch = target.where(F.col("CampaignID") % 7 == 0).withColumn("Status", F.lit("X"))
    once = loads.upsert(target, batch, ["CampaignID"], load_ts=dt.datetime(2026, 1, 1))
    twice = loads.upsert(once, batch, ["CampaignID"], load_ts=dt.datetime(2026, 1, 2))
    strip = lambda df: sorted(map(tuple, df.drop("LoadDate").collect()), key=str)
    assert strip(once) == strip(twice)


def test_q7_recent_drops_null_created_all_keeps(spark):
    posts = spark.createDataFrame(
        [("a", 1, dt.datetime(2026, 9, 1)), ("b", 1, None), ("c", 1, dt.datetime(2026, 9, 11))],
        "PostID string, PageID long, CreatedTime timestamp_ntz")
    recent = {r.PostID for r in selection.post_parents(posts, dt.date(2026, 9, 10), "recent", 10).collect()}
    every = {r.PostID for r in selection.post_parents(posts, dt.date(2026, 9, 10), "all").collect()}
    assert recent == {"a"} and every == {"a", "b", "c"}


def test_q26_null_key_rejected(spark):
    batch = spark.createDataFrame([(None, "x")], "CampaignID long, AdAccountID string")
    ok, rejects = loads.split_integrity(batch, TABLES["Campaign"])
    assert ok.count() == 0 and rejects.first().reason == "null_key:CampaignID"


def test_q3_backfill_chunks_are_half_open(spark, tmp_path):
    # one page-insight value per day for 12 days; a 5-day chunked backfill must keep every day
    days = [dt.date(2026, 8, 1) + dt.timedelta(days=i) for i in range(12)]
    rows = [("page_insight", "7", i, '{"data":[{"name":"m","values":[{"end_time":"%sT07:00:00+0000","value":%d}]}],'
             '"paging":{}}' % ((d + dt.timedelta(days=1)).isoformat(), i)) for i, d in enumerate(days)]
    landing = spark.createDataFrame(rows, "entity string, parent_id string, page_no long, body string")
    store = StagingStore(spark, str(tmp_path / "store"))
    # a backfill reads the insights of staged pages
    store.commit({"Page": spark.createDataFrame(landing.selectExpr("CAST(parent_id AS BIGINT)").distinct().collect(), "PageID long").selectExpr(
        "PageID", "CAST(NULL AS STRING) PageName", "CAST(NULL AS BIGINT) BusinessID", "CAST(NULL AS STRING) VerificationStatus",
        "CAST(NULL AS BOOLEAN) IsVerified", "CAST(NULL AS BOOLEAN) IsPublished", "CAST(NULL AS TIMESTAMP_NTZ) LoadDate")})
    ctx = RunContext(spark=spark, landing=landing, store=store, run_date=dt.date(2026, 8, 13),
                     load_ts=dt.datetime(2026, 8, 13))
    results = run_backfill(ctx, days[0], days[-1] + dt.timedelta(days=1), chunk_days=5)
    assert all(r.status == "succeeded" for r in results)
    got = sorted(r.DateKey for r in store.read("PageInsightsDaily").collect())
    assert got == [int(d.strftime("%Y%m%d")) for d in days]


def test_hot_parent_and_hot_key_match_brute_force(spark):
    """One parent lands a third of all pages and one id a third of all records:
    the completeness gate, the conformance split and keep-first dedup still
    give the brute-force answer, with no step gathering the hot group whole."""
    import json

    from tidewater.operators import dedup, joins

    pages = []
    for p in range(30):  # parent "hot" gets 30 of 90 pages; parent c2 misses page 1
        pages.append(("e", "hot", p, [{"id": "7" if i % 2 == 0 else f"h{p}-{i}", "v": f"{p}.{i}"}
                                      for i in range(4)], p < 29))
    for parent in ("c1", "c2", "c3"):
        for p in range(20):
            if parent == "c2" and p == 1:
                continue
            pages.append(("e", parent, p, [{"id": "7" if p % 5 == 0 else f"{parent}-{p}", "v": f"{parent}{p}"}],
                          p < 19))
    text = [(e, par, no, json.dumps({"data": recs, "paging": {"next": "n"} if nxt else {}}))
            for e, par, no, recs, nxt in pages]
    df = spark.createDataFrame(text, "entity string, parent_id string, page_no long, body string")
    rows_ = L.page_rows(df.repartition(7)).persist()
    recs = L.complete_records(rows_, "struct<id string, v string>")

    # brute force: complete parents, then first record per id in (parent, page, pos) order
    done = {"hot", "c1", "c3"}
    flat = sorted((par, no, pos, r["id"], r["v"]) for _, par, no, rs, _ in pages if par in done
                  for pos, r in enumerate(rs))
    first = {}
    for par, no, pos, i, v in flat:
        first.setdefault(i, v)
    got = {r.id: r.v for r in dedup.dedup_first(recs.select("id", "v", "_parent", "_page", "_pos"),
                                                  ["id"], ["_parent", "_page", "_pos"]).collect()}
    assert got == first

    parents = spark.createDataFrame([("7",), ("7",), ("c1-3",)], "k string")
    flagged = joins.conform_flag(recs, "id", parents, "k")
    assert flagged.count() == len(flat)  # duplicate parent keys never multiply children
    assert flagged.where("_conformed").count() == sum(1 for f in flat if f[3] in {"7", "c1-3"})
    rows_.unpersist()
