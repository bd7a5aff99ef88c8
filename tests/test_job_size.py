"""What the jobs over tables of any size must not do: end at a sum of keys, leave shuffle files behind, move page bodies."""
import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from tests.test_growth import _exchanged
from tests.test_plans import plan_text
from tidewater.operators import incremental
from tidewater.plans import pipeline as P
from tidewater.plans import queries as Q
from tidewater.plans.queries import QUERIES
from tidewater.schemas import LANDING
from tidewater.sources import landing as L
from tidewater.sources.store import StagingStore

#: three parts whose ad ids (part, then six digits of the supplier) add up to more than a bigint holds
PARTS = [9_000_000_000_001, 9_000_000_000_002, 9_100_000_000_003]


def _tables(spark, folder):
    """Small tables of the driver's schema, three line items on each of two days."""
    day = dt.datetime(1992, 1, 12)
    items = [(o, o % 10_000_000_000 + k, 1, n, 2.0, 10.5, 0.0, 0.0, "N", "O", day + dt.timedelta(days=n)) for n in (0, 1) for k, o in enumerate(PARTS)]
    items = [(k + 1, PARTS[k % 3], *row[2:]) for k, row in enumerate(items)]
    rows = {
        "customer": ([(k, f"c{k}", 1, 5.0, "X") for k in (1, 2, 51)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": ([(1, "N1", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(k, f"s{k}", 1, 5.0) for k in (1, 2)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "orders": ([(k, (1, 2, 51)[k % 3], "O", 7.25, dt.datetime(1995, 1, k), "1-URGENT") for k in range(1, 7)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double,"
                            " l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "events": ([(k, dt.datetime(2024, 1, 12, k), 1 + k % 3, "click", 1.5, "{}") for k in range(6)],
                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
        "documents": ([(k, "text", "en", "web", 4) for k in (1, 2, 103)], "doc_id long, text string, lang string, source string, n_chars long"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_the_key_sum_of_a_backfilled_day_is_larger_than_a_bigint(spark, tmp_path):
    out = QUERIES["backfill_tables"](spark, _tables(spark, str(tmp_path))).where(F.col("TableName") == "AdInsightsDaily").collect()
    ids = [p * 1_000_000 + 1 for p in PARTS]
    assert sum(ids) > 2**63
    assert {r.DateKey: (r.TableRows, int(r.KeySum), float(r.ValueSum)) for r in out} == {day: (3, sum(ids), 31.5) for day in (20240112, 20240113)}


def test_the_key_sum_of_the_daily_run_is_larger_than_a_bigint(spark, tmp_path):
    out = {r.FunctionName: r for r in QUERIES["daily_staging"](spark, _tables(spark, str(tmp_path))).collect()}
    assert len(out) == 10 and {r.Status for r in out.values()} == {"succeeded"}
    ads = out["fact_ad_insights_daily"]
    assert (ads.TableRows, int(ads.KeySum)) == (6, 2 * sum(p * 1_000_000 + 1 for p in PARTS))


def _page(entity, parent, page_no, *records, more=False):
    return entity, parent, page_no, json.dumps({"data": records, "paging": {"next": "n"} if more else {}})


def _ctx(spark, folder, pages, **options):
    spark.createDataFrame(pages, LANDING).write.parquet(f"{folder}/landing")
    return P.RunContext(spark=spark, landing=spark.read.parquet(f"{folder}/landing"), store=StagingStore(spark, f"{folder}/store"),
                        run_date=dt.date(2026, 9, 10), load_ts=dt.datetime(2026, 9, 10, 6), **options)


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_steps_leave_no_shuffle_files_and_no_step_files(spark, tmp_path, monkeypatch):
    campaigns = [{"id": str(k), "account_id": "act_1", "updated_time": "2026-09-09T00:00:00+0000"} for k in range(20)]
    adsets = [{"id": str(100 + k), "campaign_id": str(k), "updated_time": "2026-09-09T00:00:00+0000"} for k in range(25)]
    ctx = _ctx(spark, tmp_path, [_page("account", None, 0, {"id": "act_1"}), _page("campaign", "act_1", 0, *campaigns), _page("campaign", "act_9", 0, *campaigns),
                                 _page("adset", "act_1", 0, *adsets), _page("adset", "act_1", 1)], scoped=True)
    folders, step_folder = [], ctx.step_folder
    monkeypatch.setattr(ctx, "step_folder", lambda: folders.append(step_folder()) or folders[-1])
    setting, before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"), _shuffle_files(spark)
    results = P.run_steps(ctx, [("a", P.step_ad_account), ("c", P.step_campaign), ("s", P.step_adset)])
    assert [(r.status, r.rows_received) for r in results] == [("succeeded", 1), ("succeeded", 20), ("succeeded", 20)]
    for _ in range(40):  # they are removed in the background
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    assert not left and folders and not [f for f in folders if ctx.store.files.exists(f)]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_a_first_load_joins_no_watermarks(spark, tmp_path):
    ctx = _ctx(spark, tmp_path, [_page("campaign", "act_1", 0, {"id": "1"})])
    records = L.explode_pages(ctx.landing, P.RAW_CAMPAIGN)
    for full in (False, True):
        ctx.full_refresh = full
        kept = incremental.updated_since(records, P._wms(ctx, "Campaign", "AdAccountID"), "_parent", F.col("updated_time").cast("timestamp_ntz"), dt.timedelta(days=1))
        assert "Join" not in plan_text(kept) and [r.id for r in kept.collect()] == ["1"]


@pytest.mark.parametrize("few", [100_000, 1, 0])
def test_page_bodies_are_not_shuffled_to_find_their_parents(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(L, "FEW_PARENTS", few)
    pages = [_page("campaign", p, 0, {"id": "1"}) for p in ("act_1", "act_2", "3", "act_8", None)]
    ctx = _ctx(spark, tmp_path, pages, scoped=True)
    spark.createDataFrame([("act_1",), ("act_2",), ("3",)], "AccountID string").write.parquet(f"{tmp_path}/accounts")
    monkeypatch.setattr(ctx.store, "read", lambda name: spark.read.parquet(f"{tmp_path}/accounts"))
    for landing, want in ((ctx.landing, {"act_1", "act_2", "3"}), (ctx.landing.where("parent_id <> 'act_8'"), {"act_1", "act_2", "3"}), (ctx.landing.where("parent_id = 'act_8'"), set())):
        ctx.landing = landing
        rows = ctx.pages("campaign")
        assert {r.parent_id for r in rows.collect()} == want
        assert _exchanged(rows, "body") == 0 or few == 0
    ctx.release()


def test_pages_are_counted_by_their_bits(spark):
    cases = {"whole": range(200), "twice": [0, 0, 1, 1], "hole": [k for k in range(200) if k != 70], "filled_up": [*range(70), 69, *range(71, 200)],
             "late": range(1, 66), "below": [-1, 0, 1], "one": [0], "unnumbered": [None], "partly": [None, 0, 1], None: [0, 1, 64]}
    pages = [_page("x", p, n, {"id": "1"}) for p, ns in cases.items() for n in ns] + [_page("x", "open", 0, more=True), ("x", "bad", 0, '{"data": 5}')]
    got = {r.parent_id: r.reason for r in L.fetched_parents(spark.createDataFrame(pages, LANDING).repartition(5)).collect()}
    want = {p: None if ns and min(ns) == 0 and len(ns) == max(ns) + 1 else "page_missing" for p, ns in ((p, {n for n in ns if n is not None}) for p, ns in cases.items())}
    assert got == {**want, "open": "not_finished", "bad": "data_not_a_list"}


def test_ad_sets_of_an_order_that_comes_twice_come_twice(spark):
    day = dt.datetime(1995, 1, 1)
    items = [(o, n, p, 1, float(p), 1.0, 0.0, 0.0, "A", "F", day) for o, n, p in [(3, 1, 9), (3, 1, 8), (3, 2, 7), (200_000, 1, 6), (5, 1, 5), (5, 1, 5), (6, 1, 4)]]
    li = spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double,"
                                      " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    orders = spark.createDataFrame([(3, 1), (3, 1), (3, 2), (5, 1), (200_000, 1), (6, 2), (6, None)], "o_orderkey long, o_custkey long")
    got = {}
    for r in Q._account_adset_pages(li, orders).collect():
        got.setdefault(r.parent_id, []).append((r.page_no, json.loads(r.body)["data"][0]))
    order = {k: [(x["id"], x["targeting"]["age_min"]) for _, x in sorted(v, key=lambda y: y[0])] for k, v in got.items()}
    assert all(sorted(n for n, _ in v) == list(range(len(v))) for v in got.values())
    assert order == {"act_1": [("31", 8)] * 2 + [("31", 9)] * 2 + [("32", 7)] * 2 + [("51", 5)] * 2 + [("2000001", 6)],
                     "act_2": [("31", 8), ("31", 9), ("32", 7), ("61", 4)], None: [("61", 4)]}
