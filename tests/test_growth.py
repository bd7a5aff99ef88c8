"""What must not grow with the input: tasks, parses of a record, broadcast sides, shuffled text."""
import datetime as dt
import json
import re

from pyspark.sql import functions as F

from tests.test_plans import plan_text
from tidewater.functions.coerce import number_keep_nan
from tidewater.functions.metrics import action_sum
from tidewater.operators import loads
from tidewater.plans import entities
from tidewater.schemas import LANDING, RAW_AD_INSIGHT, RAW_ADSET
from tidewater.sources import adapters as A
from tidewater.sources import landing as L


def _pages(spark, entity, *records):
    return spark.createDataFrame([(entity, "act_1", k, json.dumps({"data": [r], "paging": {}})) for k, r in enumerate(records)], LANDING)


def test_an_input_is_spread_by_its_size(spark, tmp_path, monkeypatch):
    spark.range(20_000).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    size = A.input_bytes(spark, f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(A, "TASK_BYTES", size // 20)
    df = A.table(spark, str(tmp_path), "orders")
    assert df.rdd.getNumPartitions() >= 20 and df.agg(F.sum("id")).first()[0] == sum(range(20_000))


def test_a_filter_on_a_field_parses_no_record_again(spark):
    pages = _pages(spark, "ad_insight", {"ad_id": "1", "date_start": "2024-01-02", "spend": "2.5"}, {"ad_id": "2"}, {"ad_id": None})
    out = entities.ad_insights_daily(L.explode_pages(pages, RAW_AD_INSIGHT))
    assert [(r.AdID, r.Date, float(r.Spend)) for r in out.collect()] == [(1, dt.date(2024, 1, 2), 2.5)]
    assert not [line for line in plan_text(out, "extended").split("== Optimized")[1].split("\n") if "Filter" in line and "from_json" in line]


def test_action_sum_and_numbers_keep_their_rules(spark):
    texts = ["1.5", "none", "bad", "12d", "3f", "NaN", "nan", "inf", "-Infinity", "+INF", "5.", "", " 7 ", "1e3", "1e", "x", None]
    want = [1.5, None, None, None, None, "nan", "nan", "inf", "-inf", "inf", 5.0, None, 7.0, 1000.0, None, None, None]
    got = [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(number_keep_nan("t")).collect()]
    assert [str(g) if g is not None and (g != g or abs(g) == float("inf")) else g for g in got] == want
    rows = [(0, [("lead", "1"), ("lead", "bad"), ("click", "9"), ("lead", "2")]), (1, [("lead", "none")]), (2, []), (3, None), (4, [("lead", "NaN"), ("lead", "1")]), (5, [("lead", "true")])]
    df = spark.createDataFrame(rows, "k int, a array<struct<action_type:string,value:string>>")
    assert [r[0] for r in df.orderBy("k").select(action_sum("a", ["lead"])).collect()] == [3.0, None, None, None, None, 1.0]


def test_keys_of_a_wide_table_are_not_broadcast_by_a_guess(spark, tmp_path):
    for name in ("old", "new"):
        spark.range(50_000).select("id", *[F.lit(None).cast("string").alias(f"c{k}") for k in range(20)]).write.parquet(f"{tmp_path}/{name}")
    new = loads.upsert(spark.read.parquet(f"{tmp_path}/old"), spark.read.parquet(f"{tmp_path}/new"), ["id"])
    assert "Broadcast" not in plan_text(new) and new.count() == 50_000


def test_record_text_is_not_shuffled_to_find_the_campaign(spark, tmp_path):
    recs = [{"id": str(k), "campaign_id": c, "name": f"n{k}", "pacing_type": ["standard"], "targeting": {"age_min": k}}
            for k, c in enumerate(["1", "2", "", None, "01", "1"])]
    spark.range(1, 2).write.parquet(f"{tmp_path}/campaigns")
    staged = spark.read.parquet(f"{tmp_path}/campaigns").withColumnRenamed("id", "CampaignID")
    _pages(spark, "adset", *recs).write.parquet(f"{tmp_path}/pages")
    out = entities.adset(L.explode_pages(spark.read.parquet(f"{tmp_path}/pages"), RAW_ADSET), staged)
    assert {(r.AdSetID, r.PacingType, r.TargetingAgeMin) for r in out.collect()} == {(0, '["standard"]', 0), (5, '["standard"]', 5)}
    spark.conf.set("spark.sql.debug.maxToStringFields", "500")
    try:
        plan = plan_text(out)
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    joins = re.findall(r"\) Exchange[^\n]*\nInput \[\d+\]: \[([^\n]*)\]", plan)
    assert joins and not [j for j in joins if "_rec#" in j]


def test_ordinals_join_only_the_buckets_after_a_first_one(spark, tmp_path):
    rows = [(k % 3, v, v // 10) for k, v in enumerate([5, 12, 7, 33, 11, 9, 41, 8, 2])] + [(None, 3, 0), (None, 15, 1), (4, None, None), (4, 9, 0), (4, 1, 0)]
    spark.createDataFrame(rows, "k int, v int, b int").write.parquet(f"{tmp_path}/t")
    out = A.with_ordinal(spark.read.parquet(f"{tmp_path}/t"), ["k"], ["v"], F.col("b"), "n")
    want = {}
    for k, v, b in rows:
        want.setdefault(k, []).append((v is not None, v or 0))
    # a row without a bucket takes the first place and has no row
    assert {(r.k, r.v, r.n) for r in out.collect()} == {(k, v, n) for k, vs in want.items() for n, (there, v) in enumerate(sorted(vs), 1) if there}
    assert "LeftOuter" in plan_text(out)


def _exchanged(df, column):
    """How many exchanges of the plan carry the column."""
    return len([c for c in re.findall(r"\) Exchange[^\n]*\nInput \[\d+\]: \[([^\n]*)\]", plan_text(df)) if f"{column}#" in c])


def test_ordinals_move_a_row_once(spark, tmp_path):
    rows = [("a" if k % 3 else None, k % 2, k, k // 4, f"p{k}") for k in range(20)]
    spark.createDataFrame(rows, "k string, j int, v int, b int, payload string").write.parquet(f"{tmp_path}/t")
    out = A.with_ordinal(spark.read.parquet(f"{tmp_path}/t"), ["k", "j"], ["v"], F.col("b"), "n")
    assert out.columns == ["k", "j", "v", "b", "payload", "n"] and _exchanged(out, "payload") == 1
    want = {(k, j, v, sum(r[:2] == (k, j) and r[2] <= v for r in rows)) for k, j, v, *_ in rows}
    assert {(r.k, r.j, r.v, r.n) for r in out.collect()} == want


def test_ad_set_pages_of_an_account_follow_its_orders(spark):
    from tidewater.plans import queries as Q
    day = dt.datetime(1995, 1, 1)
    items = [(o, n, p, 1, float(p), 1.0, 0.0, 0.0, "A", "F", day) for o, n, p in
             [(70_000, 1, 5), (70_000, 2, 4), (3, 1, 9), (3, 1, 8), (3, None, 7), (4, 1, 6), (None, 1, 2), (99, 1, 1)]]
    li = spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double,"
                                      " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    orders = spark.createDataFrame([(70_000, 1), (3, 1), (4, None), (None, 5), (8, 1)], "o_orderkey long, o_custkey long")
    got = {(r.entity, r.parent_id, r.page_no): json.loads(r.body)["data"][0] for r in Q._account_adset_pages(li, orders).collect()}
    assert {k: (r["id"], r["targeting"]["age_min"]) for k, r in got.items()} == {
        ("adset", "act_1", 0): ("31", 8), ("adset", "act_1", 1): ("31", 9), ("adset", "act_1", 2): ("700001", 5),
        ("adset", "act_1", 3): ("700002", 4), ("adset", None, 0): ("41", 6)}


def test_code_that_hotspot_would_not_compile_is_not_generated(spark):
    # a method of more than 8000 bytes of bytecode runs interpreted
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
