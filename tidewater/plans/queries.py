"""Registered queries: one per operator of the inventory, each with DuckDB oracle SQL.

Every query reads the driver's test tables in full, re-shapes them into landed
pages where the operator consumes pages (``tidewater.sources.adapters``), runs
the real operator and returns a lazy DataFrame. Column names equal the oracle
SQL's. Queries without oracle SQL (side effects, pipelines) are listed in
``ROWS_ONLY``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import coerce as C
from tidewater.functions.metrics import action_sum, find_metric, leaf_sum
from tidewater.operators import dedup, incremental, joins, loads, selection, windows
from tidewater.plans import audits, entities
from tidewater.schemas import (
    RAW_ACCOUNT, RAW_AD, RAW_AD_INSIGHT, RAW_ADSET, RAW_CAMPAIGN, RAW_PAGE, RAW_PAGE_INSIGHT,
    RAW_POST, RAW_POST_INSIGHT, TableSpec,
)
from tidewater.session import ensure_session_defaults, shuffles_end_with_query
from tidewater.sources import adapters as A
from tidewater.sources import landing as L

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the registered checks (dates in the test data ranges).
WINDOW_SINCE, WINDOW_UNTIL = dt.date(2024, 1, 10), dt.date(2024, 1, 20)
STAGED_BEFORE = dt.datetime(1999, 1, 1)
BATCH_FROM = dt.datetime(1998, 7, 1)
POST_SNAPSHOT = dt.date(2024, 2, 15)
POSTS_UNTIL = dt.date(2000, 1, 1)
BACKFILL_SINCE, BACKFILL_UNTIL = dt.date(1997, 1, 1), dt.date(1997, 3, 1)
INSERT_SPLIT = dt.date(2024, 1, 15)


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_session_defaults(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = " ".join(sql.split())
        return run
    return deco


def _ts(d: dt.datetime) -> F.Column:
    return F.lit(d).cast("timestamp_ntz")


def _pad(c) -> F.Column:
    """Zero-padded text id, so lexical order of parent tags equals numeric order."""
    return F.lpad(c.cast("string"), 20, "0")


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------

_CONV_SCHEMA = T.StructType([T.StructField("turn", T.StringType()), T.StructField("role", T.StringType())])


def _conversation_pages(spark, sf, per_page: int | None) -> DataFrame:
    conv = A.table(spark, sf, "conversations").select("conv_id", "turn", "role")
    if per_page is None:  # one page per turn; `next` missing on the last page only if it is an assistant turn
        # last turn per conversation by a (partial) aggregate joined back, not a
        # window over the whole conversation
        last = conv.groupBy("conv_id").agg(F.max("turn").alias("_max_turn"))
        conv = conv.join(last, "conv_id").withColumn("_last", F.col("turn") == F.col("_max_turn"))
        nxt = F.when(~(F.col("_last") & (F.col("role") == "assistant")),
                     F.concat(F.lit("/conv/"), F.col("conv_id").cast("string"), F.lit("?after="),
                              F.col("turn").cast("string")))
        return A.landing(conv, "conversation", F.col("conv_id"), F.col("turn"),
                         [A.rec(turn=F.col("turn"), role=F.col("role"))], nxt)
    # pages of at most `per_page` records: numbered by a skew-safe ordinal, so
    # repeated (conv_id, turn) rows can never pile up in one page
    numbered = A.with_ordinal(conv, ["conv_id"], ["turn", "role"], F.floor(F.col("turn") / 1024), "_ord")
    paged = (numbered.groupBy("conv_id", F.floor((F.col("_ord") - 1) / per_page).alias("pg"))
             .agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("recs")))
    data = F.regexp_extract(F.to_json("recs"), r"^\[(.*)\]$", 1)
    return A.landing(paged, "conversation", F.col("conv_id"), F.col("pg"), data)


@register("paged_envelope", "SELECT conv_id, turn, role FROM conversations")
def q_paged_envelope(spark, sf):
    """SRC-1/SRC-3: page envelopes -> records (two turns per page)."""
    pages = _conversation_pages(spark, sf, per_page=2)
    recs = L.explode_pages(pages, _CONV_SCHEMA)
    return recs.select(C.as_long("_parent").alias("conv_id"), C.as_long("turn").alias("turn"), "role")


@register("complete_parents", """
    SELECT c.conv_id, c.turn FROM conversations c
    JOIN (SELECT conv_id, arg_max(role, turn) AS r FROM conversations GROUP BY conv_id) l
      ON c.conv_id = l.conv_id WHERE l.r = 'assistant'""")
def q_complete_parents(spark, sf):
    """SRC-5: only parents whose last landed page has no `next`."""
    pages = _conversation_pages(spark, sf, per_page=None)
    recs = L.keep_complete(L.explode_pages(pages, _CONV_SCHEMA), pages)
    return recs.select(C.as_long("_parent").alias("conv_id"), C.as_long("turn").alias("turn"))


def _customer_pages(spark, sf, root: bool = True, renumber: bool = False) -> DataFrame:
    cust = A.table(spark, sf, "customer")
    nation = A.table(spark, sf, "nation")
    src = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey)  # 25 rows at any size
    record = A.rec(
        id=F.concat(F.lit("act_"), F.col("c_custkey").cast("string")), name=F.col("c_name"),
        balance=F.col("c_acctbal"),
        business=F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")))
    parent = None if root else F.col("c_nationkey")
    return A.landing(src, "account", parent, F.col("c_custkey"), [record], renumber=renumber)


@register("parent_scoped_extract", """
    SELECT c_nationkey AS parent_id, c_custkey FROM customer
    WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""")
def q_parent_scoped_extract(spark, sf):
    """SRC-2: records of the listed parents (nations of region 1), tagged with the parent."""
    recs = L.explode_pages(_customer_pages(spark, sf, root=False), RAW_ACCOUNT)
    parents = A.table(spark, sf, "nation").where(F.col("n_regionkey") == 1)
    kept = L.parent_scoped(recs, parents, "n_nationkey")
    return kept.select(F.col("_parent").cast("int").alias("parent_id"),
                       C.as_long(C.bare_account_id("id")).alias("c_custkey"))


@register("read_ids", "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM orders WHERE o_custkey IS NOT NULL")
def q_read_ids(spark, sf):
    """SRC-4/DD-3: distinct non-null parent ids as text."""
    return L.read_ids(A.table(spark, sf, "orders"), "o_custkey")


@register("entitled_parents", """
    SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE COALESCE(l.quality, 0) = 1""")
def q_entitled_parents(spark, sf):
    """SRC-6: parents with their own credential flag, else the default (false)."""
    docs = A.table(spark, sf, "documents").select("doc_id")
    avail = A.table(spark, sf, "labels").select("doc_id", (F.col("quality") == 1).alias("available"))
    return L.entitled_parents(docs, avail, "doc_id")


@register("metric_last_value", """
    SELECT user_id, event_type, arg_max(value, ts) AS value FROM events GROUP BY user_id, event_type""")
def q_metric_last_value(spark, sf):
    """SRC-8: values[-1].value, else value; then the latest record per (parent, metric)."""
    ev = A.table(spark, sf, "events")
    odd = (F.col("event_id") % 2) == 1
    v = A.json_num(F.col("value"))
    values = F.when(odd, F.concat(F.lit('[{"value":"junk"},{"value":'), v, F.lit("}]"))).otherwise(F.lit("[]"))
    record = A.rec_text({"name": A.json_value(F.col("event_type")), "values": values,
                         "value": F.when(~odd, v)})
    pages = A.landing(ev, "post_insight", F.col("user_id"), F.unix_micros(F.col("ts").cast("timestamp")), [record])
    recs = L.explode_pages(pages, RAW_POST_INSIGHT)
    vals = recs.select("_parent", "_page", "_pos", F.col("name").alias("event_type"),
                       C.as_number(L.last_metric_value("values", "value")).alias("value")
                       ).where(F.col("value").isNotNull())
    last = dedup.dedup_last(vals, ["_parent", "event_type"], list(L.SEQ_COLS))
    return last.select(C.as_long("_parent").alias("user_id"), "event_type", "value")


# ---------------------------------------------------------------------------
# Entity projections
# ---------------------------------------------------------------------------

@register("proj_business", """
    SELECT DISTINCT CAST(n_nationkey AS BIGINT) AS BusinessID, n_name AS BusinessName
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def q_proj_business(spark, sf):
    """PRJ-1 + FLT-1: Business from account records."""
    recs = L.explode_pages(_customer_pages(spark, sf), RAW_ACCOUNT)
    return entities.business(recs).select("BusinessID", "BusinessName")


@register("proj_ad_account", """
    SELECT 'act_' || c_custkey AS AccountID, c_name AS AccountName,
           CAST(c_acctbal AS DECIMAL(18,2)) AS Balance, CAST(c_nationkey AS BIGINT) AS BusinessID
    FROM customer""")
def q_proj_ad_account(spark, sf):
    """PRJ-2: AdAccount (AccountID keeps act_)."""
    recs = L.explode_pages(_customer_pages(spark, sf), RAW_ACCOUNT)
    return entities.ad_account(recs).select("AccountID", "AccountName", "Balance", "BusinessID")


def _campaign_pages(orders: DataFrame, renumber: bool = False, next_link: F.Column | None = None) -> DataFrame:
    acct = F.concat(F.lit("act_"), F.col("o_custkey").cast("string"))
    record = A.rec(id=F.col("o_orderkey").cast("string"), account_id=acct,
                   objective=F.col("o_orderpriority"), status=F.col("o_orderstatus"),
                   daily_budget=F.col("o_totalprice"), updated_time=A.iso_utc("o_orderdate"))
    return A.landing(orders, "campaign", acct, F.col("o_orderkey"), [record], next_link, renumber=renumber)


@register("proj_campaign", """
    SELECT o_orderkey AS CampaignID, CAST(o_custkey AS VARCHAR) AS AdAccountID,
           o_orderpriority AS Objective, o_orderstatus AS Status,
           CAST(o_totalprice AS DECIMAL(18,2)) AS DailyBudget, o_orderdate AS UpdatedTime
    FROM orders""")
def q_proj_campaign(spark, sf):
    """PRJ-3 + SRC-1 + DD-1: the minimum end-to-end slice."""
    recs = L.explode_pages(_campaign_pages(A.table(spark, sf, "orders")), RAW_CAMPAIGN)
    return entities.campaign(recs).select("CampaignID", "AdAccountID", "Objective", "Status",
                                          "DailyBudget", "UpdatedTime")


_LI_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]


def _lineitem_page_no(li: DataFrame, order: list[str], bucket: F.Column,
                      renumber: bool) -> tuple[DataFrame, F.Column]:
    """Page number of each lineitem row in its order's landing: by line number,
    then ``order``. ``renumber``: contiguous 0..n-1 per order, from one ordinal
    over (line number, order) instead of an ordinal per line plus a renumbering."""
    if renumber:  # one bucket per line number keeps the windows as small as before
        li = A.with_ordinal(li, ["l_orderkey"], ["l_linenumber", *order], F.col("l_linenumber"))
        return li, F.col("_ord") - 1
    li = A.with_ordinal(li, ["l_orderkey", "l_linenumber"], order, bucket)
    return li, F.shiftleft(F.col("l_linenumber").cast("long"), 31) + F.col("_ord")


def _adset_record() -> F.Column:
    targeting = F.struct(F.struct(F.array(F.col("l_returnflag")).alias("countries")).alias("geo_locations"),
                         F.col("l_quantity").cast("int").alias("age_min"))
    return A.rec(id=(F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"),
                 campaign_id=F.col("l_orderkey").cast("string"), targeting=targeting)


def _adset_pages(li: DataFrame, renumber: bool = False) -> DataFrame:
    li, page_no = _lineitem_page_no(li, _LI_ORDER, F.floor(F.col("l_partkey") / 256), renumber)
    return A.landing(li, "adset", _pad(F.col("l_orderkey")), page_no, [_adset_record()])


def _staged_campaigns(spark, sf) -> DataFrame:
    return (A.table(spark, sf, "orders").where(F.col("o_orderstatus") != "P")
            .select(F.col("o_orderkey").alias("CampaignID")))


@register("proj_adset", """
    SELECT AdSetID, CampaignID, TargetingAgeMin, TargetingCountries FROM (
      SELECT l_orderkey * 10 + l_linenumber AS AdSetID, l_orderkey AS CampaignID,
             CAST(l_quantity AS INT) AS TargetingAgeMin, '["' || l_returnflag || '"]' AS TargetingCountries,
             row_number() OVER (PARTITION BY l_orderkey * 10 + l_linenumber ORDER BY l_partkey, l_suppkey,
               l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
      FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')) t
    WHERE rn = 1""")
def q_proj_adset(spark, sf):
    """PRJ-4 + JN-1 + SC-6 + DD-1: AdSet with exploded targeting, conformed to staged campaigns."""
    recs = L.explode_pages(_adset_pages(A.table(spark, sf, "lineitem", spread_input=False)), RAW_ADSET)
    out = entities.adset(recs, _staged_campaigns(spark, sf))
    return out.select("AdSetID", "CampaignID", "TargetingAgeMin", "TargetingCountries")


@register("proj_ad", """
    SELECT e.event_id AS AdID, CASE WHEN p.AdSetID IS NOT NULL THEN p.CampaignID ELSE e.user_id END AS CampaignID,
           e.event_id * 10 + 1 AS AdSetID, e.ts AS UpdatedTime
    FROM events e LEFT JOIN (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS AdSetID,
           CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_orderkey END AS CampaignID FROM lineitem) p
      ON p.AdSetID = e.event_id * 10 + 1""")
def q_proj_ad(spark, sf):
    """PRJ-5 + JN-2: Ad with parent ids looked up from staged AdSet (match wins, even NULL)."""
    ev = A.table(spark, sf, "events")
    record = A.rec(id=F.col("event_id").cast("string"), campaign_id=F.col("user_id").cast("string"),
                   adset_id=(F.col("event_id") * 10 + 1).cast("string"), updated_time=A.iso_utc("ts"))
    pages = A.landing(ev, "ad", F.concat(F.lit("act_"), F.col("user_id").cast("string")),
                      F.col("event_id"), [record])
    li = A.table(spark, sf, "lineitem")
    staged_adsets = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("AdSetID"),
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_orderkey")).alias("CampaignID"),
        F.lit(None).cast("bigint").alias("AdAccountID")).distinct()
    out = entities.ad(L.explode_pages(pages, RAW_AD), staged_adsets)
    return out.select("AdID", "CampaignID", "AdSetID", "UpdatedTime")


@register("proj_creative", """
    SELECT CAST(p_partkey AS VARCHAR) AS CreativeId, p_name AS CreativeName
    FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)""")
def q_proj_creative(spark, sf):
    """PRJ-6 + FLT-1 + DD-1: Creative from ad records (one input -> two outputs)."""
    li = A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = A.table(spark, sf, "part").select("p_partkey", "p_name")
    src = li.join(part, li.l_partkey == part.p_partkey)
    record = A.rec(id=(F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"),
                   creative=F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name")))
    pages = A.landing(src, "ad", _pad(F.col("l_orderkey")), F.col("l_linenumber"), [record])
    return entities.creative(L.explode_pages(pages, RAW_AD)).select("CreativeId", "CreativeName")


@register("proj_page", """
    SELECT s_suppkey AS PageID, s_name AS PageName,
           CAST(CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey ELSE 999 END AS BIGINT) AS BusinessID
    FROM supplier""")
def q_proj_page(spark, sf):
    """PRJ-7 + SC-10: BusinessID = record's business or the parent tag (999)."""
    sup = A.table(spark, sf, "supplier")
    business = F.when(F.col("s_suppkey") % 2 == 0, F.struct(F.col("s_nationkey").cast("string").alias("id")))
    record = A.rec(id=F.col("s_suppkey").cast("string"), name=F.col("s_name"), business=business)
    pages = A.landing(sup, "page", F.lit("999"), F.col("s_suppkey"), [record])
    return entities.page(L.explode_pages(pages, RAW_PAGE)).select("PageID", "PageName", "BusinessID")


@register("proj_post", """
    SELECT source || '_' || doc_id AS PostID, doc_id % 100 AS PageID,
           TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL 1 MINUTE AS CreatedTime, lang AS StatusType
    FROM documents""")
def q_proj_post(spark, sf):
    """PRJ-8: Post with PageID from the parent tag."""
    docs = A.table(spark, sf, "documents").select("doc_id", "source", "lang")
    created = _ts(dt.datetime(2024, 1, 1)) + F.make_dt_interval(mins=F.col("doc_id"))
    record = A.rec(id=F.concat_ws("_", "source", F.col("doc_id").cast("string")),
                   created_time=A.iso_utc(created), status_type=F.col("lang"))
    pages = A.landing(docs, "post", F.col("doc_id") % 100, F.col("doc_id"), [record])
    return entities.post(L.explode_pages(pages, RAW_POST)).select("PostID", "PageID", "CreatedTime", "StatusType")


# ---------------------------------------------------------------------------
# Facts
# ---------------------------------------------------------------------------

def _actions_text() -> F.Column:
    """Ad-insight actions: two lead entries plus a click when the return flag
    is N, else a click and a lead with a non-numeric value."""
    leads = F.concat(
        F.lit('[{"action_type":"lead","value":'), A.json_num(F.col("l_quantity")),
        F.lit('},{"action_type":"lead","value":'), A.json_num(F.col("l_linenumber")),
        F.lit('},{"action_type":"click","value":1}]'))
    no_leads = F.lit('[{"action_type":"click","value":1},{"action_type":"lead","value":"bad"}]')
    return F.when(F.col("l_returnflag") == "N", leads).otherwise(no_leads)


def _ad_insight_pages(li: DataFrame, renumber: bool = False) -> DataFrame:
    order = ["l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
             "l_linestatus", "l_partkey", "l_shipdate"]
    li, page_no = _lineitem_page_no(li, order, F.floor(F.col("l_suppkey") / 16), renumber)
    record = A.rec_text({
        "ad_id": A.json_value(F.col("l_partkey").cast("string")),
        "account_id": A.json_value(F.concat(F.lit("act_"), F.col("l_suppkey").cast("string"))),
        "date_start": A.json_value(F.date_format("l_shipdate", "yyyy-MM-dd")),
        "spend": A.json_num(F.col("l_extendedprice")),
        "impressions": A.json_num(F.col("l_quantity")),
        "actions": _actions_text(),
    })
    return A.landing(li, "ad_insight", _pad(F.col("l_orderkey")), page_no, [record])


@register("ad_insights_daily", """
    SELECT AdID, DateKey, Spend, Impressions, Leads FROM (
      SELECT l_partkey AS AdID, CAST(strftime(l_shipdate, '%Y%m%d') AS INT) AS DateKey,
             CAST(l_extendedprice AS DECIMAL(18,2)) AS Spend, CAST(l_quantity AS BIGINT) AS Impressions,
             CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) + l_linenumber END AS Leads,
             row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE) ORDER BY l_orderkey,
               l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
               l_linestatus) AS rn
      FROM lineitem) t WHERE rn = 1""")
def q_ad_insights_daily(spark, sf):
    """PRJ-9 + AG-3 + SC-4/7/8 + FLT-2 + DD-1: AdInsightsDaily from insight pages."""
    recs = L.explode_pages(_ad_insight_pages(A.table(spark, sf, "lineitem", spread_input=False)), RAW_AD_INSIGHT)
    return entities.ad_insights_daily(recs).select("AdID", "DateKey", "Spend", "Impressions", "Leads")


def _page_insight_pages(ev: DataFrame, renumber: bool = False) -> DataFrame:
    end_time = A.iso_utc(F.col("ts") + F.make_dt_interval(days=F.lit(1)))
    values = F.concat(F.lit('[{"end_time":'), A.json_value(end_time), F.lit(',"value":'),
                      A.json_num(F.col("value")), F.lit("}]"))
    record = A.rec_text({"name": A.json_value(F.col("event_type")), "values": values})
    return A.landing(ev, "page_insight", F.col("user_id"), F.unix_micros(F.col("ts").cast("timestamp")), [record],
                     renumber=renumber)


@register("page_insights_daily", """
    SELECT PageID, DateKey, MetricName, Value FROM (
      SELECT user_id AS PageID, CAST(strftime(ts, '%Y%m%d') AS INT) AS DateKey, event_type AS MetricName,
             CAST(value AS DECIMAL(18,6)) AS Value,
             row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), event_type ORDER BY ts) AS rn
      FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-10' AND CAST(ts AS DATE) < DATE '2024-01-20') t
    WHERE rn = 1""")
def q_page_insights_daily(spark, sf):
    """PRJ-10 + SRC-7 + WN-3 + FLT-3: tall page metrics in a half-open window."""
    recs = L.explode_pages(_page_insight_pages(A.table(spark, sf, "events")), RAW_PAGE_INSIGHT)
    out = entities.page_insights_daily(recs, WINDOW_SINCE, WINDOW_UNTIL)
    return out.select("PageID", "DateKey", "MetricName", "Value")


def _post_insight_pages(docs: DataFrame, renumber: bool = False) -> DataFrame:
    d, n = F.col("doc_id"), F.col("n_chars")
    activity = A.rec(share=F.when(d % 4 != 0, d % 7), comment=d % 5)
    reactions = F.when(d % 3 == 0, A.rec(total=n, like=F.lit(1))).otherwise(A.rec(like=n % 10, love=n % 3))
    act_rec = A.rec_text({"name": F.lit('"post_activity_by_action_type"'),
                          "values": F.concat(F.lit('[{"value":'), activity, F.lit("}]"))})
    rea_rec = A.rec_text({"name": F.lit('"post_reactions_by_type_total"'), "value": reactions})
    post_id = F.concat_ws("_", F.col("source"), d.cast("string"))
    return A.landing(docs, "post_insight", post_id, F.lit(0), [act_rec, rea_rec], renumber=renumber)


@register("post_insights_daily", """
    SELECT source || '_' || doc_id AS PostID, 20240215 AS DateKey,
           CASE WHEN doc_id % 4 = 0 THEN NULL ELSE doc_id % 7 END AS Shares,
           CASE WHEN doc_id % 3 = 0 THEN n_chars ELSE n_chars % 10 + n_chars % 3 END AS Reactions,
           doc_id % 5 AS Comments
    FROM documents""")
def q_post_insights_daily(spark, sf):
    """PRJ-11 + SRC-8 + AG-5 + SC-9 + AG-4: post snapshot pivot."""
    recs = L.explode_pages(_post_insight_pages(A.table(spark, sf, "documents")), RAW_POST_INSIGHT)
    out = entities.post_insights_daily(entities.post_metric_rows(recs), POST_SNAPSHOT)
    return out.select("PostID", "DateKey", "Shares", "Reactions", "Comments")


# ---------------------------------------------------------------------------
# Filters, windows, incremental
# ---------------------------------------------------------------------------

@register("dropna_keys", "SELECT event_id, user_id FROM events WHERE NULLIF(event_type, 'error') IS NOT NULL")
def q_dropna_keys(spark, sf):
    """FLT-2: rows missing a required key are dropped."""
    ev = A.table(spark, sf, "events").select(
        "event_id", "user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"))
    return selection.require_keys(ev, ["event_id", "event_type"]).select("event_id", "user_id")


@register("half_open_window", """
    SELECT event_id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-10' AND CAST(ts AS DATE) < DATE '2024-01-20'""")
def q_half_open_window(spark, sf):
    """FLT-3 + WN-1: since <= day < until."""
    since, until = windows.daily_window("2024-01-10", "2024-01-20")
    ev = A.table(spark, sf, "events")
    return windows.filter_window(ev, F.to_date("ts"), since, until).select("event_id")


def _staged_campaign_table(spark, sf, even_only: bool) -> DataFrame:
    """Campaign staging as of an earlier run: orders before 1999; account ids
    with the act_ prefix on even customers, bare on odd (both forms occur)."""
    o = A.table(spark, sf, "orders").where(F.col("o_orderdate") < _ts(STAGED_BEFORE))
    if even_only:
        o = o.where(F.col("o_custkey") % 2 == 0)
    acct = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("act_"), F.col("o_custkey").cast("string"))
                  ).otherwise(F.col("o_custkey").cast("string"))
    return o.select(F.col("o_orderkey").alias("CampaignID"), acct.alias("AdAccountID"),
                    F.col("o_orderdate").alias("UpdatedTime"))


@register("watermarks", """
    SELECT CAST(o_custkey AS VARCHAR) AS parent_id, max(o_orderdate) AS watermark
    FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY 1""")
def q_watermarks(spark, sf):
    """AG-1: max UpdatedTime per normalized parent."""
    return incremental.watermarks(_staged_campaign_table(spark, sf, even_only=False), "AdAccountID")


def _campaign_records(spark, sf) -> DataFrame:
    return L.explode_pages(_campaign_pages(A.table(spark, sf, "orders")), RAW_CAMPAIGN)


@register("incremental_updated", """
    SELECT o.o_orderkey FROM orders o LEFT JOIN (
      SELECT o_custkey, max(o_orderdate) AS wm FROM orders
      WHERE o_orderdate < TIMESTAMP '1999-01-01' AND o_custkey % 2 = 0 GROUP BY 1) w
      ON o.o_custkey = w.o_custkey
    WHERE w.wm IS NULL OR o.o_orderdate > w.wm - INTERVAL 1 DAY""")
def q_incremental_updated(spark, sf):
    """FLT-4 + JN-3: updated_time > watermark - 1 day per parent; parents without a watermark in full."""
    wms = incremental.watermarks(_staged_campaign_table(spark, sf, even_only=True), "AdAccountID")
    recs = _campaign_records(spark, sf)
    kept = incremental.updated_since(recs, wms, "_parent", C.as_datetime("updated_time"),
                                     incremental.CAMPAIGN_BUFFER)
    return kept.select(C.as_long("id").alias("o_orderkey"))


@register("created_lookback", """
    SELECT e.event_id FROM events e LEFT JOIN (
      SELECT user_id, max(ts) AS wm FROM events WHERE user_id % 3 > 0 GROUP BY 1) w
      ON e.user_id = w.user_id
    WHERE w.wm IS NULL OR e.ts >= w.wm - INTERVAL 7 DAY""")
def q_created_lookback(spark, sf):
    """FLT-5: created >= max(CreatedTime) - lookback per page (7 days here)."""
    ev = A.table(spark, sf, "events")
    staged_posts = ev.where(F.col("user_id") % 3 > 0).select(
        F.col("user_id").alias("PageID"), F.col("ts").alias("CreatedTime"))
    wms = incremental.watermarks(staged_posts, "PageID", "CreatedTime")
    record = A.rec(id=F.col("event_id").cast("string"), created_time=A.iso_utc("ts"))
    pages = A.landing(ev, "post", F.col("user_id"), F.col("event_id"), [record])
    recs = L.explode_pages(pages, RAW_POST)
    kept = incremental.created_since(recs, wms, "_parent", C.as_datetime("created_time"),
                                     dt.timedelta(days=7))
    return kept.select(C.as_long("id").alias("event_id"))


@register("full_refresh", "SELECT o_orderkey FROM orders")
def q_full_refresh(spark, sf):
    """FLT-8 + WN-4: full refresh replaces the watermarks by an empty set."""
    full = incremental.resolve_full_refresh(None, dt.date(2026, 12, 3))  # a Thursday
    staged = _staged_campaign_table(spark, sf, even_only=True)
    wms = incremental.empty_watermarks(spark) if full else incremental.watermarks(staged, "AdAccountID")
    kept = incremental.updated_since(_campaign_records(spark, sf), wms, "_parent",
                                     C.as_datetime("updated_time"), incremental.CAMPAIGN_BUFFER)
    return kept.select(C.as_long("id").alias("o_orderkey"))


@register("extract_summary", """
    SELECT count(DISTINCT o_custkey) FILTER (WHERE o_custkey IN (
             SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' AND o_custkey % 2 = 0))
             AS incremental_parents,
           count(DISTINCT o_custkey) FILTER (WHERE o_custkey NOT IN (
             SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' AND o_custkey % 2 = 0))
             AS full_parents,
           count(*) AS rows_fetched
    FROM orders""")
def q_extract_summary(spark, sf):
    """AG-7: parents fetched incrementally vs in full, rows fetched."""
    wms = incremental.watermarks(_staged_campaign_table(spark, sf, even_only=True), "AdAccountID")
    return incremental.extract_summary(_campaign_records(spark, sf), wms, "_parent")


@register("fetch_since", """
    SELECT CAST(o_custkey AS VARCHAR) AS parent_id, CAST(epoch(max(o_orderdate) - INTERVAL 1 DAY) AS BIGINT) AS since_epoch
    FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY o_custkey""")
def q_fetch_since(spark, sf):
    """SC-13: per account the epoch second from which the next fetch asks for campaigns."""
    wms = incremental.watermarks(_staged_campaign_table(spark, sf, even_only=False), "AdAccountID")
    return incremental.fetch_since(wms, incremental.CAMPAIGN_BUFFER)


@register("date_chunks", """
    SELECT user_id, CAST(d AS DATE) AS chunk_since, least(CAST(d AS DATE) + 9, e) AS chunk_until
    FROM (SELECT user_id, min(CAST(ts AS DATE)) AS s, max(CAST(ts AS DATE)) AS e FROM events GROUP BY 1) r,
         unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 10 DAY)) AS g(d)""")
def q_date_chunks(spark, sf):
    """WN-2: each parent's active day range split into 10-day inclusive chunks (backfill plan)."""
    ranges = (A.table(spark, sf, "events").groupBy("user_id")
              .agg(F.min(F.to_date("ts")).alias("s"), F.max(F.to_date("ts")).alias("e")))
    return windows.date_chunks(ranges, "s", "e", 10)


@register("backfill_range", """
    SELECT l_partkey, CAST(l_shipdate AS DATE) AS day,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS spend
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1997-03-01'
    GROUP BY 1, 2""")
def q_backfill_range(spark, sf):
    """PL-2: one job over the whole half-open range (chunks are commit units only)."""
    since, until = windows.daily_window(BACKFILL_SINCE, BACKFILL_UNTIL)
    li = A.table(spark, sf, "lineitem").where(
        (F.col("l_shipdate") >= _ts(dt.datetime.combine(since, dt.time())))
        & (F.col("l_shipdate") < _ts(dt.datetime.combine(until, dt.time()))))
    return (li.groupBy("l_partkey", F.to_date("l_shipdate").alias("day"))
            .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("spend")))


# ---------------------------------------------------------------------------
# Joins and audits
# ---------------------------------------------------------------------------

def _open_orders(spark, sf) -> DataFrame:
    return A.table(spark, sf, "orders").where(F.col("o_orderstatus") != "P").select("o_orderkey")


@register("conform_semi", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def q_conform_semi(spark, sf):
    """JN-1 output side: children with a staged parent."""
    li = A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.conform_semi(li, "l_orderkey", _open_orders(spark, sf), "o_orderkey")


@register("conform_quarantine", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def q_conform_quarantine(spark, sf):
    """JN-1 skip side: children without a staged parent, kept as quarantine."""
    li = A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    q = joins.conform_quarantine(li, "l_orderkey", _open_orders(spark, sf), "o_orderkey")
    return q.select("l_orderkey", "l_linenumber", "l_partkey")


@register("lookup_match_wins", """
    SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN NULLIF(l.quality, 0) ELSE -1 END AS quality
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_lookup_match_wins(spark, sf):
    """JN-2: a match wins even when the parent's value is NULL."""
    docs = A.table(spark, sf, "documents").select("doc_id")
    lookup = A.table(spark, sf, "labels").select("doc_id", F.nullif("quality", F.lit(0)).alias("quality"))
    out = joins.lookup_match_wins(docs, "doc_id", lookup, "doc_id", {"quality": ("quality", F.lit(-1))})
    return out.select("doc_id", "quality")


def _mixed_keys(key: str) -> F.Column:
    return F.when(F.col(key) % 2 == 0, F.concat(F.lit("act_"), F.col(key).cast("string"))
                  ).otherwise(F.col(key).cast("string"))


def _children(spark, sf) -> DataFrame:
    """All orders; those of every third customer belong to an account that is not staged."""
    key = F.col("o_custkey").cast("bigint")
    return A.table(spark, sf, "orders").select(
        F.when(key % 3 == 0, key + 1_000_000_000_000).otherwise(key).alias("AdAccountID"))


@register("audit_anti_normalized", """
    SELECT 'act_' || c_custkey AS AccountID FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = TRY_CAST(replace('act_' || c_custkey, 'act_', '') AS BIGINT)
                      AND o_custkey % 3 <> 0)""")
def q_audit_anti_normalized(spark, sf):
    """JN-4: accounts without children, keys normalized and converted."""
    acc = A.table(spark, sf, "customer").select(
        F.concat(F.lit("act_"), F.col("c_custkey").cast("string")).alias("AccountID"))
    return audits.accounts_without_children(acc, "AccountID", _children(spark, sf), "AdAccountID")


@register("audit_anti_convertible", """
    SELECT k FROM (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'act_' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS k
                   FROM customer) t
    WHERE TRY_CAST(k AS BIGINT) IS NOT NULL AND NOT EXISTS (
      SELECT 1 FROM orders WHERE o_custkey = TRY_CAST(k AS BIGINT) AND o_custkey % 3 <> 0)""")
def q_audit_anti_convertible(spark, sf):
    """JN-5: anti join over convertible keys only."""
    keys = A.table(spark, sf, "customer").select(_mixed_keys("c_custkey").alias("k"))
    return audits.convertible_without_children(keys, "k", _children(spark, sf), "AdAccountID")


@register("audit_key_quality", """
    SELECT count(*) AS total_rows, count(DISTINCT k) AS distinct_ids,
           count(DISTINCT TRY_CAST(k AS BIGINT)) AS distinct_numeric
    FROM (SELECT CASE WHEN o_custkey % 2 = 0 THEN 'act_' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS k
          FROM orders) t""")
def q_audit_key_quality(spark, sf):
    """AG-2: row count, distinct ids, distinct convertible ids."""
    keys = A.table(spark, sf, "orders").select(_mixed_keys("o_custkey").alias("k"))
    return audits.key_quality(keys, "k")


@register("audit_except", """
    SELECT TRY_CAST(k AS BIGINT) AS id FROM (
      SELECT CASE WHEN c_custkey % 2 = 0 THEN 'act_' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS k
      FROM customer) t
    EXCEPT SELECT CASE WHEN o_custkey % 3 = 0 THEN CAST(o_custkey AS BIGINT) + 1000000000000 ELSE o_custkey END FROM orders""")
def q_audit_except(spark, sf):
    """ST-1: EXCEPT DISTINCT of converted ids (unconvertible -> one NULL row)."""
    keys = A.table(spark, sf, "customer").select(_mixed_keys("c_custkey").alias("k"))
    return audits.except_converted(keys, "k", _children(spark, sf), "AdAccountID")


@register("audit_null_fk", """
    SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL""")
def q_audit_null_fk(spark, sf):
    """FLT-9: rows whose looked-up foreign value IS NULL."""
    docs = A.table(spark, sf, "documents").select("doc_id")
    labels = A.table(spark, sf, "labels").select("doc_id", "quality")
    return audits.null_fk(docs.join(labels, "doc_id", "left"), "quality").select("doc_id")


@register("runlog_top", "SELECT event_id, event_type, ts FROM events ORDER BY event_id DESC LIMIT 30")
def q_runlog_top(spark, sf):
    """SL-3: TOP 30 by id descending."""
    ev = A.table(spark, sf, "events").select("event_id", "event_type", "ts")
    return audits.top_n(ev, "event_id", 30)


# ---------------------------------------------------------------------------
# Metrics and scalar rules
# ---------------------------------------------------------------------------

_ACTIONS_SCHEMA = T.ArrayType(T.StructType([T.StructField("action_type", T.StringType()),
                                            T.StructField("value", T.StringType())]))


@register("action_sum", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity + l_linenumber AS DOUBLE) END AS leads
    FROM lineitem""")
def q_action_sum(spark, sf):
    """AG-3: in-row conditional sum over parsed action arrays."""
    li = A.table(spark, sf, "lineitem")
    parsed = li.select("l_orderkey", "l_linenumber", "l_partkey",
                       F.from_json(_actions_text(), _ACTIONS_SCHEMA).alias("actions"))
    return parsed.select("l_orderkey", "l_linenumber", "l_partkey",
                         action_sum("actions", entities.LEAD_ACTION_TYPES).alias("leads"))


@register("leaf_sum", "SELECT doc_id, CAST(n_chars % 10 + n_chars % 3 AS DOUBLE) AS total FROM documents")
def q_leaf_sum(spark, sf):
    """AG-4: numeric leaves summed; nested rows take the Arrow path."""
    d, n = F.col("doc_id"), F.col("n_chars")
    nested = A.rec(like=n % 10, x=F.array(F.struct((n % 3).alias("love"))))
    flat = A.rec(like=n % 10, love=n % 3)
    docs = A.table(spark, sf, "documents").select("doc_id", F.when(d % 2 == 1, nested).otherwise(flat).alias("v"))
    return docs.select("doc_id", leaf_sum("v").alias("total"))


@register("find_metric", """
    SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST(doc_id % 7 AS DOUBLE) END AS shares FROM documents""")
def q_find_metric(spark, sf):
    """SC-9: first numeric value under share/shares, any depth."""
    d = F.col("doc_id")
    text = (F.when(d % 4 == 0, A.rec(comment=F.lit(1)))
            .when(d % 2 == 1, A.rec(x=F.struct((d % 7).alias("share"))))
            .otherwise(A.rec(comment=F.lit(1), share=d % 7)))
    docs = A.table(spark, sf, "documents").select("doc_id", text.alias("v"))
    return docs.select("doc_id", find_metric("v", entities.SHARE_KEYS).alias("shares"))


@register("sc_bare_id", "SELECT c_custkey, regexp_replace('act_' || c_custkey || 'act_9', '^act_', '') AS bare_id FROM customer")
def q_sc_bare_id(spark, sf):
    """SC-1: strip one leading act_."""
    c = A.table(spark, sf, "customer").select("c_custkey")
    raw = F.concat(F.lit("act_"), F.col("c_custkey").cast("string"), F.lit("act_9"))
    return c.select("c_custkey", C.bare_account_id(raw).alias("bare_id"))


@register("sc_datetime", """
    SELECT event_id, CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) - INTERVAL 3 HOUR
                          ELSE date_trunc('second', ts) END AS dt FROM events""")
def q_sc_datetime(spark, sf):
    """SC-2: offsets converted to naive UTC; all-digit text is epoch seconds."""
    ev = A.table(spark, sf, "events")
    sec = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    e = F.col("event_id")
    text = (F.when(e % 2 == 0, F.concat(sec, F.lit("+0300")))
            .when(e % 3 == 0, F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
            .otherwise(F.concat(sec, F.lit("+0000"))))
    return ev.select("event_id", C.as_datetime(text).alias("dt"))


@register("sc_int", """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INT) END AS k
    FROM events""")
def q_sc_int(spark, sf):
    """SC-3: int(text); '3.7', '' and junk give NULL."""
    ev = A.table(spark, sf, "events")
    e = F.col("event_id")
    bad = F.when(e % 9 == 0, F.lit("3.7")).when(e % 9 == 3, F.lit("")).otherwise(F.lit("x"))
    text = F.when(e % 3 == 0, bad).otherwise(F.get_json_object("props", "$.k"))
    return ev.select("event_id", C.as_int(text).alias("k"))


@register("sc_number", "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v FROM events")
def q_sc_number(spark, sf):
    """SC-4/SC-5/SC-12: float(text); nan, '12d', junk and objects give NULL."""
    ev = A.table(spark, sf, "events")
    e = F.col("event_id")
    junk = (F.when(e % 4 == 0, F.lit("nan")).when(e % 4 == 1, F.lit("12d"))
            .when(e % 4 == 2, F.lit("x")).otherwise(F.lit('{"a":1}')))
    text = F.when(F.col("event_type") == "error", junk).otherwise(F.col("value").cast("string"))
    return ev.select("event_id", C.as_number(text).alias("v"))


@register("sc_json_text", """
    SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE '["' || p_brand || '"]' END AS j FROM part""")
def q_sc_json_text(spark, sf):
    """SC-6: JSON text of a nested field; '', [], {} and null give NULL."""
    p = A.table(spark, sf, "part")
    k = F.col("p_partkey")
    empty = (F.when(k % 4 == 0, F.lit('{"cats":[]}')).when(k % 4 == 1, F.lit('{"cats":{}}'))
             .when(k % 4 == 2, F.lit('{"cats":""}')).otherwise(F.lit('{"cats":null}')))
    text = F.when(F.col("p_size") % 5 == 0, empty).otherwise(A.rec(cats=F.array(F.col("p_brand"))))
    schema = T.StructType([T.StructField("cats", T.StringType())])
    return p.select("p_partkey", C.as_json_text(F.from_json(text, schema)["cats"]).alias("j"))


@register("sc_date", "SELECT event_id, CAST(ts - INTERVAL 3 HOUR AS DATE) AS d FROM events")
def q_sc_date(spark, sf):
    """SC-7: parse with offset -> UTC -> date."""
    ev = A.table(spark, sf, "events")
    text = F.concat(F.date_format("ts", A.TS_FMT), F.lit("+0300"))
    return ev.select("event_id", C.as_date(text).alias("d"))


@register("sc_date_key", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_key FROM orders")
def q_sc_date_key(spark, sf):
    """SC-8: date -> yyyymmdd int."""
    o = A.table(spark, sf, "orders")
    return o.select("o_orderkey", C.date_key(F.to_date("o_orderdate")).alias("date_key"))


@register("sc_truthy_or", """
    SELECT s_suppkey, COALESCE(NULLIF(CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE CAST(s_nationkey AS VARCHAR) END, ''),
                               'fallback') AS v FROM supplier""")
def q_sc_truthy_or(spark, sf):
    """SC-10: `a or b` where '' counts as missing."""
    s = A.table(spark, sf, "supplier")
    a = F.when(F.col("s_suppkey") % 2 == 0, F.lit("")).otherwise(F.col("s_nationkey").cast("string"))
    return s.select("s_suppkey", C.truthy_or(a, F.lit("fallback")).alias("v"))


# ---------------------------------------------------------------------------
# Dedup, selection
# ---------------------------------------------------------------------------

@register("dedup_first", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey,
        l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
      FROM lineitem) t WHERE rn = 1""")
def q_dedup_first(spark, sf):
    """DD-1: keep-first per key in a total arrival order."""
    li = A.table(spark, sf, "lineitem")
    out = dedup.dedup_first(li, ["l_orderkey", "l_linenumber"], _LI_ORDER)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@register("dedup_last", """
    SELECT user_id, event_type, event_id FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS rn FROM events) t
    WHERE rn = 1""")
def q_dedup_last(spark, sf):
    """DD-2: last-wins per key."""
    ev = A.table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts")
    return dedup.dedup_last(ev, ["user_id", "event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "event_id")


def _orders_as_posts(spark, sf) -> DataFrame:
    return A.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("PostID"), F.col("o_custkey").alias("PageID"),
        F.col("o_orderdate").alias("CreatedTime"))


@register("recent_posts_topk", """
    SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01'
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 1000""")
def q_recent_posts_topk(spark, sf):
    """FLT-6 + SL-1: the newest 1000 posts created by midnight of `until`."""
    top = selection.post_parents(_orders_as_posts(spark, sf), POSTS_UNTIL, "recent", 1000)
    return top.select(F.col("PostID").alias("o_orderkey"), F.col("CreatedTime").alias("o_orderdate"))


@register("all_posts", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL")
def q_all_posts(spark, sf):
    """SL-2 / PL-3 parent selection: every post with both ids, no sort."""
    out = selection.post_parents(_orders_as_posts(spark, sf), POSTS_UNTIL, "all")
    return out.select(F.col("PostID").alias("o_orderkey"), F.col("PageID").alias("o_custkey"))


# ---------------------------------------------------------------------------
# Loads
# ---------------------------------------------------------------------------

def _orders_target_batch(spark, sf):
    o = A.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderdate")
    target = o.where(F.col("o_orderdate") < _ts(STAGED_BEFORE)).drop("o_orderdate")
    batch = (o.where(F.col("o_orderdate") >= _ts(BATCH_FROM))
             .withColumn("status", F.lit("NEW")).drop("o_orderdate"))
    return target, batch


@register("upsert", """
    SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-07-01' THEN 'NEW' ELSE o_orderstatus END AS status,
           CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders""")
def q_upsert(spark, sf):
    """SNK-1: matched keys overwritten, new keys inserted, nothing deleted."""
    target, batch = _orders_target_batch(spark, sf)
    return loads.upsert(target, batch, ["o_orderkey"])


@register("upsert_metrics", """
    SELECT count(*) AS rows_received, count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1999-01-01') AS inserted,
           count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1999-01-01') AS updated
    FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01'""")
def q_upsert_metrics(spark, sf):
    """AG-6: rows received / inserted / updated by an upsert."""
    target, batch = _orders_target_batch(spark, sf)
    return loads.upsert_metrics(target, batch, ["o_orderkey"])


@register("upsert_partial", """
    SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS segment, c_name FROM customer""")
def q_upsert_partial(spark, sf):
    """SNK-1 with a narrower batch: NULL overwrites, absent columns are carried."""
    c = A.table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), "c_name")
    batch = c.where(F.col("c_custkey") % 3 == 0).select("c_custkey", F.lit(None).cast("string").alias("segment"))
    return loads.upsert(c, batch, ["c_custkey"])


@register("insert_only", """
    SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS first_ts FROM events GROUP BY 1, 2""")
def q_insert_only(spark, sf):
    """SNK-3: insert-only snapshot, existing keys kept (on_conflict='ignore')."""
    daily = (A.table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day"))
             .agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")))
    early = F.col("day") < F.lit(INSERT_SPLIT)
    target = daily.where(early).select("user_id", "day", F.col("lo").alias("first_ts"))
    batch = daily.select("user_id", "day", F.when(early, F.col("hi")).otherwise(F.col("lo")).alias("first_ts"))
    return loads.insert_only(target, batch, ["user_id", "day"], on_conflict="ignore")


@register("replace_window", """
    SELECT event_id, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-10' AND CAST(ts AS DATE) < DATE '2024-01-20'
                          THEN value + 1 ELSE value END AS value
    FROM events WHERE NOT (CAST(ts AS DATE) >= DATE '2024-01-10' AND CAST(ts AS DATE) < DATE '2024-01-20'
                           AND event_type = 'error')""")
def q_replace_window(spark, sf):
    """SNK-4: window rows replaced by the batch; days outside untouched."""
    ev = A.table(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"), "event_type", "value")
    batch = (windows.filter_window(ev, "day", WINDOW_SINCE, WINDOW_UNTIL)
             .where(F.col("event_type") != "error").withColumn("value", F.col("value") + 1))
    out = loads.replace_window(ev, batch, ["event_id"], "day", WINDOW_SINCE, WINDOW_UNTIL, force=True)
    return out.select("event_id", "value")


_DOC_SPEC = TableSpec("Document", T.StructType([T.StructField("doc_id", T.LongType()),
                                                T.StructField("text", T.StringType())]),
                      ("doc_id",), "upsert", text_limits={"text": 1000})


@register("integrity_rejects", "SELECT doc_id, 'text_too_long' AS reason FROM documents WHERE n_chars > 1000")
def q_integrity_rejects(spark, sf):
    """SNK-6: rows failing a constraint go to rejects with a reason."""
    docs = A.table(spark, sf, "documents").select("doc_id", "text")
    _, rejects = loads.split_integrity(docs, _DOC_SPEC)
    return rejects.select("doc_id", "reason")




# ---------------------------------------------------------------------------
# Pipelines (rows-only: they write a staging store and return its run log)
# ---------------------------------------------------------------------------

PIPELINE_RUN_DATE = dt.date(2024, 1, 20)


def _account_adset_pages(li: DataFrame, orders: DataFrame) -> DataFrame:
    """A line item as an ad set in the pages of its order's account: by order, then as in ``_lineitem_page_no``.
    Orders are numbered by their counts; a line item moves once, to its order, and finds its place there."""
    li = li.select("l_orderkey", "l_linenumber", *_LI_ORDER).where(F.col("l_linenumber").isNotNull())
    account = F.concat(F.lit("act_"), F.col("o_custkey").cast("string"))
    # an order that comes several times has its line items as often
    owner = orders.groupBy(F.col("o_orderkey").alias("l_orderkey"), account.alias("_account")).agg(F.count(F.lit(1)).alias("_copies"))
    sizes = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_items"))
    owner = owner.join(sizes, "l_orderkey").withColumn("_units", F.col("_copies") * F.col("_items")).drop("_items")
    owner = A.with_ordinal(owner, ["_account"], ["l_orderkey"], F.floor(F.col("l_orderkey") / F.lit(1 << 16)), "_first", weight="_units")
    place = F.row_number().over(Window.partitionBy("l_orderkey", "_account").orderBy("l_linenumber", *_LI_ORDER))
    li = li.join(owner.drop("_units"), "l_orderkey").withColumn("_place", place)
    li = li.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    return A.landing(li, "adset", F.col("_account"), F.col("_first") - 1 + (F.col("_place") - 1) * F.col("_copies") + F.col("_copy"), [_adset_record()])


def _daily_ad_insight_pages(li: DataFrame) -> DataFrame:
    """A line item as a day's insight of an ad (its part), in pages of an account (its supplier); days fall in January 2024."""
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), F.pmod(F.datediff(F.col("l_shipdate"), F.lit(dt.date(1992, 1, 1))), F.lit(31)).cast("int"))
    li = li.select("l_suppkey", "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", day.alias("_day"))
    # equal rows count once; rows of an account in the order of their values
    li = li.groupBy("l_suppkey", "l_partkey", "_day").agg(F.sum("l_extendedprice").alias("spend"), F.sum("l_quantity").alias("seen"),
                                                          F.min("l_orderkey").alias("first"))
    record = A.rec(ad_id=F.concat(F.col("l_partkey").cast("string"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0")),
                   account_id=F.concat(F.lit("act_"), F.col("l_suppkey").cast("string")), date_start=F.date_format("_day", "yyyy-MM-dd"),
                   spend=F.round("spend", 2).cast("decimal(18,2)"), impressions=F.col("seen").cast("long"))
    page_no = F.shiftleft(F.col("l_partkey").cast("long"), 6) + F.dayofmonth("_day")
    # numbered by the columns that the record is made of: nothing else moves
    li = A.with_ordinal(li, ["l_suppkey"], ["l_partkey", "_day"], F.floor(page_no / F.lit(1 << 16)))
    return A.landing(li, "ad_insight", F.concat(F.lit("act_"), F.col("l_suppkey").cast("string")), F.col("_ord") - 1, [record])


def landing_parts(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Every entity's landed pages, derived from the test tables; those that shuffle most come first."""
    t = lambda name: A.table(spark, sf, name, spread_input=False)  # noqa: E731  numbering the pages spreads them
    ev, docs = t("events"), A.table(spark, sf, "documents")
    sup = t("supplier")
    page_rec = A.rec(id=F.col("s_suppkey").cast("string"), name=F.col("s_name"),
                     business=F.struct(F.col("s_nationkey").cast("string").alias("id")))
    post_rec = A.rec(id=F.concat_ws("_", "source", F.col("doc_id").cast("string")),
                     created_time=A.iso_utc(_ts(dt.datetime(2024, 1, 1)) + F.make_dt_interval(mins=F.col("doc_id"))),
                     status_type=F.col("lang"))
    ad_rec = A.rec(id=F.col("event_id").cast("string"), campaign_id=F.col("user_id").cast("string"),
                   adset_id=(F.col("event_id") * 10 + 1).cast("string"),
                   creative=F.struct((F.col("event_id") % 50).cast("string").alias("id"),
                                     F.concat(F.lit("creative-"), (F.col("event_id") % 50).cast("string")).alias("name")),
                   updated_time=A.iso_utc("ts"))
    return [
        _account_adset_pages(t("lineitem"), t("orders")),
        _daily_ad_insight_pages(t("lineitem")),
        _customer_pages(spark, sf, renumber=True),
        # the fetch of every fiftieth account's campaigns did not end
        _campaign_pages(t("orders"), renumber=True, next_link=F.when(F.col("o_custkey") % 50 == 49, "/more")),
        A.landing(ev, "ad", F.concat(F.lit("act_"), F.col("user_id").cast("string")), F.col("event_id"), [ad_rec],
                  renumber=True),
        A.landing(sup, "page", F.col("s_nationkey"), F.col("s_suppkey"), [page_rec], renumber=True),
        A.landing(docs, "post", F.col("doc_id") % 100, F.col("doc_id"), [post_rec], renumber=True),
        _page_insight_pages(ev, renumber=True),
        _post_insight_pages(docs),  # one page per post, already page 0: nothing to renumber
    ]


def landing_from_tables(spark: SparkSession, sf: str) -> DataFrame:
    """``landing_parts`` in one."""
    return reduce(DataFrame.unionByName, landing_parts(spark, sf))


def _land(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    """Landed ``parts``, written one by one: the shuffles of one are gone before the next begins."""
    from tidewater.sources.store import CODEC
    land_path = _scratch(spark, "landing")
    with shuffles_end_with_query(spark):
        for part in parts:
            part.write.mode("append").partitionBy("entity").option("compression", CODEC).parquet(land_path)
    return spark.read.parquet(land_path)


def _scratch(spark: SparkSession, what: str) -> str:
    import uuid

    from tidewater.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex[:8]}"


def _exact_sum(c: F.Column) -> F.Column:
    """A sum of whole numbers or decimals in 38 digits, as the oracle's: a bigint sum of ad ids ends in an overflow once a day has some millions of ads."""
    return F.sum(c.cast("decimal(28,6)")).cast("decimal(38,6)")


#: per step: the table it fills, a key column and a value column that are summed
_STEP_TABLES = {
    "dimension_business": ("Business", "BusinessID", "length(BusinessName)"),
    "dimension_ad_account": ("AdAccount", "length(AccountID)", "Balance"),
    "dimension_campaign": ("Campaign", "CampaignID", "DailyBudget"),
    "dimension_adset": ("AdSet", "AdSetID", "TargetingAgeMin"),
    "dimension_ad_and_creative": ("Ad", "AdID", "CampaignID"),
    "dimension_page": ("Page", "PageID", "BusinessID"),
    "dimension_post": ("Post", "PageID", "length(PostID)"),
    "fact_ad_insights_daily": ("AdInsightsDaily", "AdID", "Spend"),
    "fact_page_insights_daily": ("PageInsightsDaily", "PageID", "Value"),
    "fact_post_insights_daily": ("PostInsightsDaily", "length(PostID)", "Reactions"),
}
#: what each table must hold after the daily run, and the parents that the run must leave out
_STEP_ORACLE = {
    "Business": "SELECT DISTINCT n_nationkey AS BusinessID, n_name AS BusinessName FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "AdAccount": "SELECT 'act_' || c_custkey AS AccountID, CAST(c_acctbal AS DECIMAL(18,2)) AS Balance FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "Campaign": """SELECT o_orderkey AS CampaignID, CAST(o_totalprice AS DECIMAL(18,2)) AS DailyBudget FROM orders
        WHERE o_custkey % 50 <> 49 AND o_custkey IN (SELECT c_custkey FROM customer)""",
    "AdSet": """SELECT l_orderkey * 10 + l_linenumber AS AdSetID, l_orderkey AS CampaignID, CAST(l_quantity AS INT) AS TargetingAgeMin
        FROM lineitem JOIN Campaign ON l_orderkey = CampaignID
        QUALIFY row_number() OVER (PARTITION BY l_orderkey * 10 + l_linenumber ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
          l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
    "Ad": """SELECT event_id AS AdID, coalesce(CampaignID, user_id) AS CampaignID FROM events LEFT JOIN AdSet ON AdSetID = event_id * 10 + 1
        WHERE user_id IN (SELECT c_custkey FROM customer)""",
    "Page": "SELECT s_suppkey AS PageID, s_nationkey AS BusinessID FROM supplier",
    "Post": "SELECT doc_id % 100 AS PageID, source || '_' || doc_id AS PostID, doc_id, n_chars FROM documents WHERE doc_id % 100 IN (SELECT s_suppkey FROM supplier)",
    "AdInsightsDaily": """SELECT CAST(l_partkey || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS BIGINT) AS AdID, CAST(round(sum(l_extendedprice), 2) AS DECIMAL(18,2)) AS Spend
        FROM lineitem WHERE l_suppkey IN (SELECT c_custkey FROM customer)
        AND date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) % 31 + 1 BETWEEN 10 AND 19
        GROUP BY l_partkey, l_suppkey, date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) % 31""",
    "PageInsightsDaily": """SELECT user_id AS PageID, CAST(value AS DECIMAL(18,6)) AS Value FROM events
        WHERE CAST(ts AS DATE) >= DATE '2024-01-10' AND CAST(ts AS DATE) < DATE '2024-01-20' AND user_id IN (SELECT s_suppkey FROM supplier)
        QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), event_type ORDER BY ts) = 1""",
    "PostInsightsDaily": """SELECT PostID, CASE WHEN doc_id % 3 = 0 THEN n_chars ELSE n_chars % 10 + n_chars % 3 END AS Reactions FROM Post""",
}
_STEP_SKIPPED = {"Campaign": "(SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey % 50 = 49)"}


def _daily_oracle() -> str:
    tables = ", ".join(f"{t} AS ({sql})" for t, sql in _STEP_ORACLE.items())
    rows = " UNION ALL ".join(
        f"""SELECT '{step}' AS FunctionName, 'succeeded' AS Status, count(*) AS RowsReceived, count(*) AS RowsWritten, count(*) AS RowsInserted,
        CAST(0 AS BIGINT) AS RowsUpdated, CAST(0 AS BIGINT) AS RowsRejected, CAST({_STEP_SKIPPED.get(t, '0')} AS BIGINT) AS RowsSkipped,
        CAST(0 AS INTEGER) AS ErrorCount, count(*) AS TableRows, CAST(sum({key}) AS DECIMAL(38,6)) AS KeySum, CAST(sum({value}) AS DECIMAL(38,6)) AS ValueSum FROM {t}"""
        for step, (t, key, value) in _STEP_TABLES.items())
    return f"WITH {tables} {rows}"


@register("daily_staging", _daily_oracle())
def q_daily_staging(spark, sf):
    """PL-1/PL-4: land every entity, run the daily staging (7 dimensions, 3 facts) over ten days; the run log with each table's content in sums."""
    from tidewater.plans.pipeline import RunContext, run_staging
    from tidewater.sources.store import StagingStore
    landing = _land(spark, landing_parts(spark, sf))
    store = StagingStore(spark, _scratch(spark, "staging"))
    ctx = RunContext(spark=spark, landing=landing, store=store, run_date=PIPELINE_RUN_DATE,
                     load_ts=dt.datetime(2024, 1, 20, 6), full_refresh=False,
                     since=WINDOW_SINCE, until=WINDOW_UNTIL, post_mode="all")
    run_staging(ctx)
    content = None
    for step, (table, key, value) in _STEP_TABLES.items():
        sums = store.read(table).agg(F.count(F.lit(1)).alias("TableRows"), *[
            _exact_sum(F.expr(c)).alias(name) for c, name in ((key, "KeySum"), (value, "ValueSum"))])
        sums = sums.withColumn("FunctionName", F.lit(step))
        content = sums if content is None else content.unionByName(sums)
    log = store.run_log().select("FunctionName", "Status", "RowsReceived", "RowsWritten", "RowsInserted", "RowsUpdated", "RowsRejected", "RowsSkipped",
                                 "ErrorCount")
    return log.join(content, "FunctionName")


def _job(spark, sf: str, parts: list[DataFrame], **options):
    """A context over landed ``parts`` and an empty store."""
    from tidewater.plans.pipeline import RunContext
    from tidewater.sources.store import StagingStore
    return RunContext(spark=spark, landing=_land(spark, parts), store=StagingStore(spark, _scratch(spark, "staging")),
                      run_date=PIPELINE_RUN_DATE, load_ts=dt.datetime(2024, 1, 20, 6), **options)


def _supplier_pages(spark, sf) -> DataFrame:
    record = A.rec(id=F.col("s_suppkey").cast("string"), name=F.col("s_name"))
    return A.landing(A.table(spark, sf, "supplier"), "page", F.lit("999"), F.col("s_suppkey"), [record], renumber=True)


@register("backfill_tables", f"""
    WITH Account AS (SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey),
    ad AS (SELECT CAST(l_partkey || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS BIGINT) AS k,
             20240101 + date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) % 31 AS DateKey, CAST(round(sum(l_extendedprice), 2) AS DECIMAL(18,2)) AS v
           FROM lineitem WHERE l_suppkey IN (SELECT c_custkey FROM Account) GROUP BY l_partkey, l_suppkey, date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) % 31),
    page AS (SELECT user_id AS k, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS DateKey, CAST(value AS DECIMAL(18,6)) AS v FROM events
           WHERE user_id IN (SELECT s_suppkey FROM supplier) QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), event_type ORDER BY ts) = 1)
    SELECT t AS TableName, CAST(DateKey AS INTEGER) AS DateKey, count(*) AS TableRows, CAST(sum(k) AS DECIMAL(38,6)) AS KeySum, CAST(sum(v) AS DECIMAL(38,6)) AS ValueSum
    FROM (SELECT 'AdInsightsDaily' AS t, k, DateKey, CAST(v AS DECIMAL(38,6)) AS v FROM ad UNION ALL SELECT 'PageInsightsDaily', k, DateKey, CAST(v AS DECIMAL(38,6)) FROM page) x
    WHERE DateKey >= 20240103 AND DateKey < 20240130 GROUP BY 1, 2""")
def q_backfill_tables(spark, sf):
    """PL-2 with SRC-2/SRC-4: backfill of both facts over 27 days in chunks of seven, from one parse of each landing; the tables by day."""
    from tidewater.plans.pipeline import run_backfill, run_steps, step_ad_account, step_page
    ctx = _job(spark, sf, [_customer_pages(spark, sf, renumber=True), _supplier_pages(spark, sf),
                           _daily_ad_insight_pages(A.table(spark, sf, "lineitem", spread_input=False)),
                           _page_insight_pages(A.table(spark, sf, "events", spread_input=False), renumber=True)])
    run_steps(ctx, [("dimension_ad_account", step_ad_account), ("dimension_page", step_page)])
    run_backfill(ctx, dt.date(2024, 1, 3), dt.date(2024, 1, 30), chunk_days=7)
    out = None
    for table, key, value in (("AdInsightsDaily", "AdID", "Spend"), ("PageInsightsDaily", "PageID", "Value")):
        days = ctx.store.read(table).groupBy("DateKey").agg(F.count(F.lit(1)).alias("TableRows"), *[
            _exact_sum(F.col(c)).alias(name) for c, name in ((key, "KeySum"), (value, "ValueSum"))])
        days = days.select(F.lit(table).alias("TableName"), "DateKey", "TableRows", "KeySum", "ValueSum")
        out = days if out is None else out.unionByName(days)
    return out


def _post_pages(docs: DataFrame) -> DataFrame:
    created = _ts(dt.datetime(2024, 1, 1)) + F.make_dt_interval(mins=F.col("doc_id"))
    record = A.rec(id=F.concat_ws("_", "source", F.col("doc_id").cast("string")), created_time=A.iso_utc(created), status_type=F.col("lang"))
    return A.landing(docs, "post", F.col("doc_id") % 100, F.col("doc_id"), [record], renumber=True)


def _snapshot(spark, sf):
    """Pages, posts and a snapshot of all posts whose page has a credential (two of three); campaigns of which some fetches did not end."""
    from tidewater.plans.pipeline import run_post_snapshot, run_steps, step_campaign, step_page, step_post
    docs = A.table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars")
    sup = A.table(spark, sf, "supplier")
    bad = sup.where("s_suppkey % 10 = 9").select(F.lit("campaign").alias("entity"), F.concat(F.lit("bad_"), F.col("s_suppkey").cast("string")).alias("parent_id"),
                                                 F.lit(0).cast("long").alias("page_no"), F.lit('{"data":{"error":1}}').alias("body"))
    campaigns = _campaign_pages(A.table(spark, sf, "orders"), renumber=True, next_link=F.when(F.col("o_custkey") % 50 == 49, "/more"))
    ctx = _job(spark, sf, [_supplier_pages(spark, sf), _post_pages(docs), _post_insight_pages(docs), campaigns, bad], since=dt.date(2024, 2, 14),
               until=POST_SNAPSHOT, full_refresh=True, page_availability=sup.select(F.col("s_suppkey").alias("PageID"), (F.col("s_suppkey") % 3 != 0).alias("available")))
    run_steps(ctx, [("dimension_page", step_page), ("dimension_post", step_post), ("dimension_campaign", step_campaign)])
    run_post_snapshot(ctx)
    return ctx.store


@register("post_snapshot", """
    SELECT source || '_' || doc_id AS PostID, 20240215 AS DateKey,
           CASE WHEN doc_id % 4 = 0 THEN NULL ELSE doc_id % 7 END AS Shares,
           CASE WHEN doc_id % 3 = 0 THEN n_chars ELSE n_chars % 10 + n_chars % 3 END AS Reactions,
           doc_id % 5 AS Comments
    FROM documents WHERE doc_id % 100 IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0)""")
def q_post_snapshot(spark, sf):
    """PL-3 + SRC-6: one snapshot over all posts of the pages that have a credential."""
    return _snapshot(spark, sf).read("PostInsightsDaily").select("PostID", "DateKey", "Shares", "Reactions", "Comments")


@register("skipped_parents", """
    SELECT 'campaign' AS Entity, 'act_' || o_custkey AS ParentID, 'not_finished' AS Reason FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 50 = 49) o
    UNION ALL SELECT 'campaign', 'bad_' || s_suppkey, 'data_not_a_list' FROM supplier WHERE s_suppkey % 10 = 9
    UNION ALL SELECT 'post_insight', source || '_' || doc_id, 'no_credential' FROM documents
      WHERE doc_id % 100 NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0)""")
def q_skipped_parents(spark, sf):
    """SRC-1 + SRC-5 + SRC-6: parents that the runs left out, with the reason: bad pages, unfinished fetches, no credential."""
    from tidewater.plans.pipeline import SKIPPED
    return _snapshot(spark, sf).read(SKIPPED.name, SKIPPED).select("Entity", "ParentID", "Reason")


@register("extract_runs", """
    WITH first AS (SELECT o_custkey, count(*) AS n, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders
                   WHERE o_orderdate < TIMESTAMP '1996-01-01' AND o_custkey % 2 = 0 GROUP BY 1),
    second AS (SELECT o.o_custkey, count(*) AS n, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders o LEFT JOIN first f ON o.o_custkey = f.o_custkey
               WHERE f.hi IS NULL OR o.o_orderdate > f.hi - INTERVAL 1 DAY GROUP BY 1)
    SELECT 'campaign' AS Entity, CAST(s.o_custkey AS VARCHAR) AS ParentID, CASE WHEN f.n IS NULL THEN 1 ELSE 2 END AS Runs,
           CASE WHEN f.n IS NULL THEN 0 ELSE 1 END AS IncrementalRuns, CAST(coalesce(f.n, 0) + s.n AS BIGINT) AS RowsFetched,
           least(coalesce(f.lo, s.lo), s.lo) AS FirstTime, greatest(coalesce(f.hi, s.hi), s.hi) AS LastTime
    FROM second s LEFT JOIN first f ON s.o_custkey = f.o_custkey""")
def q_extract_runs(spark, sf):
    """AG-7 over two runs: old campaigns of every other account in full, then all of them, incrementally where the account is known."""
    from dataclasses import replace

    from tidewater.plans.pipeline import SUMMARIES, run_steps, step_campaign
    orders = A.table(spark, sf, "orders")
    old = orders.where((F.col("o_orderdate") < _ts(dt.datetime(1996, 1, 1))) & (F.col("o_custkey") % 2 == 0))
    ctx = _job(spark, sf, [_campaign_pages(old, renumber=True)], run_id="1")
    land_path = _scratch(spark, "landing")
    _campaign_pages(orders, renumber=True).write.partitionBy("entity").parquet(land_path)
    for run in (ctx, replace(ctx, landing=spark.read.parquet(land_path), run_id="2")):
        run_steps(run, [("dimension_campaign", step_campaign)])
    return incremental.merge_summaries(ctx.store.read(SUMMARIES.name, SUMMARIES))


@register("empty_table", "SELECT o_orderkey, CAST(NULL AS VARCHAR) AS CampaignName FROM orders")
def q_empty_table(spark, sf):
    """SNK-5: a table that was never written reads as empty with its schema, so every order is a campaign yet to stage."""
    from tidewater.sources.store import StagingStore
    staged = StagingStore(spark, _scratch(spark, "staging")).read("Campaign")
    orders = A.table(spark, sf, "orders").select("o_orderkey")
    return orders.join(staged, F.col("o_orderkey") == F.col("CampaignID"), "left").where(F.col("CampaignID").isNull()).select("o_orderkey", "CampaignName")


@register("landing_stream", """
    SELECT o_orderkey AS CampaignID, CAST(o_custkey AS VARCHAR) AS AdAccountID, CAST(NULL AS VARCHAR) AS CampaignName,
           o_orderpriority AS Objective, CAST(NULL AS VARCHAR) AS BuyingType, o_orderstatus AS Status,
           CAST(NULL AS VARCHAR) AS ConfiguredStatus, CAST(NULL AS VARCHAR) AS EffectiveStatus,
           CAST(o_totalprice AS DECIMAL(18,2)) AS DailyBudget, CAST(NULL AS DECIMAL(18,2)) AS LifetimeBudget,
           CAST(NULL AS DECIMAL(18,2)) AS BudgetRemaining, CAST(NULL AS DECIMAL(18,2)) AS SpendCap,
           CAST(NULL AS VARCHAR) AS SpecialAdCategories, CAST(NULL AS VARCHAR) AS SpecialAdCategoryCountry,
           CAST(NULL AS BOOLEAN) AS IsBudgetScheduleEnabled, CAST(NULL AS BOOLEAN) AS IsAdSetBudgetSharingEnabled,
           CAST(NULL AS VARCHAR) AS DestinationType, CAST(NULL AS BOOLEAN) AS IsDynamicCreative,
           CAST(NULL AS VARCHAR) AS PacingType, CAST(NULL AS VARCHAR) AS AttributionSpec,
           CAST(NULL AS BIGINT) AS PromotedObjectPageID, CAST(NULL AS BIGINT) AS PromotedObjectPixelID,
           CAST(NULL AS BIGINT) AS PromotedObjectAppID, CAST(NULL AS TIMESTAMP) AS StartTime,
           CAST(NULL AS TIMESTAMP) AS StopTime, CAST(NULL AS TIMESTAMP) AS CreatedTime, o_orderdate AS UpdatedTime,
           TIMESTAMP '2024-01-20 06:00:00' AS LoadDate
    FROM orders""")
def q_landing_stream(spark, sf):
    """Structured Streaming: campaign pages consumed with availableNow + foreachBatch -> Campaign table."""
    from tidewater.plans.pipeline import DIMENSION_STEPS
    from tidewater.sources.store import StagingStore
    from tidewater.streaming.landing_stream import start_landing_stream
    land_path = _scratch(spark, "landing")
    _campaign_pages(A.table(spark, sf, "orders"), renumber=True).write.parquet(land_path)
    store = StagingStore(spark, _scratch(spark, "staging"))
    steps = [s for s in DIMENSION_STEPS if s[0] == "dimension_campaign"]
    q = start_landing_stream(spark, land_path, store, _scratch(spark, "stream-ckpt"),
                             PIPELINE_RUN_DATE, dt.datetime(2024, 1, 20, 6), steps=steps)
    q.awaitTermination()
    return store.read("Campaign")


#: these run jobs while they are built, so their plans say little
ROWS_ONLY = ("daily_staging", "landing_stream", "backfill_tables", "post_snapshot", "skipped_parents", "extract_runs")

# the projections with every column; they register themselves with the function above
from tidewater.plans import column_queries  # noqa: E402, F401
