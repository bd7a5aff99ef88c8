"""Projections with every column filled: one query per entity over a whole table.

Each field names its staging column, its place in the API record, its kind and an
SQL expression of the source table (text that Spark and DuckDB both read). The
record is built from it, the oracle casts the same expression to the column's
type. Optional fields are absent in some records.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.plans import entities
from tidewater.plans.queries import register
from tidewater.schemas import RAW_ACCOUNT, RAW_AD, RAW_AD_INSIGHT, RAW_ADSET, RAW_CAMPAIGN, RAW_PAGE, RAW_POST, TABLES
from tidewater.sources import adapters as A
from tidewater.sources import landing as L


class Field(NamedTuple):
    column: str
    path: str               # place in the record; empty: not in the record (it comes from the parent tag or another field)
    kind: str
    value: str              # SQL of the value
    record: str = ""        # Spark SQL of what the record holds, where it is not the value itself


#: per kind the value in the record (Spark) and in the table (DuckDB)
_RAW = {"bool": "{}", "json": "{}", "ts": "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss\") || '+0000'", "date": "date_format({}, 'yyyy-MM-dd')"}
_STORED = {"text": "CAST({} AS VARCHAR)", "long": "CAST({} AS BIGINT)", "int": "CAST({} AS INTEGER)", "money": "CAST({} AS DECIMAL(18,2))",
           "rate": "CAST({} AS DECIMAL(18,6))", "offset": "CAST({} AS DECIMAL(5,2))", "bool": "({})", "json": "{}", "ts": "CAST({} AS TIMESTAMP)",
           "date": "CAST({} AS DATE)", "count": "CAST(trunc({}) AS BIGINT)"}


def record(fields: list[Field]) -> F.Column:
    """JSON text of the record; dots in a path are nested objects."""
    tree: dict = {}
    for f in fields:
        if f.path:
            *outer, key = f.path.split(".")
            node = tree
            for k in outer:
                node = node.setdefault(k, {})
            node[key] = F.expr(_RAW.get(f.kind, "CAST({} AS STRING)").format(f.record or f.value))

    def struct(node: dict) -> F.Column:
        return F.struct(*[(struct(v) if isinstance(v, dict) else v).alias(k) for k, v in node.items()])

    return F.to_json(struct(tree))


def oracle(fields: list[Field], source: str) -> str:
    return f"SELECT {', '.join(f'{_STORED[f.kind].format(f.value)} AS {f.column}' for f in fields)} FROM {source}"


def _json_list(*items: str) -> str:
    """DuckDB SQL of the compact JSON list of some text expressions."""
    return "'[\"' || " + " || '\",\"' || ".join(items) + " || '\"]'"


def _status(c: str, key: str) -> list[Field]:
    return [Field("Status", "status", "text", c), Field("ConfiguredStatus", "configured_status", "text", f"'C' || {c}"),
            Field("EffectiveStatus", "effective_status", "text", f"CASE WHEN {key} % 4 <> 0 THEN {c} END")]


def _shared(key: str, other: str) -> list[Field]:
    """Budgets, flags and promoted object of campaigns and ad sets."""
    return [Field("LifetimeBudget", "lifetime_budget", "money", f"CASE WHEN {key} % 6 <> 0 THEN {other} * 10 END"),
            Field("BudgetRemaining", "budget_remaining", "money", f"{other} % 500"), Field("SpendCap", "spend_cap", "money", f"{key} % 10000"),
            Field("SpecialAdCategoryCountry", "special_ad_category_country", "text", f"CASE WHEN {key} % 2 = 0 THEN 'DE' END"),
            Field("IsBudgetScheduleEnabled", "is_budget_schedule_enabled", "bool", f"{key} % 2 = 0"),
            Field("IsAdSetBudgetSharingEnabled", "is_adset_budget_sharing_enabled", "bool", f"CASE WHEN {key} % 5 <> 0 THEN {key} % 3 = 0 END"),
            Field("DestinationType", "destination_type", "text", f"CASE WHEN {key} % 3 = 0 THEN 'WEBSITE' ELSE 'APP' END"),
            Field("IsDynamicCreative", "is_dynamic_creative", "bool", f"{other} % 2 = 1"),
            Field("PacingType", "pacing_type", "json", f"CASE WHEN {key} % 7 <> 0 THEN '[\"standard\"]' END",
                  f"CASE WHEN {key} % 7 <> 0 THEN array('standard') ELSE array() END"),
            Field("AttributionSpec", "attribution_spec", "json", f"'[{{\"event_type\":\"CLICK_THROUGH\",\"window_days\":' || ({key} % 28) || '}}]'",
                  f"array(named_struct('event_type', 'CLICK_THROUGH', 'window_days', {key} % 28))"),
            Field("PromotedObjectPageID", "promoted_object.page_id", "long", f"{other} + 5"),
            Field("PromotedObjectPixelID", "promoted_object.pixel_id", "long", f"{other} * 3"),
            Field("PromotedObjectAppID", "promoted_object.application_id", "long", f"CASE WHEN {key} % 3 = 0 THEN {key} END")]


ACCOUNT = [
    Field("AccountID", "id", "text", "'act_' || CAST(c_custkey AS STRING)"), Field("AccountName", "name", "text", "c_name"),
    Field("AccountStatus", "account_status", "int", "c_custkey % 4"),
    Field("DisableReason", "disable_reason", "int", "CASE WHEN c_custkey % 7 = 0 THEN c_custkey % 3 END"),
    Field("Currency", "currency", "text", "CASE WHEN c_custkey % 2 = 0 THEN 'EUR' ELSE 'USD' END"),
    Field("TimezoneName", "timezone_name", "text", "c_mktsegment"),
    Field("TimezoneOffsetHrsUtc", "timezone_offset_hours_utc", "offset", "c_custkey % 24 - 11.5"),
    Field("AmountSpent", "amount_spent", "money", "c_custkey * 3"), Field("Balance", "balance", "money", "c_acctbal"),
    Field("SpendCap", "spend_cap", "money", "CASE WHEN c_custkey % 5 <> 0 THEN c_custkey * 100 END"),
    Field("MinCampaignGroupSpendCap", "min_campaign_group_spend_cap", "money", "c_custkey % 1000"),
    Field("MinDailyBudget", "min_daily_budget", "money", "c_custkey % 77"), Field("IsPersonal", "is_personal", "bool", "c_custkey % 3 = 0"),
    Field("BusinessID", "business.id", "long", "c_nationkey"), Field("FundingSourceID", "funding_source_details.id", "long", "c_custkey * 7"),
    Field("FundingSourceDisplayString", "funding_source_details.display_string", "text", "'VISA \"' || CAST(c_custkey AS STRING) || '\"'"),
    Field("FundingSourceType", "funding_source_details.type", "int", "CASE WHEN c_custkey % 9 <> 0 THEN c_custkey % 20 END")]

CAMPAIGN = [
    Field("CampaignID", "id", "long", "o_orderkey"), Field("AdAccountID", "", "text", "o_custkey"),
    Field("CampaignName", "name", "text", "'campaign ' || CAST(o_orderkey AS STRING)"), Field("Objective", "objective", "text", "o_orderpriority"),
    Field("BuyingType", "buying_type", "text", "CASE WHEN o_orderkey % 3 = 0 THEN 'AUCTION' ELSE 'RESERVED' END"),
    *_status("o_orderstatus", "o_orderkey"), Field("DailyBudget", "daily_budget", "money", "o_totalprice"),
    Field("SpecialAdCategories", "special_ad_categories", "json", _json_list("o_orderpriority", "o_orderstatus"), "array(o_orderpriority, o_orderstatus)"),
    *_shared("o_orderkey", "o_custkey"),
    Field("StartTime", "start_time", "ts", "o_orderdate + INTERVAL '1' HOUR"),
    Field("StopTime", "stop_time", "ts", "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate + INTERVAL '30' DAY END"),
    Field("CreatedTime", "created_time", "ts", "o_orderdate - INTERVAL '2' DAY"), Field("UpdatedTime", "updated_time", "ts", "o_orderdate")]

_TARGETING = ("'{\"geo_locations\":{\"countries\":' || " + _json_list("'DE'", "o_orderstatus") + " || '},\"age_min\":' || (18 + o_orderkey % 20) || ',\"age_max\":' "
              "|| (40 + o_orderkey % 20) || ',\"genders\":[1,' || (o_orderkey % 3) || '],\"publisher_platforms\":[\"facebook\"],\"facebook_positions\":[\"feed\"],"
              "\"device_platforms\":[\"mobile\",\"desktop\"]}'")
ADSET = [
    Field("AdSetID", "id", "long", "o_orderkey * 10 + 1"), Field("AdAccountID", "", "long", "o_custkey"), Field("CampaignID", "campaign_id", "long", "o_orderkey"),
    Field("AdSetName", "name", "text", "'set ' || CAST(o_orderkey AS STRING)"), *_status("o_orderstatus", "o_orderkey"),
    Field("OptimizationGoal", "optimization_goal", "text", "o_orderpriority"), Field("DailyBudget", "daily_budget", "money", "o_totalprice"),
    *_shared("o_orderkey", "o_custkey"),
    Field("Targeting", "targeting", "json", _TARGETING,
          "named_struct('geo_locations', named_struct('countries', array('DE', o_orderstatus)), 'age_min', 18 + o_orderkey % 20, 'age_max', 40 + o_orderkey % 20, "
          "'genders', array(1, o_orderkey % 3), 'publisher_platforms', array('facebook'), 'facebook_positions', array('feed'), "
          "'device_platforms', array('mobile', 'desktop'))"),
    Field("TargetingCountries", "", "json", _json_list("'DE'", "o_orderstatus")), Field("TargetingAgeMin", "", "int", "18 + o_orderkey % 20"),
    Field("TargetingAgeMax", "", "int", "40 + o_orderkey % 20"), Field("TargetingGenders", "", "json", "'[1,' || (o_orderkey % 3) || ']'"),
    Field("TargetingPublisherPlatforms", "", "json", "'[\"facebook\"]'"), Field("TargetingFacebookPositions", "", "json", "'[\"feed\"]'"),
    Field("TargetingDevicePlatforms", "", "json", "'[\"mobile\",\"desktop\"]'"),
    Field("StartTime", "start_time", "ts", "o_orderdate + INTERVAL '1' HOUR"),
    Field("EndTime", "end_time", "ts", "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate + INTERVAL '30' DAY END"),
    Field("CreatedTime", "created_time", "ts", "o_orderdate - INTERVAL '2' DAY"), Field("UpdatedTime", "updated_time", "ts", "o_orderdate"),
    Field("SourceAdSetID", "source_adset_id", "long", "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey * 10 END")]

_TS = "date_trunc('second', ts)"
AD = [
    Field("AdID", "id", "long", "event_id"), Field("AdAccountID", "account_id", "long", "user_id", "'act_' || CAST(user_id AS STRING)"),
    Field("CampaignID", "campaign_id", "long", "event_id * 2"), Field("AdSetID", "adset_id", "long", "event_id * 10 + 1"),
    Field("CreativeID", "creative.id", "long", "event_id % 50"), Field("AdName", "name", "text", "'ad ' || CAST(event_id AS STRING)"),
    *_status("event_type", "event_id"), Field("AdActiveTime", "ad_active_time", "int", "CASE WHEN event_id % 3 <> 0 THEN event_id % 5000 END"),
    Field("SourceAdID", "source_ad_id", "long", "CASE WHEN event_id % 2 = 0 THEN event_id + 1 END"),
    Field("EffectiveObjectStoryID", "effective_object_story_id", "text", "CAST(user_id AS STRING) || '_' || CAST(event_id AS STRING)"),
    Field("ObjectStoryID", "object_story_id", "text", "CASE WHEN event_id % 5 <> 0 THEN CAST(event_id AS STRING) || '_1' END"),
    Field("ScheduledStartTime", "scheduled_start_time", "ts", f"{_TS} + INTERVAL '1' HOUR"),
    Field("ScheduledEndTime", "scheduled_end_time", "ts", f"CASE WHEN event_id % 4 <> 0 THEN {_TS} + INTERVAL '7' DAY END"),
    Field("CreatedTime", "created_time", "ts", f"{_TS} - INTERVAL '1' DAY"), Field("UpdatedTime", "updated_time", "ts", _TS)]

PAGE = [
    Field("PageID", "id", "long", "s_suppkey"), Field("PageName", "name", "text", "s_name"), Field("BusinessID", "business.id", "long", "s_nationkey"),
    Field("VerificationStatus", "verification_status", "text", "CASE WHEN s_suppkey % 3 <> 0 THEN 'blue_verified' END"),
    Field("IsVerified", "is_verified", "bool", "s_suppkey % 3 <> 0"), Field("IsPublished", "is_published", "bool", "CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey % 2 = 0 END")]

POST = [
    Field("PostID", "id", "text", "CAST(user_id AS STRING) || '_' || CAST(event_id AS STRING)"), Field("PageID", "", "long", "user_id"),
    Field("CreatedTime", "created_time", "ts", _TS), Field("UpdatedTime", "updated_time", "ts", f"CASE WHEN event_id % 3 <> 0 THEN {_TS} + INTERVAL '5' MINUTE END"),
    Field("PermalinkURL", "permalink_url", "text", "'https://example.org/' || CAST(event_id AS STRING) || '?a=1&b=\"x\"'"),
    Field("StatusType", "status_type", "text", "event_type"), Field("IsPublished", "is_published", "bool", "event_id % 2 = 0"),
    Field("IsExpired", "is_expired", "bool", "CASE WHEN event_id % 5 <> 0 THEN event_id % 3 = 0 END"), Field("IsHidden", "is_hidden", "bool", "event_id % 7 = 0")]

AD_INSIGHT = [
    Field("AdID", "ad_id", "long", "event_id"), Field("AdSetID", "adset_id", "long", "event_id * 10 + 1"), Field("CampaignID", "campaign_id", "long", "event_id * 2"),
    Field("AdAccountID", "account_id", "long", "user_id", "'act_' || CAST(user_id AS STRING)"), Field("Date", "date_start", "date", "ts"),
    Field("DateKey", "", "int", "year(ts) * 10000 + month(ts) * 100 + day(ts)"),
    Field("Impressions", "impressions", "count", "event_id % 1000 + 0.75"), Field("Reach", "reach", "count", "event_id % 900"),
    Field("Frequency", "frequency", "rate", "event_id % 10 + 0.125"), Field("Spend", "spend", "money", "event_id % 100 + 0.25"),
    Field("SocialSpend", "social_spend", "money", "CASE WHEN event_id % 3 <> 0 THEN event_id % 50 + 0.5 END"), Field("Clicks", "clicks", "count", "event_id % 40"),
    Field("UniqueClicks", "unique_clicks", "count", "CASE WHEN event_id % 4 <> 0 THEN event_id % 30 END"), Field("CPC", "cpc", "rate", "event_id % 8 + 0.0625"),
    Field("CPP", "cpp", "rate", "event_id % 9 + 0.03125"), Field("InlineLinkClicks", "inline_link_clicks", "count", "event_id % 20"),
    Field("InlineLinkClickCTR", "inline_link_click_ctr", "rate", "event_id % 5 + 0.5"),
    Field("CostPerInlineLinkClick", "cost_per_inline_link_click", "rate", "CASE WHEN event_id % 20 <> 0 THEN event_id % 6 + 0.25 END"),
    Field("InlinePostEngagement", "inline_post_engagement", "count", "event_id % 70"),
    Field("CostPerInlinePostEngagement", "cost_per_inline_post_engagement", "rate", "event_id % 4 + 0.75"),
    Field("Leads", "actions", "long", "CASE WHEN event_id % 3 <> 0 THEN event_id % 9 + 2 END",
          "array(named_struct('action_type', CASE WHEN event_id % 3 <> 0 THEN 'lead' ELSE 'click' END, 'value', CAST(event_id % 9 AS STRING)), "
          "named_struct('action_type', CASE WHEN event_id % 3 <> 0 THEN 'lead' ELSE 'view' END, 'value', '2'), named_struct('action_type', 'lead', 'value', 'none'))"),
    Field("CostPerLead", "cost_per_action_type", "rate", "event_id % 7 + 0.5",
          "array(named_struct('action_type', 'lead', 'value', CAST(event_id % 7 + 0.5 AS STRING)), named_struct('action_type', 'click', 'value', '9'))")]


def _records(spark, sf: str, table: str, entity: str, fields: list[Field], parent: F.Column | None, order: str, schema) -> DataFrame:
    pages = A.landing(A.table(spark, sf, table), entity, parent, F.col(order), [record([_as_is(f) for f in fields])])
    return L.explode_pages(pages, schema)


def _as_is(f: Field) -> Field:
    """Lists and objects go into the record as they are."""
    return f._replace(kind="json") if f.record.startswith(("array(", "named_struct(")) else f


def _all_columns(df: DataFrame, table: str, fields: list[Field]) -> DataFrame:
    """Every column of the table but LoadDate; the fields must name them all."""
    missing = {c for c in TABLES[table].columns if c != "LoadDate"} ^ {f.column for f in fields}
    if missing:
        raise ValueError(f"{table}: {sorted(missing)}")
    return df.select(*[f.column for f in fields])


def _tag(column: str) -> F.Column:
    return F.concat(F.lit("act_"), F.col(column).cast("string"))


@register("all_columns_ad_account", oracle(ACCOUNT, "customer"))
def q_all_columns_ad_account(spark, sf):
    """PRJ-2: all 17 columns of AdAccount."""
    return _all_columns(entities.ad_account(_records(spark, sf, "customer", "account", ACCOUNT, None, "c_custkey", RAW_ACCOUNT)), "AdAccount", ACCOUNT)


@register("all_columns_campaign", oracle(CAMPAIGN, "orders"))
def q_all_columns_campaign(spark, sf):
    """PRJ-3: all 27 columns of Campaign."""
    return _all_columns(entities.campaign(_records(spark, sf, "orders", "campaign", CAMPAIGN, _tag("o_custkey"), "o_orderkey", RAW_CAMPAIGN)), "Campaign", CAMPAIGN)


@register("all_columns_adset", oracle(ADSET, "orders WHERE o_orderstatus <> 'P'"))
def q_all_columns_adset(spark, sf):
    """PRJ-4 + JN-1: all 35 columns of AdSet, for staged campaigns."""
    recs = _records(spark, sf, "orders", "adset", ADSET, _tag("o_custkey"), "o_orderkey", RAW_ADSET)
    staged = A.table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("CampaignID"))
    return _all_columns(entities.adset(recs, staged), "AdSet", ADSET)


@register("all_columns_ad", oracle(AD, "events"))
def q_all_columns_ad(spark, sf):
    """PRJ-5: all 17 columns of Ad, where no ad set is staged that would replace its parents."""
    staged = A.table(spark, sf, "orders").select((-F.col("o_orderkey") - 1).alias("AdSetID"), F.col("o_orderkey").alias("CampaignID"), F.col("o_custkey").alias("AdAccountID"))
    return _all_columns(entities.ad(_records(spark, sf, "events", "ad", AD, _tag("user_id"), "event_id", RAW_AD), staged), "Ad", AD)


@register("all_columns_page", oracle(PAGE, "supplier"))
def q_all_columns_page(spark, sf):
    """PRJ-7: all columns of Page."""
    return _all_columns(entities.page(_records(spark, sf, "supplier", "page", PAGE, F.lit("999"), "s_suppkey", RAW_PAGE)), "Page", PAGE)


@register("all_columns_post", oracle(POST, "events"))
def q_all_columns_post(spark, sf):
    """PRJ-8: all columns of Post."""
    return _all_columns(entities.post(_records(spark, sf, "events", "post", POST, F.col("user_id"), "event_id", RAW_POST)), "Post", POST)


@register("all_columns_ad_insights", oracle(AD_INSIGHT, "events"))
def q_all_columns_ad_insights(spark, sf):
    """PRJ-9 + AG-3: all 22 columns of AdInsightsDaily."""
    recs = _records(spark, sf, "events", "ad_insight", AD_INSIGHT, _tag("user_id"), "event_id", RAW_AD_INSIGHT)
    return _all_columns(entities.ad_insights_daily(recs), "AdInsightsDaily", AD_INSIGHT)
