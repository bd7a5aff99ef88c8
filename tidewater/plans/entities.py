"""Entity projections: exploded raw records -> staged rows (PRJ-1 ... PRJ-11).

Each function is a pure, lazy ``DataFrame -> DataFrame``: built-in column
expressions for flattening and coercion, then keep-first dedup on the table
key in arrival order. Input records come from
``tidewater.sources.landing.explode_pages`` with the entity's raw schema, so
they carry ``_parent, _page, _pos`` (arrival order) next to the raw fields.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.coerce import (
    as_bool, as_date, as_datetime, as_decimal, as_int, as_json_text, as_long, as_number,
    bare_account_id, date_key, truthy, truthy_or,
)
from tidewater.functions.metrics import action_sum, find_metric, leaf_sum
from tidewater.operators.dedup import dedup_first
from tidewater.operators.joins import conform_quarantine, conform_semi, lookup_match_wins
from tidewater.operators.windows import in_window, period_end_day
from tidewater.schemas import TABLES, TARGETING
from tidewater.sources.landing import SEQ_COLS, explode_metric_values, last_metric_value

SEQ = list(SEQ_COLS)

# Action types that count as a lead, and the metric names and
# keys the post-insight pivot looks for.
LEAD_ACTION_TYPES = ("lead",)
POST_ACTIVITY_METRIC = "post_activity_by_action_type"
POST_REACTIONS_METRIC = "post_reactions_by_type_total"
SHARE_KEYS = ("share", "shares")
COMMENT_KEYS = ("comment", "comments")
REACTION_TOTAL_KEYS = ("total", "total_count")


def _finish(df: DataFrame, table: str, keep_seq: bool = False) -> DataFrame:
    """Dedup keep-first on the table key, then the table's column order."""
    spec = TABLES[table]
    out = dedup_first(df, spec.keys, SEQ)
    cols = [c for c in spec.columns if c in out.columns]
    return out.select(*cols, *(SEQ if keep_seq else []))


def _promoted(prefix: str = "promoted_object") -> list[Column]:
    return [as_long(f"{prefix}.page_id").alias("PromotedObjectPageID"),
            as_long(f"{prefix}.pixel_id").alias("PromotedObjectPixelID"),
            as_long(f"{prefix}.application_id").alias("PromotedObjectAppID")]


def _budgets() -> list[Column]:
    return [as_decimal("daily_budget").alias("DailyBudget"),
            as_decimal("lifetime_budget").alias("LifetimeBudget"),
            as_decimal("budget_remaining").alias("BudgetRemaining"),
            as_decimal("spend_cap").alias("SpendCap")]


def _statuses() -> list[Column]:
    return [F.col("status").alias("Status"),
            F.col("configured_status").alias("ConfiguredStatus"),
            F.col("effective_status").alias("EffectiveStatus")]


def _flags() -> list[Column]:
    return [F.col("special_ad_category_country").alias("SpecialAdCategoryCountry"),
            as_bool("is_budget_schedule_enabled").alias("IsBudgetScheduleEnabled"),
            as_bool("is_adset_budget_sharing_enabled").alias("IsAdSetBudgetSharingEnabled"),
            F.col("destination_type").alias("DestinationType"),
            as_bool("is_dynamic_creative").alias("IsDynamicCreative"),
            as_json_text("pacing_type", "_rec", "pacing_type").alias("PacingType"),
            as_json_text("attribution_spec", "_rec", "attribution_spec").alias("AttributionSpec")]


def _seq() -> list[Column]:
    return [F.col(c) for c in SEQ]


# ---------------------------------------------------------------------------
# Dimensions
# ---------------------------------------------------------------------------

def business(accounts: DataFrame) -> DataFrame:
    """PRJ-1: Business from the ``business`` object of account records (FLT-1)."""
    rows = accounts.where(truthy("business.id")).select(
        as_long("business.id").alias("BusinessID"),
        F.col("business.name").alias("BusinessName"), *_seq())
    return _finish(rows, "Business")


def ad_account(accounts: DataFrame) -> DataFrame:
    """PRJ-2: AdAccount; AccountID keeps its ``act_`` prefix."""
    rows = accounts.select(
        F.col("id").alias("AccountID"), F.col("name").alias("AccountName"),
        as_int("account_status").alias("AccountStatus"),
        as_int("disable_reason").alias("DisableReason"),
        F.col("currency").alias("Currency"), F.col("timezone_name").alias("TimezoneName"),
        as_decimal("timezone_offset_hours_utc", 5, 2).alias("TimezoneOffsetHrsUtc"),
        as_decimal("amount_spent").alias("AmountSpent"), as_decimal("balance").alias("Balance"),
        as_decimal("spend_cap").alias("SpendCap"),
        as_decimal("min_campaign_group_spend_cap").alias("MinCampaignGroupSpendCap"),
        as_decimal("min_daily_budget").alias("MinDailyBudget"),
        as_bool("is_personal").alias("IsPersonal"),
        as_long("business.id").alias("BusinessID"),
        as_long("funding_source_details.id").alias("FundingSourceID"),
        F.col("funding_source_details.display_string").alias("FundingSourceDisplayString"),
        as_int("funding_source_details.type").alias("FundingSourceType"),
        *_seq())
    return _finish(rows, "AdAccount")


def campaign(campaigns: DataFrame) -> DataFrame:
    """PRJ-3: Campaign; AdAccountID = bare(parent account or record account)."""
    rows = campaigns.select(
        as_long("id").alias("CampaignID"),
        bare_account_id(truthy_or("_parent", "account_id")).alias("AdAccountID"),
        F.col("name").alias("CampaignName"), F.col("objective").alias("Objective"),
        F.col("buying_type").alias("BuyingType"), *_statuses(), *_budgets(),
        as_json_text("special_ad_categories", "_rec", "special_ad_categories").alias("SpecialAdCategories"),
        *_flags(), *_promoted(),
        as_datetime("start_time").alias("StartTime"), as_datetime("stop_time").alias("StopTime"),
        as_datetime("created_time").alias("CreatedTime"),
        as_datetime("updated_time").alias("UpdatedTime"), *_seq())
    return _finish(rows, "Campaign")


def _adset_rows(adsets: DataFrame, *more: Column) -> DataFrame:
    t = F.from_json("targeting", TARGETING)
    return adsets.withColumn("_t", t).select(
        as_long("id").alias("AdSetID"),
        as_long(bare_account_id(truthy_or("_parent", "account_id"))).alias("AdAccountID"),
        as_long("campaign_id").alias("CampaignID"),
        F.col("name").alias("AdSetName"), *_statuses(),
        F.col("optimization_goal").alias("OptimizationGoal"), *_budgets(), *_flags(), *_promoted(),
        as_json_text("targeting", "_rec", "targeting").alias("Targeting"),
        as_json_text("_t.geo_locations.countries", "targeting", "countries").alias("TargetingCountries"),
        as_int("_t.age_min").alias("TargetingAgeMin"),
        as_int("_t.age_max").alias("TargetingAgeMax"),
        as_json_text("_t.genders", "targeting", "genders").alias("TargetingGenders"),
        as_json_text("_t.publisher_platforms", "targeting", "publisher_platforms").alias("TargetingPublisherPlatforms"),
        as_json_text("_t.facebook_positions", "targeting", "facebook_positions").alias("TargetingFacebookPositions"),
        as_json_text("_t.device_platforms", "targeting", "device_platforms").alias("TargetingDevicePlatforms"),
        as_datetime("start_time").alias("StartTime"), as_datetime("end_time").alias("EndTime"),
        as_datetime("created_time").alias("CreatedTime"),
        as_datetime("updated_time").alias("UpdatedTime"),
        as_long("source_adset_id").alias("SourceAdSetID"), *_seq(), *more)


def adset(adsets: DataFrame, staged_campaigns: DataFrame) -> DataFrame:
    """PRJ-4: AdSet, only for campaigns already staged (JN-1)."""
    # projected before the join: what it shuffles is the table's columns, not the record text and its raw fields
    rows = _adset_rows(adsets, F.col("campaign_id").alias("_campaign"))
    return _finish(conform_semi(rows, "_campaign", staged_campaigns, "CampaignID").drop("_campaign"), "AdSet")


def adset_conformed(kept: DataFrame) -> DataFrame:
    """PRJ-4 on records already conformed to staged campaigns (JN-1 applied)."""
    return _finish(_adset_rows(kept), "AdSet")


def adset_quarantine(adsets: DataFrame, staged_campaigns: DataFrame) -> DataFrame:
    """JN-1 skip side of PRJ-4: raw ad-set records without a staged campaign."""
    return conform_quarantine(adsets, "campaign_id", staged_campaigns, "CampaignID")


def ad(ads: DataFrame, staged_adsets: DataFrame) -> DataFrame:
    """PRJ-5: Ad with parent ids from the staged AdSet (JN-2, match wins)."""
    adset_key = F.when(truthy("adset_id"), F.col("adset_id"))
    lookup = staged_adsets.select(
        F.col("AdSetID").cast("string").alias("AdSetID"),
        F.col("CampaignID").cast("string").alias("CampaignID"),
        F.col("AdAccountID").cast("string").alias("AdAccountID"))
    enriched = lookup_match_wins(
        ads.withColumn("_adset_key", adset_key), "_adset_key", lookup, "AdSetID",
        {"_campaign": ("CampaignID", F.col("campaign_id")),
         "_account": ("AdAccountID", F.col("account_id"))})
    rows = enriched.select(
        as_long("id").alias("AdID"),
        as_long(bare_account_id(truthy_or("_account", "_parent"))).alias("AdAccountID"),
        as_long("_campaign").alias("CampaignID"),
        as_long("_adset_key").alias("AdSetID"),
        as_long("creative.id").alias("CreativeID"),
        F.col("name").alias("AdName"), *_statuses(),
        as_int("ad_active_time").alias("AdActiveTime"),
        as_long("source_ad_id").alias("SourceAdID"),
        F.col("effective_object_story_id").alias("EffectiveObjectStoryID"),
        F.col("object_story_id").alias("ObjectStoryID"),
        as_datetime("scheduled_start_time").alias("ScheduledStartTime"),
        as_datetime("scheduled_end_time").alias("ScheduledEndTime"),
        as_datetime("created_time").alias("CreatedTime"),
        as_datetime("updated_time").alias("UpdatedTime"), *_seq())
    return _finish(rows, "Ad")


def creative(ads: DataFrame) -> DataFrame:
    """PRJ-6: Creative from the ``creative`` object of ad records (FLT-1)."""
    rows = ads.where(truthy("creative.id")).select(
        F.col("creative.id").alias("CreativeId"),
        F.col("creative.name").alias("CreativeName"), *_seq())
    return _finish(rows, "Creative")


def page(pages: DataFrame) -> DataFrame:
    """PRJ-7: Page; BusinessID = record's business or the parent business."""
    rows = pages.select(
        as_long("id").alias("PageID"), F.col("name").alias("PageName"),
        as_long(truthy_or("business.id", "_parent")).alias("BusinessID"),
        F.col("verification_status").alias("VerificationStatus"),
        as_bool("is_verified").alias("IsVerified"), as_bool("is_published").alias("IsPublished"),
        *_seq())
    return _finish(rows, "Page")


def post(posts: DataFrame) -> DataFrame:
    """PRJ-8: Post; PageID from the parent tag."""
    rows = posts.select(
        F.col("id").alias("PostID"), as_long("_parent").alias("PageID"),
        as_datetime("created_time").alias("CreatedTime"),
        as_datetime("updated_time").alias("UpdatedTime"),
        F.col("permalink_url").alias("PermalinkURL"), F.col("status_type").alias("StatusType"),
        as_bool("is_published").alias("IsPublished"), as_bool("is_expired").alias("IsExpired"),
        as_bool("is_hidden").alias("IsHidden"), *_seq())
    return _finish(rows, "Post")


# ---------------------------------------------------------------------------
# Facts
# ---------------------------------------------------------------------------

def _count(c: str) -> Column:
    """A count that arrived as a number: through double, truncated to bigint (Q10)."""
    return as_number(c).try_cast("bigint")


def _rate(c: Column | str) -> Column:
    c = as_number(c) if isinstance(c, str) else c
    return c.try_cast("decimal(18,6)")


def ad_insights_daily(insights: DataFrame, since: dt.date | None = None,
                      until: dt.date | None = None,
                      lead_types: Iterable[str] = LEAD_ACTION_TYPES) -> DataFrame:
    """PRJ-9: AdInsightsDaily; rows without AdID or Date dropped (FLT-2),
    window applied when given (quirk Q23), dedup on (AdID, DateKey)."""
    lead_types = tuple(lead_types)
    day = as_date("date_start")
    rows = insights.select(
        as_long("ad_id").alias("AdID"), as_long("adset_id").alias("AdSetID"),
        as_long("campaign_id").alias("CampaignID"),
        as_long(bare_account_id("account_id")).alias("AdAccountID"),
        day.alias("Date"), date_key(day).alias("DateKey"),
        _count("impressions").alias("Impressions"), _count("reach").alias("Reach"),
        _rate("frequency").alias("Frequency"),
        as_number("spend").try_cast("decimal(18,2)").alias("Spend"),
        as_number("social_spend").try_cast("decimal(18,2)").alias("SocialSpend"),
        _count("clicks").alias("Clicks"), _count("unique_clicks").alias("UniqueClicks"),
        _rate("cpc").alias("CPC"), _rate("cpp").alias("CPP"),
        _count("inline_link_clicks").alias("InlineLinkClicks"),
        _rate("inline_link_click_ctr").alias("InlineLinkClickCTR"),
        _rate("cost_per_inline_link_click").alias("CostPerInlineLinkClick"),
        _count("inline_post_engagement").alias("InlinePostEngagement"),
        _rate("cost_per_inline_post_engagement").alias("CostPerInlinePostEngagement"),
        action_sum("actions", lead_types).try_cast("bigint").alias("Leads"),
        _rate(action_sum("cost_per_action_type", lead_types)).alias("CostPerLead"),
        *_seq()).where(F.col("AdID").isNotNull() & F.col("Date").isNotNull())
    if since is not None and until is not None:
        rows = rows.where(in_window("Date", since, until))
    return _finish(rows, "AdInsightsDaily")


def page_insights_daily(insights: DataFrame, since: dt.date, until: dt.date) -> DataFrame:
    """PRJ-10 with SRC-7, WN-3, FLT-3: tall (PageID, DateKey, MetricName) rows."""
    vals = explode_metric_values(insights.select(*SEQ, "name", "values"))
    day = period_end_day(F.col("_v.end_time"))
    rows = vals.select(
        as_long("_parent").alias("PageID"), day.alias("Date"), date_key(day).alias("DateKey"),
        F.col("name").alias("MetricName"), _rate(as_number(F.col("_v.value"))).alias("Value"),
        F.col("_parent"), F.col("_page"), (F.shiftleft(F.col("_pos").cast("long"), 31) + F.col("_vpos")).alias("_pos"),
    ).where(in_window("Date", since, until)).dropna(subset=["PageID", "Date", "MetricName"])
    return _finish(rows, "PageInsightsDaily")


def post_metric_rows(insights: DataFrame) -> DataFrame:
    """SRC-8 on post-insight records: (PostID, metric, value text, arrival order)."""
    return (insights.select(F.col("_parent").alias("PostID"), F.col("name").alias("metric_name"),
                            last_metric_value("values", "value").alias("value_text"), *_seq())
            .where(F.col("value_text").isNotNull()))


def post_insights_daily(metric_rows: DataFrame, snapshot_date: dt.date) -> DataFrame:
    """PRJ-11 / AG-5: pivot tall metric rows to (Shares, Reactions, Comments).

    Per post, the last row of each metric wins, even when its value yields
    NULL; the struct wrapper keeps that NULL through ``max_by``. A post that
    only has unknown metrics still gives a row of NULLs. ``max_by`` is a
    partial aggregate, so a post with very many rows is pre-reduced per task.
    """
    order = F.struct(*_seq())
    rows = metric_rows.where(truthy("PostID"))

    def last_of(metric: str) -> Column:
        return F.max_by(F.struct(F.col("value_text").alias("v")),
                        F.when(F.col("metric_name") == metric, order))

    pivot = rows.groupBy("PostID").agg(
        last_of(POST_ACTIVITY_METRIC).alias("_act"),
        last_of(POST_REACTIONS_METRIC).alias("_rea"))
    act, rea = F.col("_act.v"), F.col("_rea.v")
    explicit_total = find_metric(rea, REACTION_TOTAL_KEYS)
    snap = F.lit(snapshot_date)
    return pivot.select(
        F.col("PostID"), date_key(snap).alias("DateKey"), snap.alias("Date"),
        find_metric(act, SHARE_KEYS).try_cast("bigint").alias("Shares"),
        F.coalesce(explicit_total, leaf_sum(rea)).try_cast("bigint").alias("Reactions"),
        find_metric(act, COMMENT_KEYS).try_cast("bigint").alias("Comments"))


__all__ = [
    "business", "ad_account", "campaign", "adset", "adset_conformed", "adset_quarantine", "ad", "creative",
    "page", "post", "ad_insights_daily", "page_insights_daily", "post_metric_rows", "post_insights_daily",
]
