"""Raw record schemas and the staging-table registry.

Raw schemas declare every scalar as STRING: ids, numbers and booleans arrive
quoted or unquoted, and ``from_json`` yields NULL for a quoted number in a
numeric field. Typing happens afterwards with the try_* rules in
``tidewater.functions.coerce``. Fields kept as JSON text (pacing_type,
targeting, ...) are STRING as well, which keeps their compact source text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S = T.StringType()

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "money": T.DecimalType(18, 2),
    "rate": T.DecimalType(18, 6),
    "tz": T.DecimalType(5, 2),
}


def _struct(spec: str) -> T.StructType:
    """``"A long, B string"`` -> StructType (all nullable)."""
    out = []
    for part in spec.split(","):
        name, kind = part.split()
        out.append(T.StructField(name, _TYPES[kind], True))
    return T.StructType(out)


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, S, True) for n in names]


# ---------------------------------------------------------------------------
# Landing and page envelope
# ---------------------------------------------------------------------------

# One landed row = one API page for one parent.
LANDING = T.StructType([
    T.StructField("entity", S, True),
    T.StructField("parent_id", S, True),
    T.StructField("page_no", T.LongType(), True),
    T.StructField("body", S, True),
])

# {"data": [...], "paging": {"next": ...}}; records stay JSON text until the
# entity schema is applied, so one envelope schema serves every entity.
ENVELOPE = T.StructType([
    T.StructField("data", T.ArrayType(S), True),
    T.StructField("paging", T.StructType(_strings("next")), True),
])

# ---------------------------------------------------------------------------
# Raw entity schemas (every scalar STRING)
# ---------------------------------------------------------------------------

_ID_NAME = T.StructType(_strings("id", "name"))
_PROMOTED = T.StructType(_strings("page_id", "pixel_id", "application_id"))
_ACTION = T.StructType(_strings("action_type", "value"))

RAW_ACCOUNT = T.StructType(
    _strings("id", "name", "account_status", "currency", "timezone_name",
             "timezone_offset_hours_utc", "disable_reason", "amount_spent", "balance",
             "spend_cap", "min_campaign_group_spend_cap", "min_daily_budget", "is_personal")
    + [T.StructField("business", _ID_NAME, True),
       T.StructField("funding_source_details", T.StructType(_strings("id", "display_string", "type")), True)]
)

RAW_CAMPAIGN = T.StructType(
    _strings("id", "account_id", "name", "objective", "buying_type", "status",
             "configured_status", "effective_status", "daily_budget", "lifetime_budget",
             "budget_remaining", "spend_cap", "special_ad_categories",
             "special_ad_category_country", "is_budget_schedule_enabled",
             "is_adset_budget_sharing_enabled", "destination_type", "is_dynamic_creative",
             "pacing_type", "attribution_spec")
    + [T.StructField("promoted_object", _PROMOTED, True)]
    + _strings("start_time", "stop_time", "created_time", "updated_time")
)

TARGETING = T.StructType([
    T.StructField("geo_locations", T.StructType(_strings("countries")), True),
    *_strings("age_min", "age_max", "genders", "publisher_platforms",
              "facebook_positions", "device_platforms"),
])

RAW_ADSET = T.StructType(
    _strings("id", "account_id", "campaign_id", "name", "status", "configured_status",
             "effective_status", "optimization_goal", "daily_budget", "lifetime_budget",
             "budget_remaining", "spend_cap", "special_ad_category_country",
             "is_budget_schedule_enabled", "is_adset_budget_sharing_enabled",
             "destination_type", "is_dynamic_creative", "pacing_type", "attribution_spec")
    + [T.StructField("promoted_object", _PROMOTED, True),
       # read twice: whole object as JSON text, and typed for the exploded columns
       T.StructField("targeting", S, True)]
    + _strings("start_time", "end_time", "created_time", "updated_time", "source_adset_id")
)

RAW_AD = T.StructType(
    _strings("id", "account_id", "campaign_id", "adset_id")
    + [T.StructField("creative", _ID_NAME, True)]
    + _strings("name", "status", "configured_status", "effective_status", "ad_active_time",
               "source_ad_id", "effective_object_story_id", "object_story_id",
               "scheduled_start_time", "scheduled_end_time", "created_time", "updated_time")
)

RAW_PAGE = T.StructType(
    _strings("id", "name", "verification_status", "is_verified", "is_published")
    + [T.StructField("business", T.StructType(_strings("id")), True)]
)

RAW_POST = T.StructType(_strings("id", "created_time", "updated_time", "permalink_url",
                                 "status_type", "is_published", "is_expired", "is_hidden"))

RAW_AD_INSIGHT = T.StructType(
    _strings("date_start", "date_stop", "account_id", "campaign_id", "adset_id", "ad_id",
             "impressions", "reach", "frequency", "spend", "social_spend", "clicks",
             "unique_clicks", "cpc", "cpp", "inline_link_clicks", "inline_link_click_ctr",
             "cost_per_inline_link_click", "inline_post_engagement",
             "cost_per_inline_post_engagement")
    + [T.StructField("actions", T.ArrayType(_ACTION), True),
       T.StructField("cost_per_action_type", T.ArrayType(_ACTION), True)]
)

RAW_PAGE_INSIGHT = T.StructType([
    T.StructField("name", S, True),
    T.StructField("values", T.ArrayType(T.StructType(_strings("end_time", "value"))), True),
])

# value is kept as JSON text: it may be a number or an arbitrarily nested object
RAW_POST_INSIGHT = T.StructType([
    T.StructField("name", S, True),
    T.StructField("values", T.ArrayType(T.StructType(_strings("value"))), True),
    T.StructField("value", S, True),
])

RAW_SCHEMAS = {
    "account": RAW_ACCOUNT,
    "campaign": RAW_CAMPAIGN,
    "adset": RAW_ADSET,
    "ad": RAW_AD,
    "page": RAW_PAGE,
    "post": RAW_POST,
    "ad_insight": RAW_AD_INSIGHT,
    "page_insight": RAW_PAGE_INSIGHT,
    "post_insight": RAW_POST_INSIGHT,
}

# ---------------------------------------------------------------------------
# Staging tables
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    load_mode: str  # upsert | insert_only | replace_window
    not_null: tuple[str, ...] = ()
    text_limits: dict[str, int] = field(default_factory=dict)
    partition_col: str | None = None  # facts are stored per DateKey

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


_STATUS3 = "Status string, ConfiguredStatus string, EffectiveStatus string"
_BUDGETS = "DailyBudget money, LifetimeBudget money, BudgetRemaining money, SpendCap money"
_FLAGS = ("SpecialAdCategoryCountry string, IsBudgetScheduleEnabled boolean, "
          "IsAdSetBudgetSharingEnabled boolean, DestinationType string, IsDynamicCreative boolean, "
          "PacingType string, AttributionSpec string, PromotedObjectPageID long, "
          "PromotedObjectPixelID long, PromotedObjectAppID long")

TABLES: dict[str, TableSpec] = {t.name: t for t in [
    TableSpec("Business", _struct("BusinessID long, BusinessName string, LoadDate timestamp"),
              ("BusinessID",), "upsert", text_limits={"BusinessName": 500}),
    TableSpec("AdAccount", _struct(
        "AccountID string, AccountName string, AccountStatus int, DisableReason int, "
        "Currency string, TimezoneName string, TimezoneOffsetHrsUtc tz, AmountSpent money, "
        "Balance money, SpendCap money, MinCampaignGroupSpendCap money, MinDailyBudget money, "
        "IsPersonal boolean, BusinessID long, FundingSourceID long, "
        "FundingSourceDisplayString string, FundingSourceType int, LoadDate timestamp"),
        ("AccountID",), "upsert",
        text_limits={"AccountID": 500, "AccountName": 500, "Currency": 50, "TimezoneName": 200,
                     "FundingSourceDisplayString": 500}),
    TableSpec("Campaign", _struct(
        f"CampaignID long, AdAccountID string, CampaignName string, Objective string, "
        f"BuyingType string, {_STATUS3}, {_BUDGETS}, SpecialAdCategories string, {_FLAGS}, "
        f"StartTime timestamp, StopTime timestamp, CreatedTime timestamp, UpdatedTime timestamp, "
        f"LoadDate timestamp"),
        ("CampaignID",), "upsert", not_null=("AdAccountID",),
        text_limits={"AdAccountID": 500, "CampaignName": 500, "Objective": 100, "BuyingType": 100,
                     "Status": 100, "ConfiguredStatus": 100, "EffectiveStatus": 100,
                     "SpecialAdCategoryCountry": 100, "DestinationType": 100}),
    TableSpec("AdSet", _struct(
        f"AdSetID long, AdAccountID long, CampaignID long, AdSetName string, {_STATUS3}, "
        f"OptimizationGoal string, {_BUDGETS}, {_FLAGS}, Targeting string, "
        f"TargetingCountries string, TargetingAgeMin int, TargetingAgeMax int, "
        f"TargetingGenders string, TargetingPublisherPlatforms string, "
        f"TargetingFacebookPositions string, TargetingDevicePlatforms string, "
        f"StartTime timestamp, EndTime timestamp, CreatedTime timestamp, UpdatedTime timestamp, "
        f"SourceAdSetID long, LoadDate timestamp"),
        ("AdSetID",), "upsert", not_null=("AdAccountID",),
        text_limits={"AdSetName": 500, "Status": 100, "ConfiguredStatus": 100,
                     "EffectiveStatus": 100, "OptimizationGoal": 100,
                     "SpecialAdCategoryCountry": 100, "DestinationType": 100}),
    TableSpec("Ad", _struct(
        f"AdID long, AdAccountID long, CampaignID long, AdSetID long, CreativeID long, "
        f"AdName string, {_STATUS3}, AdActiveTime int, SourceAdID long, "
        f"EffectiveObjectStoryID string, ObjectStoryID string, ScheduledStartTime timestamp, "
        f"ScheduledEndTime timestamp, CreatedTime timestamp, UpdatedTime timestamp, "
        f"LoadDate timestamp"),
        ("AdID",), "upsert", not_null=("AdAccountID",),
        text_limits={"AdName": 500, "Status": 100, "ConfiguredStatus": 100, "EffectiveStatus": 100,
                     "EffectiveObjectStoryID": 500, "ObjectStoryID": 500}),
    TableSpec("Creative", _struct("CreativeId string, CreativeName string, LoadDate timestamp"),
              ("CreativeId",), "upsert", text_limits={"CreativeId": 100, "CreativeName": 255}),
    TableSpec("Page", _struct(
        "PageID long, PageName string, BusinessID long, VerificationStatus string, "
        "IsVerified boolean, IsPublished boolean, LoadDate timestamp"),
        ("PageID",), "upsert", text_limits={"PageName": 500, "VerificationStatus": 100}),
    TableSpec("Post", _struct(
        "PostID string, PageID long, CreatedTime timestamp, UpdatedTime timestamp, "
        "PermalinkURL string, StatusType string, IsPublished boolean, IsExpired boolean, "
        "IsHidden boolean, LoadDate timestamp"),
        ("PostID",), "upsert", not_null=("PageID",),
        text_limits={"PostID": 100, "PermalinkURL": 1000, "StatusType": 100}),
    TableSpec("AdInsightsDaily", _struct(
        "AdID long, AdSetID long, CampaignID long, AdAccountID long, Date date, DateKey int, "
        "Impressions long, Reach long, Frequency rate, Spend money, SocialSpend money, "
        "Clicks long, UniqueClicks long, CPC rate, CPP rate, InlineLinkClicks long, "
        "InlineLinkClickCTR rate, CostPerInlineLinkClick rate, InlinePostEngagement long, "
        "CostPerInlinePostEngagement rate, Leads long, CostPerLead rate, LoadDate timestamp"),
        ("AdID", "DateKey"), "upsert", not_null=("AdAccountID", "Date"), partition_col="DateKey"),
    TableSpec("PageInsightsDaily", _struct(
        "PageID long, DateKey int, MetricName string, Date date, Value rate, LoadDate timestamp"),
        ("PageID", "DateKey", "MetricName"), "replace_window", not_null=("Date",),
        text_limits={"MetricName": 200}, partition_col="DateKey"),
    TableSpec("PostInsightsDaily", _struct(
        "PostID string, DateKey int, Date date, Shares long, Reactions long, Comments long, "
        "LoadDate timestamp"),
        ("PostID", "DateKey"), "insert_only", not_null=("Date",),
        text_limits={"PostID": 100}, partition_col="DateKey"),
]}

# Run log (one row per pipeline step), append-only.
RUN_LOG = _struct(
    "RunId string, FunctionName string, StartedAt timestamp, FinishedAt timestamp, "
    "Status string, RowsReceived long, RowsWritten long, ErrorCount int, ErrorMessage string, "
    "RowsInserted long, RowsUpdated long, RowsRejected long, RowsSkipped long")
