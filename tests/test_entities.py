"""Golden entity tests: hand-written raw JSON pages -> staged rows (PRJ-1..11)."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewater.plans import entities
from tidewater.schemas import (RAW_ACCOUNT, RAW_AD, RAW_AD_INSIGHT, RAW_ADSET, RAW_CAMPAIGN, RAW_PAGE,
                               RAW_PAGE_INSIGHT, RAW_POST, RAW_POST_INSIGHT, TABLES)
from tidewater.sources.landing import explode_pages


def pages(spark, entity, items):
    """items: list of (parent_id, page_no, [records], next)."""
    rows = [(entity, p, n, json.dumps({"data": recs, "paging": ({"next": nx} if nx else {})}))
            for p, n, recs, nx in items]
    return spark.createDataFrame(rows, "entity string, parent_id string, page_no long, body string")


def recs(spark, entity, schema, items):
    return explode_pages(pages(spark, entity, items), schema)


def test_business_and_account(spark):
    r = recs(spark, "account", RAW_ACCOUNT, [(None, 0, [
        {"id": "act_1", "name": "A", "account_status": 1, "balance": "12.345", "is_personal": "false",
         "timezone_offset_hours_utc": -7.5, "business": {"id": "10", "name": "B10"},
         "funding_source_details": {"id": "77", "display_string": "Visa", "type": 1}},
        {"id": "act_2", "name": "A2", "business": {"id": "", "name": "blank"}},
        {"id": "act_1", "name": "dup", "business": {"id": "10", "name": "later"}},
    ], None)])
    b = entities.business(r).collect()
    assert [(x.BusinessID, x.BusinessName) for x in b] == [(10, "B10")]
    a = {x.AccountID: x for x in entities.ad_account(r).collect()}
    assert set(a) == {"act_1", "act_2"}
    x = a["act_1"]
    assert (x.AccountName, x.AccountStatus, float(x.Balance), x.IsPersonal, float(x.TimezoneOffsetHrsUtc),
            x.BusinessID, x.FundingSourceID, x.FundingSourceType) == ("A", 1, 12.35, False, -7.5, 10, 77, 1)


def test_campaign(spark):
    r = recs(spark, "campaign", RAW_CAMPAIGN, [("act_5", 0, [
        {"id": "100", "name": "C", "daily_budget": "5000", "special_ad_categories": [],
         "pacing_type": ["standard"], "attribution_spec": [{"event_type": "CLICK", "window_days": 7}],
         "promoted_object": {"page_id": "9"}, "start_time": "2026-08-01T10:00:00+0300",
         "updated_time": "1754035200", "is_dynamic_creative": True},
        {"id": "101", "account_id": "act_6"},
    ], None)])
    c = {x.CampaignID: x for x in entities.campaign(r).collect()}
    x = c[100]
    assert x.AdAccountID == "5" and float(x.DailyBudget) == 5000.0
    assert x.SpecialAdCategories is None and x.PacingType == '["standard"]'
    assert x.AttributionSpec == '[{"event_type":"CLICK","window_days":7}]'
    assert x.PromotedObjectPageID == 9 and x.IsDynamicCreative is True
    assert x.StartTime == dt.datetime(2026, 8, 1, 7) and x.UpdatedTime == dt.datetime(2025, 8, 1, 8)
    assert c[101].AdAccountID == "5"  # the parent tag wins over the record's account


def test_adset_conformance_and_targeting(spark):
    r = recs(spark, "adset", RAW_ADSET, [("act_5", 0, [
        {"id": "1", "campaign_id": "100", "targeting": {"geo_locations": {"countries": ["US", "CA"]},
                                                         "age_min": 18, "genders": [1], "device_platforms": []}},
        {"id": "2", "campaign_id": "999", "targeting": {}},
        {"id": "3", "targeting": {}},
        {"id": "4", "campaign_id": "100", "targeting": {}},
    ], None)])
    staged = spark.createDataFrame([(100,)], "CampaignID long")
    got = {x.AdSetID: x for x in entities.adset(r, staged).collect()}
    assert set(got) == {1, 4}
    x = got[1]
    assert x.TargetingCountries == '["US","CA"]' and x.TargetingAgeMin == 18 and x.TargetingGenders == "[1]"
    assert x.TargetingDevicePlatforms is None and x.AdAccountID == 5 and x.CampaignID == 100
    assert got[4].Targeting is None
    q = entities.adset_quarantine(r, staged).collect()
    assert sorted(x.id for x in q) == ["2", "3"]


def test_ad_lookup_match_wins(spark):
    r = recs(spark, "ad", RAW_AD, [("act_5", 0, [
        {"id": "1", "adset_id": "11", "campaign_id": "7", "creative": {"id": "c1", "name": "n1"}},
        {"id": "2", "adset_id": "12", "campaign_id": "7", "account_id": "act_8", "ad_active_time": "3.7"},
        {"id": "3", "campaign_id": "7", "creative": {"id": "", "name": "none"}},
    ], None)])
    staged = spark.createDataFrame([(11, None, 9)], "AdSetID long, CampaignID long, AdAccountID long")
    got = {x.AdID: x for x in entities.ad(r, staged).collect()}
    assert (got[1].CampaignID, got[1].AdAccountID, got[1].AdSetID) == (None, 9, 11)
    assert (got[2].CampaignID, got[2].AdAccountID, got[2].AdActiveTime) == (7, 8, None)
    assert (got[3].AdSetID, got[3].AdAccountID) == (None, 5)
    cr = entities.creative(r).collect()
    assert [(x.CreativeId, x.CreativeName) for x in cr] == [("c1", "n1")]


def test_page_and_post(spark):
    p = recs(spark, "page", RAW_PAGE, [("42", 0, [{"id": "1", "name": "P", "business": {"id": "7"}},
                                                  {"id": "2", "name": "Q", "is_verified": "true"}], None)])
    got = {x.PageID: x for x in entities.page(p).collect()}
    assert got[1].BusinessID == 7 and got[2].BusinessID == 42 and got[2].IsVerified is True
    s = recs(spark, "post", RAW_POST, [("1", 0, [{"id": "1_9", "created_time": "2026-09-01T00:00:00+0000",
                                                  "is_hidden": False}], None)])
    x = entities.post(s).first()
    assert (x.PostID, x.PageID, x.CreatedTime, x.IsHidden) == ("1_9", 1, dt.datetime(2026, 9, 1), False)


def test_ad_insights_daily(spark):
    r = recs(spark, "ad_insight", RAW_AD_INSIGHT, [("act_5", 0, [
        {"ad_id": "1", "account_id": "act_5", "date_start": "2026-09-01", "impressions": "12.9", "spend": "3.456",
         "actions": [{"action_type": "lead", "value": "3"}, {"action_type": "lead", "value": 2},
                     {"action_type": "click", "value": "9"}],
         "cost_per_action_type": [{"action_type": "lead", "value": "1.5"}]},
        {"ad_id": "1", "date_start": "2026-09-01", "impressions": "1"},
        {"ad_id": "2", "date_start": "20260902", "actions": [{"action_type": "lead", "value": "bad"}]},
        {"date_start": "2026-09-01"},
        {"ad_id": "3", "date_start": "garbage"},
    ], None)])
    got = {(x.AdID, x.DateKey): x for x in entities.ad_insights_daily(r).collect()}
    assert set(got) == {(1, 20260901), (2, 20260902)}
    x = got[(1, 20260901)]
    assert (x.Impressions, float(x.Spend), x.Leads, float(x.CostPerLead), x.AdAccountID) == (12, 3.46, 5, 1.5, 5)
    assert got[(2, 20260902)].Leads is None
    windowed = entities.ad_insights_daily(r, dt.date(2026, 9, 2), dt.date(2026, 9, 3)).collect()
    assert [(x.AdID, x.DateKey) for x in windowed] == [(2, 20260902)]


def test_page_insights_daily(spark):
    r = recs(spark, "page_insight", RAW_PAGE_INSIGHT, [("7", 0, [
        {"name": "page_views_total", "values": [{"end_time": "2026-09-02T07:00:00+0000", "value": 5},
                                                {"end_time": "2026-09-03T07:00:00+0000", "value": {"x": 1}},
                                                {"end_time": "2026-09-04T07:00:00+0000", "value": "8"}]},
    ], None)])
    got = sorted((x.DateKey, x.Value) for x in entities.page_insights_daily(r, dt.date(2026, 9, 1), dt.date(2026, 9, 3)).collect())
    assert [(k, None if v is None else float(v)) for k, v in got] == [(20260901, 5.0), (20260902, None)]


def test_post_insights_pivot(spark):
    act = "post_activity_by_action_type"
    rea = "post_reactions_by_type_total"
    r = recs(spark, "post_insight", RAW_POST_INSIGHT, [
        ("p1", 0, [{"name": rea, "values": [{"value": {"total": 9, "like": 1}}]},
                   {"name": act, "value": {"share": 3, "comment": 2}}], None),
        ("p1", 1, [{"name": act, "values": [{"value": {"comment": 4}}]}], None),
        ("p2", 0, [{"name": rea, "value": {"like": 1, "love": 2}}], None),
        ("p3", 0, [{"name": "unknown_metric", "value": 5}], None),
        ("p4", 0, [{"name": act, "values": [{"value": 1}, {"value": None}], "value": 5}], None),
    ])
    rows = entities.post_metric_rows(r)
    got = {x.PostID: (x.Shares, x.Reactions, x.Comments)
           for x in entities.post_insights_daily(rows, dt.date(2026, 9, 10)).collect()}
    assert got == {"p1": (None, 9, 4), "p2": (None, 3, None), "p3": (None, None, None)}
    one = entities.post_insights_daily(rows, dt.date(2026, 9, 10)).first()
    assert one.DateKey == 20260910 and one.Date == dt.date(2026, 9, 10)


def test_output_schemas_match_registry(spark):
    r = recs(spark, "campaign", RAW_CAMPAIGN, [("act_1", 0, [{"id": "1"}], None)])
    out = entities.campaign(r)
    spec = TABLES["Campaign"]
    assert [f.name for f in out.schema.fields] == [c for c in spec.columns if c != "LoadDate"]
    for f in out.schema.fields:
        assert f.dataType == spec.schema[f.name].dataType, f.name


def test_json_text_string_scalars_are_quoted(spark):
    r = recs(spark, "campaign", RAW_CAMPAIGN, [("act_1", 0, [
        {"id": "1", "pacing_type": "standard", "attribution_spec": 5, "special_ad_categories": ["NONE"]},
        {"id": "2", "pacing_type": ["day_parting"], "special_ad_categories": ""},
    ], None)])
    got = {x.CampaignID: x for x in entities.campaign(r).collect()}
    assert (got[1].PacingType, got[1].AttributionSpec, got[1].SpecialAdCategories) == ('"standard"', "5", '["NONE"]')
    assert (got[2].PacingType, got[2].SpecialAdCategories) == ('["day_parting"]', None)
    a = recs(spark, "adset", RAW_ADSET, [("act_1", 0, [
        {"id": "9", "campaign_id": "1", "targeting": {"genders": "all", "device_platforms": ["mobile"]}}], None)])
    x = entities.adset(a, spark.createDataFrame([(1,)], "CampaignID long")).first()
    assert (x.TargetingGenders, x.TargetingDevicePlatforms) == ('"all"', '["mobile"]')
