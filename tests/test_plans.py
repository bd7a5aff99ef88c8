"""Plan-shape guards for every registered query.

Read from ``explain()`` of each query on sf0.001: no pair-producing joins,
no Python at all,
partial aggregation before every dedup shuffle, and narrow Parquet scans.
"""
import contextlib
import io
import os
import re

import pytest

from tidewater.plans.queries import QUERIES, ROWS_ONLY

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

# the nested-JSON operators (AG-4 leaf sum, SC-9 metric search) and the pivot built on them
ARROW_UDF_ALLOWED: set[str] = set()
DEDUP_QUERIES = {"dedup_first", "dedup_last", "proj_campaign", "proj_adset", "proj_ad", "proj_post",
                 "ad_insights_daily", "page_insights_daily", "metric_last_value"}


def plan_text(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in QUERIES.items():
        if name in ROWS_ONLY:  # pipelines write while being built
            continue
        out[name] = plan_text(fn(spark, SF))
    return out


def test_no_pair_producing_joins(plans):
    bad = {n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p}
    assert not bad


def test_no_row_at_a_time_python(plans):
    assert not {n for n, p in plans.items() if "BatchEvalPython" in p}


def test_arrow_udf_only_for_nested_json(plans):
    assert {n for n, p in plans.items() if "ArrowEvalPython" in p} <= ARROW_UDF_ALLOWED


def test_dedup_reduces_before_the_shuffle(plans):
    """Keep-first / last-wins are grouped aggregates with a partial step: a hot
    key crosses the shuffle as one row per map task."""
    for name in DEDUP_QUERIES:
        assert re.search(r"partial_(min_by|max_by)", plans[name]), name


def _scans(plan: str) -> list[tuple[str, set[str]]]:
    found = re.findall(r"Location: InMemoryFileIndex \[[^\]]*?/(\w+)\.parquet\][\s\S]*?"
                       r"ReadSchema: struct<([^\n]*)>", plan)
    return [(t, set(re.findall(r"(?:^|,)(\w+):", cols))) for t, cols in found]


# (query, table) -> exactly the columns its scan may read
NARROW_SCANS = {
    ("read_ids", "orders"): {"o_custkey"},
    ("half_open_window", "events"): {"event_id", "ts"},
    ("sc_date_key", "orders"): {"o_orderkey", "o_orderdate"},
    ("audit_null_fk", "documents"): {"doc_id"},
    ("all_posts", "orders"): {"o_orderkey", "o_custkey"},
    ("recent_posts_topk", "orders"): {"o_orderkey", "o_orderdate", "o_custkey"},  # FLT-6: PageID not null
}


def test_scans_read_only_needed_columns(plans):
    for (name, table), cols in NARROW_SCANS.items():
        scans = [c for t, c in _scans(plans[name]) if t == table]
        assert scans and all(c <= cols for c in scans), (name, table, scans)


def test_document_text_read_only_where_used(plans):
    """``documents.text`` is the widest column; only queries that build post
    pages from it may read it."""
    readers = {n for n, p in plans.items() for t, c in _scans(p) if t == "documents" and "text" in c}
    assert readers <= {"proj_post", "post_insights_daily", "leaf_sum", "find_metric", "integrity_rejects",
                       "created_lookback"}, readers


def test_window_filters_reach_the_scan(plans):
    """Literal half-open windows are pushed to Parquet as range filters."""
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,[^\]]*LessThan\(ts,", plans["half_open_window"])
    assert re.search(r"PushedFilters: \[[^\]]*(GreaterThanOrEqual|LessThan)\(l_shipdate", plans["backfill_range"])
