"""Every registered query vs its DuckDB oracle on sf0.001 (the driver runs the same at sf0.01)."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_rows_only():
    from tidewater.plans.queries import QUERIES, ROWS_ONLY
    missing = set(QUERIES) - set(E.oracle_sql()) - set(ROWS_ONLY)
    assert not missing


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["CampaignID", "AdAccountID", "Objective", "Status", "DailyBudget", "UpdatedTime"]


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
