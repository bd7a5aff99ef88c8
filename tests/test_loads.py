"""Load modes (SNK-1/3/4/6) and their invariants."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.operators import loads
from tidewater.schemas import TABLES


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")


def test_upsert_overwrites_inserts_and_is_idempotent(spark, target):
    batch = spark.createDataFrame([(2, None, "z"), (3, "c", "q")], "k int, v string, w string")
    once = loads.upsert(target, batch, ["k"])
    assert rows(once) == rows(spark.createDataFrame([(1, "a", "x"), (2, None, "z"), (3, "c", "q")],
                                                    "k int, v string, w string"))
    assert rows(loads.upsert(once, batch, ["k"])) == rows(once)


def test_upsert_empty_batch_noop(spark, target):
    empty = spark.createDataFrame([], "k int, v string, w string")
    assert rows(loads.upsert(target, empty, ["k"])) == rows(target)


def test_upsert_partial_carries_missing_columns(spark, target):
    batch = spark.createDataFrame([(1, None), (9, "n")], "k int, v string")
    got = rows(loads.upsert(target, batch, ["k"]))
    assert got == rows(spark.createDataFrame([(1, None, "x"), (2, "b", "y"), (9, "n", None)],
                                             "k int, v string, w string"))


def test_upsert_last_wins_in_batch(spark, target):
    batch = spark.createDataFrame([(5, "first", "1", 0), (5, "second", "2", 1)], "k int, v string, w string, seq int")
    got = loads.upsert(target, batch, ["k"], order=["seq"])
    assert rows(got.where("k = 5")) == [(5, "second", "2")]


def test_upsert_metrics(spark, target):
    batch = spark.createDataFrame([(2, "b", "y"), (3, "c", "q")], "k int, v string, w string")
    assert tuple(loads.upsert_metrics(target, batch, ["k"]).first()) == (2, 1, 1)


def test_insert_only_conflicts(spark, target):
    batch = spark.createDataFrame([(2, "new", "n"), (4, "d", "e")], "k int, v string, w string")
    with pytest.raises(Exception, match="already present"):
        loads.insert_only(target, batch, ["k"]).collect()
    got = rows(loads.insert_only(target, batch, ["k"], on_conflict="ignore"))
    assert got == rows(spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (4, "d", "e")],
                                             "k int, v string, w string"))


def test_replace_window(spark):
    d = dt.date
    target = spark.createDataFrame([(1, d(2026, 9, 1), 1.0), (2, d(2026, 9, 2), 2.0), (3, d(2026, 8, 1), 3.0)],
                                   "k int, day date, v double")
    batch = spark.createDataFrame([(1, d(2026, 9, 1), 10.0)], "k int, day date, v double")
    got = rows(loads.replace_window(target, batch, ["k"], "day", d(2026, 9, 1), d(2026, 9, 3)))
    assert got == rows(spark.createDataFrame([(1, d(2026, 9, 1), 10.0), (3, d(2026, 8, 1), 3.0)],
                                             "k int, day date, v double"))
    empty = batch.limit(0)
    assert rows(loads.replace_window(target, empty, ["k"], "day", d(2026, 9, 1), d(2026, 9, 3))) == rows(target)


def test_integrity_split(spark):
    spec = TABLES["Creative"]
    batch = spark.createDataFrame([("1", "ok"), (None, "n"), ("3", "x" * 300)], "CreativeId string, CreativeName string")
    ok, rejects = loads.split_integrity(batch, spec)
    assert ok.count() + rejects.count() == batch.count()
    assert rows(rejects, "CreativeId", "reason") == sorted([(None, "null_key:CreativeId"), ("3", "text_too_long")], key=str)


def test_stamp_load_date(spark, target):
    ts = dt.datetime(2026, 9, 1, 12)
    out = loads.stamp_load_date(target, ts)
    assert {r.LoadDate for r in out.collect()} == {ts}


def test_integrity_duplicate_keys(spark):
    spec = TABLES["Creative"]
    batch = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c")], "CreativeId string, CreativeName string")
    ok, rejects = loads.split_integrity(batch, spec, check_unique=True)
    assert rows(ok, "CreativeId") == [("2",)]
    assert rows(rejects, "CreativeId", "reason") == [("1", "duplicate_key"), ("1", "duplicate_key")]
