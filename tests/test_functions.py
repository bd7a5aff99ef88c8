"""Scalar and in-row metric rules (SC-*, AG-3, AG-4, SRC-8) on the edge cases of FIXTURES §3."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions import coerce as C
from tidewater.functions.metrics import action_sum, find_metric, leaf_sum
from tidewater.sources.landing import last_metric_value


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_bare_account_id(spark):
    assert col_values(spark, ["act_1", "1", "act_1act_2", None], C.bare_account_id) == ["1", "1", "1act_2", None]


def test_as_datetime(spark):
    got = col_values(spark, ["2026-08-01T10:00:00+0300", "20260801", "garbage", "", None,
                             "2026-08-01T10:00:00+0000", "2026-08-01"], C.as_datetime)
    assert got == [dt.datetime(2026, 8, 1, 7), dt.datetime(1970, 8, 23, 12, 0, 1), None, None, None,
                   dt.datetime(2026, 8, 1, 10), dt.datetime(2026, 8, 1)]


def test_as_int(spark):
    assert col_values(spark, ["12", "3.7", "", "x", None, "99999999999"], C.as_int) == [12, None, None, None, None, None]


def test_as_number(spark):
    assert col_values(spark, ["1e3", "nan", "12d", "x", '{"a":1}', "2.5", None], C.as_number) == [
        1000.0, None, None, None, None, 2.5, None]


def test_as_json_text(spark):
    assert col_values(spark, ["[]", "{}", "", None, "0", '["standard"]', '{"z":1,"a":[1,2.0]}'],
                      C.as_json_text) == [None, None, None, None, "0", '["standard"]', '{"z":1,"a":[1,2.0]}']


def test_json_text_keeps_source_order_through_from_json(spark):
    df = spark.createDataFrame([('{"t": {"z": 1, "a": [1, 2.0]}}',)], "j string")
    got = df.select(F.from_json("j", "t string")["t"]).first()[0]
    assert got == '{"z":1,"a":[1,2.0]}'


def test_as_date(spark):
    assert col_values(spark, ["20260801", "2026-09-02T01:00:00+0300", "garbage", None], C.as_date) == [
        dt.date(2026, 8, 1), dt.date(2026, 9, 1), None, None]


def test_date_key(spark):
    assert col_values(spark, [dt.date(2026, 8, 1), None], C.date_key, "date") == [20260801, None]


def test_truthy_or(spark):
    df = spark.createDataFrame([("", "b"), (None, "b"), ("0", "b")], "a string, b string")
    assert [r[0] for r in df.select(C.truthy_or("a", "b")).collect()] == ["b", "b", "0"]


def test_find_metric(spark):
    names = ("share", "shares")
    got = col_values(spark, ['{"x":{"share":3}}', '{"share":"bad","y":[{"shares":2}]}', "{}", None,
                             '{"comment":1,"share":4}', '{"share":true}', "7"], lambda c: find_metric(c, names))
    assert got == [3.0, 2.0, None, None, 4.0, 1.0, None]


def test_leaf_sum(spark):
    got = col_values(spark, ['{"like":1,"x":[{"love":2}],"n":"3"}', "{}", '"x"', '{"like":1,"love":2}', "5",
                             None], leaf_sum)
    assert got == [6.0, None, None, 3.0, 5.0, None]


def test_action_sum(spark):
    schema = "i int, a array<struct<action_type:string,value:string>>"
    rows = [(0, [("lead", "3"), ("lead", "2"), ("click", "9")]), (1, [("lead", "bad")]), (2, None),
            (3, [("click", "1")]), (4, [("lead", "nan"), ("lead", "1")])]
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.orderBy("i").select(action_sum("a", ["lead"])).collect()]
    assert got == [5.0, None, None, None, None]


def test_last_metric_value(spark):
    rows = [(0, [("1",), (None,)], "5"), (1, [], "5"), (2, None, "6"), (3, [("7",)], None)]
    df = spark.createDataFrame(rows, "i int, vals array<struct<value:string>>, value string")
    got = [r[0] for r in df.orderBy("i").select(last_metric_value("vals", "value")).collect()]
    assert got == [None, "5", "6", "7"]


def test_nested_metrics_equal_the_python_rule(spark):
    """Random nested values, escapes, booleans, sums and integers beyond a double, sixty levels: against a plain walk."""
    import json
    import math
    import random

    def number(v):
        try:
            return None if v is None or isinstance(v, (dict, list)) else float(v)
        except ValueError:
            return None
        except OverflowError:
            return math.inf

    def total(v):
        if isinstance(v, (dict, list)):
            found = [x for x in map(total, v.values() if isinstance(v, dict) else v) if x is not None]
            return sum(found) if found else None
        return number(v)

    def first(v, names):
        for k, child in v.items() if isinstance(v, dict) else [(None, x) for x in v] if isinstance(v, list) else []:
            got = number(child) if k in names else None
            got = first(child, names) if got is None else got
            if got is not None:
                return got
        return None

    rnd = random.Random(3)

    def value(depth):
        r = rnd.random()
        if depth and r < 0.3:
            return {rnd.choice(["a", "share", "x y", 'q"u', "k:", "é", "\\"]) + rnd.choice(["", "1"]): value(depth - 1) for _ in range(rnd.randint(0, 4))}
        if depth and r < 0.5:
            return [value(depth - 1) for _ in range(rnd.randint(0, 4))]
        return rnd.choice([1, 2.5, -3, "7", "x", "tr:ue", "true", "", None, True, False, 'a"b', "a\\", "1e3", 10**30, "[1]", '{"share":5}', "share"])

    deep = 5
    for _ in range(60):
        deep = {"a": [deep, 1]}
    values = [value(4) for _ in range(1500)] + [deep, {"a": [1e308, 1e308]}, {"a": [10**400]}, {"share": [1], "b": {"share": 2}}]
    texts = [json.dumps(v, ensure_ascii=rnd.random() < 0.5, separators=rnd.choice([(",", ":"), (", ", " : ")])) for v in values]
    junk = ["", "abc", "{", "[1,", "nope]", None]
    df = spark.createDataFrame(list(enumerate(texts + junk)), "i int, t string")
    got = {r.i: (r.s, r.f) for r in df.select("i", leaf_sum("t").alias("s"), find_metric("t", ["share", "a1"]).alias("f")).collect()}
    for i, v in enumerate(values):
        for a, b in zip(got[i], (total(v), first(v, {"share", "a1"}))):
            assert a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-12)), texts[i]
    assert all(got[len(texts) + k] == (None, None) for k in range(len(junk)))
