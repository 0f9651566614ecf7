from __future__ import annotations

import datetime as dt
import random

from loanmart.operators import incremental as inc
from loanmart.operators import ranking as rk


def test_dense_rank_matches_brute_force_on_a_hot_key(spark):
    rng = random.Random(7)
    rows = [("hot", rng.choice([None, *range(400)])) for _ in range(3000)]
    rows += [(f"k{i % 50}", rng.randrange(20)) for i in range(1000)]
    got = {(r.k, r.v): r["rank"] for r in rk.dense_ranks(
        spark.createDataFrame(rows, "k string, v int"), ["k"], "v").collect()}
    want = {}
    for k in {k for k, _ in rows}:
        values = sorted({v for kk, v in rows if kk == k}, key=lambda v: (v is None, v or 0))
        want.update({(k, v): i + 1 for i, v in enumerate(values)})
    assert got == want


def test_running_total_shares_ties(spark):
    d = dt.date(2024, 1, 1)
    rows = [(1, d, 5), (1, d, 7), (1, d + dt.timedelta(1), None), (1, d + dt.timedelta(2), 1), (2, d, 3)]
    got = sorted(tuple(r) for r in rk.running_total(
        spark.createDataFrame(rows, "a int, day date, v bigint"), ["a"], "day", "v", "t", scale=100).collect())
    assert got == [(1, d, 0.12), (1, d + dt.timedelta(1), 0.12), (1, d + dt.timedelta(2), 0.13), (2, d, 0.03)]


def test_smallest_distinct(spark):
    rows = [(1, 5), (1, 5), (1, 3), (1, 9), (1, 1), (1, None), (2, 4), (2, 4)]
    got = sorted((r.k, r.v, r["rank"], r.n) for r in rk.smallest_distinct(
        spark.createDataFrame(rows, "k int, v int"), ["k"], "v", 3).collect())
    assert got == [(1, 1, 1, 1), (1, 3, 2, 1), (1, 5, 3, 2), (2, 4, 1, 2)]


def test_first_per_group(spark):
    rows = [(1, 10, 1, 5, 100), (1, 10, 2, None, 101), (1, 10, 2, 4, 103), (1, 10, 2, 4, 102), (None, 10, 9, 9, 104),
            (1, 11, None, 1, 105)]
    df = spark.createDataFrame(rows, "day int, client int, a int, b int, id bigint")
    got = sorted(tuple(r) for r in rk.first_per_group(df, ["day", "client"], ["a", "b"], "id").collect())
    assert got == [(1, 10, 102), (1, 11, 105)]


def test_rank_filter_is_pushed_below_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 5 as k", "id as v")
    plan = rk.smallest_distinct(df, ["k"], "v", 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_watermark(spark):
    keys = spark.createDataFrame([("9",), ("10",), ("x",), (None,)], "number string")
    assert inc.high_watermark(keys, "number").first().high == 10
    assert inc.high_watermark(keys.limit(0), "number").first().high is None
    source = spark.range(15).withColumnRenamed("id", "number")
    assert inc.incremental(source, keys, "number").count() == 4
    assert inc.incremental(source, keys.limit(0), "number").count() == 15


def test_backfill(spark):
    parent = spark.createDataFrame([(1, "1"), (2, "0"), (3, "2"), (3, "2"), (4, None)], "number int, qty string")
    child = spark.createDataFrame([(1,), (None,)], "number int")
    got = sorted(r.number for r in inc.backfill(parent, child, "number", parent.qty != "0").collect())
    assert got == [3]
    assert inc.without_keys(parent, child, "number").count() == 4
    assert inc.only_keys(parent, child, "number").count() == 1


def test_once_per_key(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "c", 1)], "k int, a string, b int")
    assert sorted(tuple(r) for r in inc.once_per_key(df, ["k"], "a").collect()) == [(1, "a", 9), (2, "c", 1)]
