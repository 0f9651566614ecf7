from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loanmart.operators.merge import reject_split, typed, union_by_name, upsert
from loanmart.plans.default_days import refresh

SCHEMA = "k int, a string, b int"


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_update_insert_and_null(spark):
    t = frame(spark, (1, "x", 1), (2, "y", 2), (3, "z", 3))
    s = frame(spark, (2, None, 20), (9, "n", None))
    assert rows(upsert(t, s, ["k"])) == [(1, "x", 1), (2, None, 20), (3, "z", 3), (9, "n", None)]
    assert rows(upsert(t, s, ["k"], ["b"])) == [(1, "x", 1), (2, "y", 20), (3, "z", 3), (9, "n", None)]


def test_null_keys_match_nothing(spark):
    t = frame(spark, (None, "x", 1))
    s = frame(spark, (None, "p", 2), (None, "q", 3))
    assert rows(upsert(t, s, ["k"])) == [(None, "p", 2), (None, "q", 3), (None, "x", 1)]


def test_duplicate_source_key_is_an_error(spark):
    t, s = frame(spark, (1, "x", 1)), frame(spark, (1, "p", 2), (1, "p", 2))
    with pytest.raises(Exception, match="duplicate source key"):
        upsert(t, s, ["k"]).collect()
    with pytest.raises(Exception, match="duplicate source key"):
        upsert(t, frame(spark, (5, "p", 2), (5, "q", 2)), ["k"]).collect()


def test_upsert_is_idempotent(spark):
    rng = random.Random(3)
    t = frame(spark, *[(i, rng.choice("abc"), rng.randrange(9)) for i in range(0, 60, 2)])
    s = frame(spark, *[(i, rng.choice(["d", None]), rng.randrange(9)) for i in range(0, 60, 3)])
    once = upsert(t, s, ["k"])
    assert rows(upsert(once, s, ["k"])) == rows(once)
    by_hand = {r[0]: r for r in rows(t)} | {r[0]: r for r in rows(s)}
    assert rows(once) == sorted(by_hand.values(), key=repr)


def test_composite_key(spark):
    t, s = frame(spark, (1, "x", 1), (1, "y", 2)), frame(spark, (1, "y", 5), (2, "x", 6))
    assert rows(upsert(t, s, ["k", "a"])) == [(1, "x", 1), (1, "y", 5), (2, "x", 6)]


def test_refresh_stamps_and_keeps_other_columns(spark):
    schema = "date_vyd_d date, glob_id bigint, k_vid_cred int, fpd int, spd int, tpd int"
    new = spark.sql("select date'2024-01-01' d, 1L g, 24 k, 7 f, 0 s, 0 t union all "
                    "select date'2024-02-01', 2L, 34, 8, 0, 0").toDF(*[c.split()[0] for c in schema.split(", ")])
    old = spark.sql("select date'2020-01-01' d, 1L g, 11 k, 1 f, 1 s, 1 t, 'old' m").toDF(*new.columns, "date_modified")
    got = {r.glob_id: r for r in refresh(old, new, "2024-03-01").collect()}
    assert str(got[1].date_vyd_d) == "2020-01-01" and got[1].k_vid_cred == 11
    assert (got[1].fpd, got[1].spd, got[1].date_modified) == (7, 0, "2024-03-01")
    assert got[2].fpd == 8 and got[2].date_modified == "2024-03-01"


def test_reject_split(spark):
    df = frame(spark, (1, "x", 1), (2, None, 2), (None, None, 3))
    good, bad = reject_split(df, {"a": F.col("a").isNotNull(), "k": F.col("k") > 0})
    assert rows(good) == [(1, "x", 1)]
    assert sorted(r.reason for r in bad.collect()) == ["a", "a, k"]


def test_typed(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), (None, None), ("x", "2024-01-01")], "n string, d string")
    good, bad = typed(df, {"n": "int", "d": "date"})
    assert dict(good.dtypes) == {"n": "int", "d": "date"} and good.count() == 2
    assert bad.first().reason == "n is no int"


def test_union_by_name(spark):
    a, b = spark.sql("select 1 x, 2 y"), spark.sql("select 3 y, 4 z")
    assert rows(union_by_name(a, b)) == [(1, 2, None), (None, 3, 4)]
