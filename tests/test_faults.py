"""Documents, tables and loads that are half bad: nothing is lost silently."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from loanmart.contracts import ENTITIES
from loanmart.functions.scalars import parse_timestamp
from loanmart.operators.documents import any_element, discover_paths, flatten_paths, json_path, key_search, key_search_rejects, path_exists, unnest_split
from loanmart.operators.incremental import incremental
from loanmart.operators.merge import upsert
from loanmart.operators.temporal import balance_on, days_past_due
from loanmart.plans.applications import applications
from loanmart.session import base_dir, settled, staging
from loanmart.sources.readers import read_docs
from loanmart.sources.writers import create_table, truncate
from tests.test_documents import docs


def at(path, value):
    for p in reversed(path.split(".")):
        value = {p: value}
    return value


@pytest.mark.parametrize("value,ids,bad", [
    ([{"contract_id": "1"}, 5], ["1"], ["5"]), ([{"contract_id": "1"}, "x", {"contract_id": "2"}], ["1", "2"], ["x"]),
    ([{"contract_id": "1"}, None], ["1"], ["null"]), ({"contract_id": "1"}, ["1"], []), ([], [], []), (None, [], []), ([[1]], [], ["[1]"]), (7, [], ["7"]),
])
def test_every_element_is_a_row_or_a_reject(spark, value, ids, bad):
    e = ENTITIES["contracts"]
    rows, rejects = unnest_split(docs(spark, at(e.path, value)), e)
    assert sorted(r.contract_id for r in rows.collect()) == ids
    assert sorted(r.raw for r in rejects.collect()) == bad


def test_both_levels_account_for_all(spark):
    e = next(x for x in ENTITIES.values() if x.nested)
    wrapper, child = e.nested
    tree = at(e.path, [{wrapper: [{child: [{}, 3]}, "w"]}, {wrapper: {child: {}}}, 9, {wrapper: 4}])
    rows, rejects = unnest_split(docs(spark, tree), e)
    assert rows.count() == 2
    assert sorted((r.reason, r.raw) for r in rejects.collect()) == [
        ("unreadable child", "3"), ("unreadable child", "9"), ("unreadable wrapper", "4"), ("unreadable wrapper", "w")]


def test_any_element_passes_over_bad_ones(spark):
    df = docs(spark, {"c": [{"d": "2024-01-01"}, 5]}, {"c": [5]}, {"c": None})
    late = any_element(json_path("doc", "c"), ["d"], lambda x: x["d"] >= "2021-01-01")
    assert [r[0] for r in df.orderBy("number").select(late).collect()] == [True, False, False]


def test_keys_with_dots_repeated_keys_and_escapes(spark):
    df = docs(spark, '{"a.b":"x","c":{"d":"y"},"a":{"b":"z"}}', raw=True)
    assert sorted(discover_paths(df)) == ["`a.b`", "a.b", "c.d"]
    r = flatten_paths(df).first().asDict()
    assert r == {"`a.b`": "x", "a.b": "z", "c.d": "y"}
    twice = docs(spark, '{"a":{"k":1,"k":2}}', '{"a":{"k":null}}', '{"a":{"j":1}}', "{bad", raw=True)
    assert [x[0] for x in twice.orderBy("number").select(path_exists("doc", "a.k")).collect()] == [True, True, False, False]
    deep = "[" * 20_000 + '{"ключ":{"v":9}}' + "]" * 20_000
    found = docs(spark, '{"ключ":{"v":1}}', '{"\\u043a\\u043b\\u044e\\u0447":{"v":2}}', deep, '{"x":1}', raw=True)
    assert sorted((x.number, x.v) for x in key_search(found, "ключ", ["v"], ["number"]).collect()) == [(0, "1"), (1, "2")]
    assert [x.number for x in key_search_rejects(found, "ключ", ["number"]).collect()] == [2]


def test_extended_json_feeds_the_mart(spark, tmp_path):
    body = {"request": {"clientId": "7", "amount": 100}, "asbt": {"status": 1}, "result": {"is_ok": True}}
    lines = [
        {"_id": {"$oid": "ab"}, "number": {"$numberLong": "5"}, "created": {"$date": "2024-01-01T10:00:00.000Z"}, **body},
        {"_id": "c", "number": 6, "created": "2024-01-01T15:00:00.000+05:00", **body},
        {"_id": "d", "number": 7, "created": "2024-01-01 10:00:00.000", **body},
    ]
    path = tmp_path / "x.json"
    path.write_text("\n".join(json.dumps(x) for x in lines))
    read = read_docs(spark, str(path), "json")
    assert sorted((r._id, r.number, r.created) for r in read.collect()) == [(i, n, dt.datetime(2024, 1, 1, 10)) for i, n in (("ab", 5), ("c", 6), ("d", 7))]
    got = applications(read, above=0).collect()
    assert {(r.app_id, str(r.app_dt)) for r in got} == {(n, "2024-01-01 15:00:00") for n in (5, 6, 7)} and sum(r.unique_flag for r in got) == 1


def test_timestamps_with_zones(spark):
    texts = ["2024-01-01 10:00:00", "2024-01-01T10:00:00.5", "2024-01-01T10:00:00Z", "2024-01-01T15:00:00+0500", "2024-01-01", "x", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(parse_timestamp("t").cast("string")).collect()
    assert [r[0] for r in got] == ["2024-01-01 10:00:00", "2024-01-01 10:00:00.5", "2024-01-01 10:00:00", "2024-01-01 10:00:00", None, None, None]


def test_truncate_under_dynamic_overwrite(spark, tmp_path):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        spark.sql("drop table if exists parted")
        spark.sql(f"create table parted (a int, p int) using parquet partitioned by (p) location '{tmp_path}/t'")
        spark.sql("insert into parted values (1, 1), (2, 2)")
        truncate(spark, "parted")
        assert spark.read.table("parted").count() == 0 and spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"
    finally:
        spark.sql("drop table if exists parted")
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    create_table(spark, "plain_one", ["a", "b"], f"{tmp_path}/p", replace=True)
    truncate(spark, "plain_one")
    spark.sql("drop table plain_one")


def test_ties_do_not_depend_on_order(spark):
    day = [dt.date(2024, 1, i) for i in (1, 9)]
    rows = [("m", "a", day[0], day[1], 700), ("m", "a", day[0], day[1], 100)]
    schema = "id_mfo string, account string, dati date, datn date, saldo long"
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, schema).coalesce(1)
        assert [r.balance for r in balance_on(df, "2024-01-05").collect()] == [7.0]
        assert [r.dpd for r in days_past_due(df, "2024-01-05").collect()] == [4]


def test_text_keys_compare_as_numbers(spark):
    source = spark.createDataFrame([("1,200",), ("900",), ("30",)], "k string")
    assert incremental(source, spark.createDataFrame([("100",)], "k string"), "k").count() == 2


def test_upsert_reads_each_side_once(spark, tmp_path):
    spark.range(20).selectExpr("id", "'a' as v", "1 as w").write.parquet(f"{tmp_path}/t")
    spark.sql("select 5L id, 'b' v, 2 w union all select 50L, 'c', 2 union all select null, 'n', 2 union all select null, 'n', 2").write.parquet(f"{tmp_path}/s")
    t, s = (spark.read.parquet(f"{tmp_path}/{x}") for x in "ts")
    got = upsert(t, s, ["id"], ["v"])
    rows = {(r.id, r.v, r.w) for r in got.collect()}
    assert got.count() == 23 and {(5, "b", 1), (50, "c", 2), (None, "n", 2), (1, "a", 1)} <= rows
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2


def test_staged_tables_go(spark, tmp_path, monkeypatch):
    import os

    from loanmart import session

    monkeypatch.setattr(session, "base_dir", lambda *_: str(tmp_path / "stage"))
    with staging(spark):
        assert settled(spark.range(3), "x").count() == 3 and len(os.listdir(tmp_path / "stage")) == 1
    assert os.listdir(tmp_path / "stage") == []


def test_clusters_need_a_shared_folder():
    assert base_dir("s3a://b/x/", "yarn") == "s3a://b/x" and base_dir(None, "local[8]")
    with pytest.raises(RuntimeError):
        base_dir(None, "local-cluster[3,2,1000]")
