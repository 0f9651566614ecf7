from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from loanmart.contracts import ENTITIES, read_contract
from loanmart.operators import documents
from loanmart.operators.documents import (
    any_element,
    conform,
    discover_paths,
    drop_nested,
    flatten_paths,
    flatten_prefix,
    json_path,
    key_search,
    one_or_many,
    path_exists,
    path_values,
    unnest,
    unnest_rejects,
)
from loanmart.plans.bureau import cache_ids, created_between, hints
from loanmart.session import settled


def docs(spark, *trees, raw=False):
    rows = [(f"id{i}", i, t if raw else json.dumps(t, ensure_ascii=False)) for i, t in enumerate(trees)]
    return spark.createDataFrame(rows, "_id string, number bigint, doc string")


def at(path, value):
    for p in reversed(path.split(".")):
        value = {p: value}
    return value


PER_LOAN = ("collaterals", "guarantors", "payments", "monthly_detail")


@pytest.mark.parametrize("name", PER_LOAN)
def test_container_shapes(spark, name):
    e = ENTITIES[name]
    wrapper, child = e.nested
    field = [c for c in e.columns if c not in e.parents and c not in e.carry and c not in e.rename][0]
    a, b = {field: "a"}, {field: "b"}
    shapes = [None, "", [], {}, {child: a}, {child: [a, b]}, [{child: a}], [{child: [a, b]}], [{child: a}, {child: b}],
              {child: None}, {child: ""}]
    loans = [{"uuid": "none"}] + [{"uuid": f"u{i}", wrapper: s} for i, s in enumerate(shapes)]
    tree = {"request": {"clientId": 5}, **at(e.path, loans)}
    uuid = "uuid_loan" if name == "guarantors" else "uuid"
    rows = unnest(docs(spark, tree), e)
    assert rows.columns == list(e.columns)
    got = sorted((r[uuid], r[field]) for r in rows.collect())
    assert got == [("u4", "a"), ("u5", "a"), ("u5", "b"), ("u6", "a"), ("u7", "a"), ("u7", "b"), ("u8", "a"),
                   ("u8", "b")]
    assert {r.client_id for r in rows.collect()} == {"5"}


def test_one_object_or_list(spark):
    e = ENTITIES["contracts"]
    path = e.path
    rows = unnest(docs(
        spark, at(path, {"contract_id": 1, "org": "x", "extra": 1}), at(path, [{"contract_id": "2"}, {"contract_id": 3}]),
        at(path, None), at(path, ""), at(path, []), {}, at(path, {}), {"data": "text"},
    ), e)
    assert rows.columns == list(e.output)
    got = sorted((r.number, r["_id"], r.contract_id) for r in rows.collect() if r.contract_id)
    assert got == [(0, "id0", "1"), (1, "id1", "2"), (1, "id1", "3")]
    # an empty object is a row without values
    assert [r.number for r in rows.where("contract_id is null").collect()] == [6]


def test_child_wins_on_a_name_clash(spark):
    e = ENTITIES["contracts"]
    r = unnest(docs(spark, at(e.path, {"_id": "own", "number": 77, "org": "o"})), e).first()
    assert (r["_id"], r.number, r.org) == ("own", 77, "o")


def test_two_levels_carry_the_outer_key(spark):
    e = ENTITIES["overdue_principals"]
    tree = at(e.path, [
        {"contract_id": "a", "overdue_principals": {"overdue_principal": {"overdue_principal_sum": 1}}},
        {"contract_id": "b", "overdue_principals": {"overdue_principal": [{"overdue_principal_sum": 2},
                                                                         {"overdue_principal_sum": 3}]}},
        {"contract_id": "c"}, {"contract_id": "d", "overdue_principals": ""},
    ])
    got = sorted((r.contract_id, r.overdue_principal_sum) for r in unnest(docs(spark, tree), e).collect())
    assert got == [("a", "1"), ("b", "2"), ("b", "3")]


def test_promoted_siblings(spark):
    e = ENTITIES["results_errors"]
    tree = {"request": {"clientId": 9},
            **at("data.katm_077.result", {"is_ok": "false", "hint": "Нет", "error": {"errmsg": "e"}})}
    r = unnest(docs(spark, tree), e).first()
    assert (r.clientId, r.is_ok, r.hint, r.errmsg, r["_id"]) == ("9", "false", "Нет", "e", None)


def test_rejects(spark):
    e = ENTITIES["contracts"]
    good = json.dumps(at(e.path, [{"contract_id": 1}]))
    bad = unnest_rejects(docs(spark, good, "{broken", json.dumps(at(e.path, "text")), json.dumps(at(e.path, [1, 2])),
                              json.dumps(at(e.path, "")), "{}", raw=True), e)
    assert sorted((r.number, r.reason) for r in bad.collect()) == [
        (1, "malformed document"), (2, "unreadable child"), (3, "unreadable child"), (3, "unreadable child")]


def test_paths(spark):
    df = docs(spark, {"a": {"077": {"b": 1}}}, {"a": {"077": {"b": None}}}, {"a": "x"}, {"a": {"077": {"b": {"c": 2}}}})
    got = df.select(json_path("doc", "a.077.b").alias("v"), path_exists("doc", "a.077.b").alias("e"), "number")
    assert [(r.v, r.e) for r in got.orderBy("number").collect()] == [
        ("1", True), (None, True), (None, False), ('{"c":2}', True)]


def test_element_test(spark):
    df = docs(spark, {"c": [{"d": "2024-01-01"}, {"d": "2020-01-01"}]}, {"c": {"d": "2019-01-01"}}, {"c": ""}, {})
    late = any_element(json_path("doc", "c"), ["d"], lambda x: x["d"] >= "2021-01-01")
    assert [r[0] for r in df.select(late).collect()] == [True, False, False, False]


def test_conform(spark):
    df = spark.createDataFrame([(1, "x", [1, 2], 2.5)], "b int, a string, l array<int>, extra double")
    out = conform(df, ["a", "missing", "l"], ["_id", "number"])
    assert out.columns == ["a", "missing", "l", "_id", "number"]
    assert tuple(out.first()) == ("x", None, "[1,2]", None, None)
    assert dict(out.dtypes)["number"] == "bigint"
    assert conform(df.limit(0), ["a"]).count() == 0


def test_flatten_and_drop(spark):
    df = spark.sql("select 1 as k, named_struct('x', 1, 'y', named_struct('z', 'q')) as s, array(1, 2) as l, "
                   "cast(null as struct<w:int>) as n")
    assert drop_nested(df).columns == ["k"]
    out = flatten_prefix(df)
    assert out.columns == ["k", "l", "s_x", "s_y.z", "n_w"]
    assert tuple(out.first()) == (1, "1, 2", 1, "q", None)


def test_flatten_keeps_rows_together(spark):
    df = spark.createDataFrame([(1, None), (2, ("b",)), (3, None), (4, ("d",))], "k int, s struct<v:string>")
    got = [tuple(r) for r in flatten_prefix(df).orderBy("k").collect()]
    assert got == [(1, None), (2, "b"), (3, None), (4, "d")]


def test_flatten_paths(spark):
    df = docs(spark, {"a": {"b": 1, "c": [1, {"x": 2}]}, "d": "t"}, {"a": {"e": {"f": True}}, "d": None})
    assert sorted(discover_paths(df)) == ["a.b", "a.c", "a.e.f", "d"]
    wide = flatten_paths(df, ["number"])
    rows = {r.number: r for r in wide.collect()}
    assert rows[0]["a.b"] == "1" and json.loads(rows[0]["a.c"]) == [1, {"x": 2}] and rows[0]["a.e.f"] is None
    assert rows[1]["a.e.f"] == "true"
    got = sorted((r.number, r.path) for r in path_values(df, ["number"]).collect())
    assert got == [(0, "a.b"), (0, "a.c"), (0, "d"), (1, "a.e.f")]


def brute_search(tree, key):
    out = []
    if isinstance(tree, dict):
        for k, v in tree.items():
            if k == key:
                out += [o for o in (v if isinstance(v, list) else [v]) if isinstance(o, dict)]
            else:
                out += brute_search(v, key)
    elif isinstance(tree, list):
        for x in tree:
            out += brute_search(x, key)
    return out


def test_key_search(spark):
    deep = {"hit": {"v": "deep"}}
    for _ in range(40):
        deep = {"n": [deep]}
    trees = [
        {"hit": {"v": 1, "inner": {"hit": {"v": "no"}}, "l": [1]}},
        {"a": [{"hit": [{"v": "x"}, 5, {"v": "y", "hit": {"v": "no"}}]}]},
        {"hit": "scalar", "b": {"hit": None}},
        deep,
        {"other": 1},
    ]
    got = sorted((r.number, r.v) for r in key_search(docs(spark, *trees), "hit", ["v"], ["number"]).collect())
    want = sorted((i, str(o["v"])) for i, t in enumerate(trees) for o in brute_search(t, "hit"))
    assert got == want == [(0, "1"), (1, "x"), (1, "y"), (3, "deep")]


def test_descent_carries_only_what_can_hold_more(spark, monkeypatch):
    written = []
    monkeypatch.setattr(documents, "settled", lambda df, name: written.append(kept := settled(df, name)) or kept)
    tree = {"a": {"b": {"c": {"d": {"e": {"f": {"g": {"w": "x" * 99, "hit": {"v": 1}, **{f"k{i}": i for i in range(20)}}}}}}}}}
    df = docs(spark, tree, {"a": 1}).withColumnsRenamed({"number": "key", "_id": "value"})
    got = [tuple(r) for r in key_search(df, "hit", ["v"], ["key", "value"]).collect()]
    # atoms at the last level opened together are not taken up again
    assert got == [(0, "id0", "1")] and [w.count() for w in written] == [1]
    assert path_values(df, ["key"]).where("path = 'a.b.c.d.e.f.g.k7'").collect() == [(0, "a.b.c.d.e.f.g.k7", "7")]


def test_derived_text_is_made_once(spark):
    made = docs(spark, {"hit": {"v": 1}}).repartition("number").selectExpr("number", "concat(upper(doc), lower(doc)) as doc")
    jobs = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(documents, "settled", lambda df, name: jobs.append(df._jdf.queryExecution().optimizedPlan().toString()) or settled(df, name))
        key_search(made, "hit", ["v"]).collect()
    assert jobs[0].count("upper(") == 1


def test_row_count_is_the_sum_of_children(spark):
    trees = [at("c", [{"x": i} for i in range(n)]) for n in (0, 1, 2, 5, 9)]
    rows = docs(spark, *trees).select(F.explode(one_or_many(json_path("doc", "c"), ["x"])))
    assert rows.count() == 17


def test_small_tables(spark):
    df = docs(spark, {"data": {"katm_077": {"result": {"hint": "h"}}}, "credit": {"katm_cache_id": "c1"}},
              {"data": {"katm_077": {"result": {}}}, "credit": {"katm_cache_id": None}}, {})
    assert [tuple(r) for r in hints(df.withColumn("created", F.lit("2024-01-01").cast("timestamp"))).collect()] == [
        (0, "h"), (1, None)]
    assert [tuple(r) for r in cache_ids(df).collect()] == [(0, "c1")]


def test_both_time_bounds_act(spark):
    df = spark.sql("select timestamp'2023-06-01 00:00:00' as time union all select timestamp'2022-06-01 00:00:00' "
                   "union all select timestamp'2024-06-01 00:00:00'")
    assert created_between(df, "2023-01-01", "2024-01-01", "time").count() == 1


def test_contract_file(spark, tmp_path):
    (tmp_path / "c.txt").write_text("_id\nnumber\nname \n\n")
    assert read_contract(spark, str(tmp_path / "c.txt")) == ("_id", "number", "name")


def test_no_python_in_built_in_plans(spark):
    plan = unnest(docs(spark, {}), ENTITIES["payments"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
