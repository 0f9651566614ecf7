"""Document operators and every bureau table."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanmart import fixture_docs as fd
from loanmart import fixtures as fx
from loanmart.contracts import ENTITIES, HINT_PATH, REPORT_077, RESULT_077
from loanmart.fixture_docs import FIELDS, text
from loanmart.operators.documents import (
    any_element,
    conform,
    drop_nested,
    flatten_prefix,
    json_path,
    key_search,
    path_exists,
    path_values,
)
from loanmart.operators.merge import union_by_name
from loanmart.plans.bureau import bureau_table, bureau_tables, cache_ids, created_between, hints, id_map, missing_rows, new_rows
from loanmart.queries.base import query

CLIENT = "request.clientId"
IS_OK = f"{RESULT_077}.is_ok"
CONTRACT = f"{REPORT_077}.contracts.contract"

# What the parent columns must hold, as oracle expressions.
PARENTS = {
    "_id": text("k"), "number": "k", "clientId": text("o_custkey"), "client_id": text("o_custkey"),
    "id": text("o_custkey"), "is_ok": fd.IS_OK_TEXT, "hint": fd.HINT,
    "contract_id": FIELDS["contracts"]["contract_id"], "uuid": FIELDS["general_cbr_loans"]["uuid"],
    "uuid_loan": FIELDS["general_cbr_loans"]["uuid"],
}

# Entities that share their documents' children with another entity.
SOURCE = {f"{n}_offline": n for n in ("contracts", "open_contracts", "contingent_liabilities", "overview",
                                      "overdue_principals", "overdue_procents")}


def entity_rows(spark, sf_dir, name):
    e = ENTITIES[name]
    source = SOURCE.get(name, name)
    inside = {p for p in e.parents.values() if "." in p}
    docs = fd.docs(spark, sf_dir, source, values=fd.pick(*sorted(inside)), cached=name in SOURCE)
    return bureau_table(docs, name)


def entity_sql(name: str) -> str:
    e = ENTITIES[name]
    fixed = {c: PARENTS[c] for c in (*e.parents, *e.carry)}
    if "number" in e.output and "number" not in fixed:
        fixed["number"] = "cast(null as bigint)"
    return fd.oracle_entity(name, fixed, SOURCE.get(name))


def _register(query_name: str, name: str) -> None:
    query(query_name, entity_sql(name))(lambda spark, sf_dir: entity_rows(spark, sf_dir, name))


# The document operators proper, then one query per remaining table.
NAMED = {"q_doc_explode": "contracts", "q_two_level": "overdue_principals", "q_one_or_many": "employer"}
for _q, _name in NAMED.items():
    _register(_q, _name)
for _name in ENTITIES:
    if _name not in NAMED.values():
        _register(f"q_bureau_{_name}", _name)

PER_LOAN = ("collaterals", "guarantors", "payments", "monthly_detail")


@query("q_four_shapes", " union all by name ".join(
    f"(select '{n}' as kind, q.* from ({entity_sql(n)}) q)" for n in PER_LOAN))
def _four_shapes(spark, sf_dir):
    docs = fd.docs(spark, sf_dir, *PER_LOAN, values=fd.pick(CLIENT))
    tables = bureau_tables(docs, *PER_LOAN)
    return union_by_name(*[rows.withColumn("kind", F.lit(n)) for n, rows in tables.items()])


@query("q_hints", f"select o_orderkey as number, {fd.HINT.replace('k ', 'o_orderkey ')} as hint from orders "
                  "where o_orderdate > timestamp '1996-11-01'")
def _hints(spark, sf_dir):
    return hints(fd.docs(spark, sf_dir, values=fd.pick(IS_OK, HINT_PATH)), after="1996-11-01")


@query("q_cache_ids", "select o_orderkey as number, concat('h', cast(o_orderkey as varchar)) as katm_cache_id "
                      "from orders where o_orderkey % 4 > 1")
def _cache_ids(spark, sf_dir):
    return cache_ids(fd.docs(spark, sf_dir, values=fd.pick("credit.katm_cache_id")))


@query("q_id_map", 'select cast(o_orderkey as varchar) as "_id", o_orderkey as number from orders where o_orderkey > 500')
def _id_map(spark, sf_dir):
    return id_map(fd.docs(spark, sf_dir, values=fd.pick("status")), above=500)


@query("q_doc_scan", "select o_orderkey as number, cast(o_custkey as varchar) as client, o_orderstatus as status "
                     "from orders where o_orderkey % 12 <> 0")
def _doc_scan(spark, sf_dir):
    docs = fd.docs(spark, sf_dir, "contracts", values=fd.pick(CLIENT, "status"))
    found = docs.where(path_exists("doc", CONTRACT)).drop("_id")
    return found.select("number", json_path("doc", CLIENT).alias("client"), json_path("doc", "status").alias("status"))


@query("q_doc_count", "select count(*) as n from orders where o_orderkey % 12 <> 0 and o_orderkey > 100 "
                      "and o_orderdate > timestamp '1996-01-01' and o_orderdate < timestamp '1999-01-01'")
def _doc_count(spark, sf_dir):
    docs = created_between(fd.docs(spark, sf_dir, "contracts"), "1996-01-01", "1999-01-01")
    return docs.where((F.col("number") > 100) & path_exists("doc", CONTRACT)).agg(F.count("*").alias("n"))


@query("q_elem_match", """
select distinct k as number from (select o_orderkey as k, *, unnest(generate_series(1, o_orderkey % 4)) as i
  from orders) t where (k + i) % 3 <> 0 and cast(o_orderdate as date) >= date '1997-06-01'""")
def _elem_match(spark, sf_dir):
    docs = fd.docs(spark, sf_dir, "contracts", "overdue_principals")
    late = any_element(
        json_path("doc", CONTRACT), ["overdue_principals", "contract_date"],
        lambda x: F.get_json_object(x["overdue_principals"], "$.overdue_principal").isNotNull()
        & (x["contract_date"] >= "1997-06-01"),
    )
    return docs.where(late).select("number")


@query("q_key_search", f"""select k as number, {FIELDS['contracts']['contract_id']} as contract_id,
  {text(FIELDS['contracts']['org'])} as org, {text(FIELDS['contracts']['amount'])} as amount
  from {fd.oracle_rows('contracts')}""")
def _key_search(spark, sf_dir):
    docs = fd.docs(spark, sf_dir, "contracts", "overdue_principals", "open_contracts")
    return key_search(docs, "contract", ["contract_id", "org", "amount"], keep=["number"])


_FLAT_VALUES = {CLIENT: text("o_custkey"), IS_OK: fd.IS_OK_TEXT, HINT_PATH: fd.HINT,
                **{f"{REPORT_077}.overview.{f}": text(e) for f, e in FIELDS["overview"].items()}}


@query("q_flatten_paths", " union all ".join(
    f"select number, path, value from (select o_orderkey as k, o_orderkey as number, '{p}' as path, "
    f"{e} as value from (select o_orderkey as k, * from orders) o) t where value is not null"
    for p, e in _FLAT_VALUES.items()))
def _flatten_paths(spark, sf_dir):
    return path_values(fd.docs(spark, sf_dir, "overview", values=fd.pick(CLIENT, IS_OK, HINT_PATH)), ["number"])


def _nested_parts(spark, sf_dir):
    return fx.table(spark, sf_dir, "part").select(
        "p_partkey", F.split("p_name", " ").alias("words"),
        F.struct(F.col("p_brand").alias("brand"), F.struct(F.col("p_size").alias("size")).alias("more")).alias("info"),
    )


@query("q_flatten_prefix", "select p_partkey, replace(p_name, ' ', ', ') as words, p_brand as info_brand, "
                           "p_size as \"info_more.size\" from part")
def _flatten_prefix(spark, sf_dir):
    return flatten_prefix(_nested_parts(spark, sf_dir))


@query("q_drop_nested", "select p_partkey from part")
def _drop_nested(spark, sf_dir):
    return drop_nested(_nested_parts(spark, sf_dir))


@query("q_conform", "select s_name as name, cast(null as varchar) as borough, cast(s_nationkey as varchar) as nation, "
                    "cast(null as varchar) as \"_id\", s_suppkey as number from supplier")
def _conform(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "supplier").withColumnsRenamed(
        {"s_suppkey": "number", "s_name": "name", "s_nationkey": "nation"})
    return conform(rows, ["name", "borough", "nation"], ["_id", "number"])


@query("q_union_by_name", "select c_custkey as id, c_name as name, c_mktsegment as segment, cast(null as double) as bal "
                          "from customer union all select s_suppkey, s_name, null, s_acctbal from supplier")
def _union_by_name(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer").selectExpr("c_custkey as id", "c_name as name", "c_mktsegment as segment")
    s = fx.table(spark, sf_dir, "supplier").selectExpr("s_suppkey as id", "s_name as name", "s_acctbal as bal")
    return union_by_name(c, s)


# -- incremental document loads ---------------------------------------------------------------------------------------

@query("q_bureau_incremental", f"select * from ({entity_sql('contracts')}) where number > "
                               "(select max(s_suppkey) from supplier)")
def _bureau_incremental(spark, sf_dir):
    loaded = fx.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("number"))
    return new_rows(fd.docs(spark, sf_dir, "contracts"), loaded, "contracts")


@query("q_bureau_backfill", f"select * from ({entity_sql('contracts')}) where number % 4 <> 0 and number not in "
                            "(select l_orderkey from lineitem)")
def _bureau_backfill(spark, sf_dir):
    docs = fd.docs(spark, sf_dir, "contracts", "overview")
    loaded = fx.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("number"))
    return missing_rows(docs, bureau_table(docs, "overview"), loaded, "contracts", "contracts_qty")
