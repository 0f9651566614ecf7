"""Bureau and application documents derived from ``orders``, one document per order.

Field values are SQL expressions over the order and the child's position that both engines can run: Spark puts them
into JSON text here, the oracle selects them directly. Building a document is narrow work. Children take every shape
the feeds use: absent, null, empty text, one object, a list, and for per-loan children the wrapper shapes as well.

Names in the expressions: ``k`` the order key, ``i`` the child's position, ``c`` the position at the second level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanmart import contracts as ct
from loanmart.fixtures import kept, table

T = "string"


def text(expr: str) -> str:
    return f"cast({expr} as string)"


def quoted(expr: str) -> str:
    return f"concat('\"', {expr}, '\"')"


def obj(fields: dict[str, str]) -> str:
    """JSON object from raw JSON expressions; null expressions leave their field out."""
    parts = ", ".join(f"concat('\"{name}\":', {raw})" for name, raw in fields.items())
    return f"concat('{{', concat_ws(',', {parts}), '}}')"


def flat(fields: dict[str, str]) -> str:
    return obj({name: quoted(text(expr)) for name, expr in fields.items()})


def many(n: str, item: str, var: str = "i") -> str:
    """Nothing, one object, or a list, by count."""
    listed = f"concat('[', array_join(transform(sequence(1, int({n})), {var} -> {item}), ','), ']')"
    single = f"element_at(transform(array(1), {var} -> {item}), 1)"
    return f"case when {n} = 0 then null when {n} = 1 then {single} else {listed} end"


def shaped(shape: str, child: str, item: str) -> str:
    """The nine wrapper shapes of a per-loan child, by number."""
    one = f"element_at(transform(array(1), c -> {item}), 1)"
    two = f"concat('[', array_join(transform(array(1, 2), c -> {item}), ','), ']')"
    return (
        f"case {shape} when 1 then 'null' when 2 then '\"\"' when 3 then '[]' when 4 then '{{}}' "
        f"when 5 then {obj({child: one})} when 6 then {obj({child: two})} "
        f"when 7 then concat('[', {obj({child: one})}, ']') when 8 then concat('[', {obj({child: two})}, ']') end"
    )


SHAPE_ROWS = "case {shape} when 5 then 1 when 6 then 2 when 7 then 1 when 8 then 2 else 0 end"
ODATE = "cast(cast(o_orderdate as date) as string)"

# child fields per entity, and how many children a document has
FIELDS: dict[str, dict[str, str]] = {
    "contracts": {
        "contract_id": "concat(cast(k as string), '-', cast(i as string))",
        "org": "(k + i) % 50", "branch": "k % 9", "org_name": "o_orderpriority", "contract_date": ODATE,
        "currency": "case when k % 5 = 0 then '840' else '860' end", "amount": "(k * 7 + i * 13) % 1000",
        "percent": "case when i = 2 then null else k % 30 end", "total_debt_sum": "(k + i) % 300",
    },
    "open_contracts": {
        "contract_id": "concat(cast(k as string), '-', cast(i as string))", "org": "(k + i) % 50",
        "monthly_average_payment": "k % 77", "total_debt_sum": "(k + i) % 300", "currency": "'860'",
    },
    "contingent_liabilities": {
        "contract_id": "concat('l', cast(k as string))", "org": "(k + i) % 50", "amount": "(k * 3 + i) % 900",
        "contract_status": "o_orderstatus",
    },
    "overview": {
        "claims_qty": "k % 6", "contracts_qty": "k % 4", "contingent_liabilities_qty": "k % 3",
        "average_monthly_payment": "k % 1000", "max_overdue_principal_days": "k % 91",
    },
    "scoring": {"scoring_version": "'v1'", "scoring_grade": "k % 100", "scoring_class": "o_orderstatus"},
    "results": {
        "today_payment": "k % 500", "loan_summa": "k % 9000", "summa_other_mikrozaym": "k % 17",
        "bureau_segment": "o_orderpriority", "current_dlq_bureau": "k % 2", "current_dlq_total": "k % 5",
    },
    "results_errors": {"errmsg": "o_orderpriority", "message": "concat('m', cast(k as string))",
                       "score_cutoff": "k % 10"},
    "claims_wo_contracts": {"claim_id": "concat('c', cast(k as string), '-', cast(i as string))", "summa": "k % 700"},
    "client": {"pinfl": "k * 3", "name": "o_orderstatus", "birth_date": ODATE},
    "credit_reqs": {"org": "k % 40", "claim_id": "k + i"},
    "dynamics_of_scoring_ball": {"period": "i", "score_point": "(k * i) % 400"},
    "phones": {"phone_number": "concat('+998', cast(k + i as string))"},
    "sysinfo": {"report_type": "'077'", "claim_date": ODATE},
    "general_cbr_loans": {
        "uuid": "concat('u-', cast(k as string), '-', cast(i as string))",
        "currency": "case when k % 5 = 0 then 'USD' else 'UZS' end", "outstanding": "(k * i) % 5000",
        "status": "i", "open_date": ODATE, "delq_balance": "(k + i) % 60",
    },
    "open_contracts_333": {"uuid": "concat('o-', cast(k as string))", "status": "k % 4"},
    "general_cbr_scores": {"card_id": "k + i", "score_value": "(k + 31 * i) % 1000", "score_name": "'main'"},
    "loans_overview": {"ttl_accounts": "k % 12", "loans_active": "k % 5", "last_loan_date": ODATE},
    "credit_list": {"globId": "k * 10 + i", "idMfo": "k % 7", "status": "o_orderstatus", "summa": "(k * i) % 8000"},
    "employer": {"inn": "k * 11", "title": "concat('firm ', cast(o_custkey as string))", "regionID": "o_custkey % 14"},
    "overdue_principals": {
        "overdue_principal_sum": "(k + i + c) % 500", "overdue_date": ODATE, "overdue_principal_change": "'0'",
        "overdue_principal_days": "(k * c) % 90",
    },
    "overdue_procents": {
        "overdue_procent_sum": "(k + i * c) % 400", "overdue_date": ODATE, "overdue_procent_days": "(k + c) % 90",
    },
    "collaterals": {"collateral_code": "(k + c) % 20", "collateral_id": "concat('x', cast(c as string))",
                    "value": "(k * 17 + c) % 9999"},
    "guarantors": {"uuid": "concat('g-', cast(k as string), '-', cast(c as string))", "sum": "(k + c) % 777"},
    "payments": {"payment_date": ODATE, "payment_amount": "(k + 5 * c) % 640", "currency": "'UZS'"},
    "monthly_detail": {"date": ODATE, "status": "c", "balance_amt": "(k * c) % 810"},
}

COUNTS: dict[str, str] = {
    "contracts": "k % 4", "open_contracts": "k % 3", "contingent_liabilities": "case k % 5 when 1 then 1 when 2 then 2 else 0 end",
    "overview": "1", "scoring": "1 - k % 2", "results": "case when o_orderstatus = 'F' then 1 else 0 end",
    "results_errors": "case when o_orderstatus = 'F' then 0 else 1 end", "claims_wo_contracts": "(k + 1) % 3",
    "client": "1", "credit_reqs": "k % 2", "dynamics_of_scoring_ball": "3", "phones": "(k + 2) % 3", "sysinfo": "1",
    "general_cbr_loans": "k % 3", "open_contracts_333": "k % 2", "general_cbr_scores": "(k + 1) % 3",
    "loans_overview": "k % 2", "credit_list": "k % 3", "employer": "case when k % 4 = 1 then 1 else 0 end",
}

# second level: outer entity and the number of the wrapper's shape
SECOND: dict[str, tuple[str, str]] = {
    "overdue_principals": ("contracts", "case (k + i) % 3 when 1 then 5 when 2 then 6 else 0 end"),
    "overdue_procents": ("contracts", "case (k + 2 * i) % 3 when 1 then 5 when 2 then 6 else 0 end"),
    "collaterals": ("general_cbr_loans", "(k + i) % 9"),
    "guarantors": ("general_cbr_loans", "(k + i + 2) % 9"),
    "payments": ("general_cbr_loans", "(k + i + 4) % 9"),
    "monthly_detail": ("general_cbr_loans", "(k + i + 6) % 9"),
}

HINT = ("case k % 3 when 0 then concat('Просрочка  ', cast(k % 1000 as string), '  сум') "
        "when 1 then o_orderpriority end")
IS_OK = "case when o_orderstatus = 'F' then 'true' else '\"false\"' end"
IS_OK_TEXT = "case when o_orderstatus = 'F' then 'true' else 'false' end"

# Scalar values at a path, raw JSON.
VALUES: dict[str, str] = {
    "request.clientId": text("o_custkey"),
    f"{ct.RESULT_077}.is_ok": IS_OK,
    ct.HINT_PATH: quoted(HINT),
    ct.CACHE_ID_PATH: "case k % 4 when 0 then null when 1 then 'null' else concat('\"h', cast(k as string), '\"') end",
    "type": quoted("'online'"),
    "number": text("k"),
    "created": quoted("concat(cast(cast(o_orderdate as date) as string), ' 2', cast(k % 4 as string), ':15:00.250')"),
    "status": quoted("o_orderstatus"),
    "request.requestId": text("k * 2"),
    "request.amount": text("k * 37 % 100000"),
    "request.rate": text("k % 40"),
    "request.term": text("k % 36"),
    "asbt.status": "case k % 5 when 0 then null when 1 then '0' when 2 then '3' when 3 then '\"7\"' else '-2' end",
    "asbt.statusName": quoted("concat('st', cast(k % 5 as string))"),
    "asbt.globId": text("k"),
    "data.asbt_service_client.result.data.fio": quoted("concat('name ', cast(o_custkey as string))"),
    "data.asbt_service_client.result.data.dateBirth": quoted("'1985-03-01 00:00:00.000'"),
    "data.asbt_credit_list.result.hint": quoted("case when k % 2 = 0 then 'Просрочка по ИБ' else 'нет' end"),
    "result.is_ok": "case when o_orderstatus = 'F' then 'true' when o_orderstatus = 'P' then 'false' end",
    "result.error.message": quoted("case when o_orderstatus = 'P' then o_orderpriority end"),
    "data._salary.result.data.avgByMonthReal": text("k % 5000"),
    "data.katm_077.result.data.today_payment": text("k % 500"),
    "data.katm_077.result.data.bureau_segment": quoted("o_orderpriority"),
    "duration_sec": text("k % 60"),
}

# the client id of an application is text with a fixed tail in some documents
APP_CLIENT = ("case when k % 6 = 0 then concat('\"', cast(o_custkey % 100 as string), '.0000000000\"') "
              "else cast(o_custkey % 100 as string) end")

EMPTY_CONTRACTS = "case k % 12 when 4 then '\"\"' when 8 then 'null' end"


def _nest(values: dict[str, str]) -> str:
    tree: dict = {}
    for path, raw in values.items():
        node = tree
        *inner, leaf = path.split(".")
        for name in inner:
            node = node.setdefault(name, {})
        node[leaf] = raw

    def build(node) -> str:
        return node if isinstance(node, str) else obj({k: build(v) for k, v in node.items()})

    return build(tree)


def _child(name: str, second: list[str]) -> str:
    fields = {f: quoted(text(e)) for f, e in FIELDS[name].items()}
    for s in second:
        if SECOND[s][0] == name:
            wrapper, child = ct.ENTITIES[s].nested
            fields[wrapper] = shaped(SECOND[s][1], child, flat(FIELDS[s]))
    raw = many(COUNTS[name], obj(fields))
    return f"coalesce({raw}, {EMPTY_CONTRACTS})" if name == "contracts" else raw


def docs(spark: SparkSession, sf_dir: str, *sections: str, values: dict[str, str] | None = None,
         cached: bool = False) -> DataFrame:
    """Documents with the given child sections and scalar values: _id, number, created, doc."""
    outer = list(dict.fromkeys(SECOND[s][0] if s in SECOND else s for s in sections))
    second = [s for s in sections if s in SECOND]
    raw = dict(values or {})
    for name in outer:
        path = ct.ENTITIES[name].path
        if cached:
            path = path.replace(ct.REPORT_077, ct.CACHE_077)
        raw[path] = _child(name, second)
    orders = table(spark, sf_dir, "orders").repartition("o_orderkey").selectExpr("o_orderkey as k", "*")
    nested = _nest(raw)
    made = orders.selectExpr("cast(k as string) as _id", "k as number", "cast(o_orderdate as timestamp) as created", f"{nested} as doc")
    return kept(spark, sf_dir, f"documents {nested}", made)


def pick(*paths: str) -> dict[str, str]:
    return {p: VALUES[p] for p in paths}


def application_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = [p for _, p in ct.APPLICATION_PATHS if p in VALUES]
    return docs(spark, sf_dir, values={**pick(*wanted), ct.HINT_PATH: VALUES[ct.HINT_PATH], "request.clientId": APP_CLIENT})


def oracle_rows(name: str) -> str:
    """FROM clause with the children of an entity: columns of orders, k, i and (second level) c."""
    base = "(select o_orderkey as k, * from orders)"
    outer = SECOND[name][0] if name in SECOND else name
    first = f"(select *, unnest(generate_series(1, {COUNTS[outer]})) as i from {base} o)"
    if name not in SECOND:
        return f"{first} t"
    rows = SHAPE_ROWS.replace("{shape}", f"({SECOND[name][1]})")
    return f"(select *, unnest(generate_series(1, {rows})) as c from {first} s) t"


def oracle_entity(name: str, fixed: dict[str, str], source: str | None = None) -> str:
    """What unnesting the entity must give. ``fixed`` holds the parent columns."""
    e = ct.ENTITIES[name]
    made = FIELDS[source or name]
    cols = []
    for col in e.output:
        if col in fixed:
            expr = fixed[col]
        elif e.rename.get(col, col) in made and not (not e.child_wins and (col in e.parents or col in e.carry)):
            expr = text(made[e.rename.get(col, col)])
        else:
            expr = "cast(null as string)"
        cols.append(f"{expr} as {col}")
    return f"select {', '.join(cols)} from {oracle_rows(source or name)}"
