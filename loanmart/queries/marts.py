"""The composite marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from loanmart import fixture_docs as fd
from loanmart import fixtures as fx
from loanmart.contracts import APPLICATION_PATHS, HINT_PATH, application_columns
from loanmart.operators.buckets import hash_bucket, read_buckets, write_buckets
from loanmart.plans import register as reg
from loanmart.plans import snapshot as snap
from loanmart.plans.applications import applications
from loanmart.plans.default_days import changed_days, default_days, refresh, refresh_buckets, refresh_job
from loanmart.queries.base import iso, query
from loanmart.session import work_dir
from loanmart.sources.writers import overwrite

PRODUCTS = (24, 34, 32)
START, END = "1996-01-01", "1998-12-31"
REPORT_DATE, REPORT_DT = "1998-06-30", "199806"
RUN_DATE = "2001-12-31"


def balances_at_rest(v):
    """The balance table at rest, as the days expect it: all its rows, in the columns that they read."""
    return fx.at_rest(v["saldo"].select("account", "id_mfo", "dati", "datn", "obor_c", "obor_d_y"), "saldo")


def default_days_on(spark, sf_dir, start=START, end=END):
    v = fx.views(spark, sf_dir, "loans", "loan_accounts", "saldo", "schedule")
    return default_days(v["loans"], v["loan_accounts"], balances_at_rest(v), v["schedule"], start, end, PRODUCTS)


def default_days_sql(start=START, end=END) -> str:
    def less(kind: str, test: str, value: str) -> str:
        return f"min(case when d1 > 0 and paid < d1 and {test} then {value} else 0 end) as {kind}"

    return f"""
scope as (select glob_id, id_mfo, date_vyd_d, k_vid_cred from loans
  where rec_activ = 0 and k_vid_cred in (24, 34, 32) and date_vyd_d between date '{start}' and date '{end}'),
held as (select s.*, a.account from scope s join loan_accounts a on a.glob_id = s.glob_id and a.kod_acc in (2, 12)),
moved as (select *, sum(obor_c) over (partition by account order by dati) as paid,
  dense_rank() over (partition by account order by obor_d_y) as lvl from saldo where obor_d_y <> 0),
seen as (select h.*, m.dati, m.paid, max(m.datn) over (partition by h.glob_id) as datn
  from held h join moved m on m.account = h.account and m.id_mfo = h.id_mfo),
due as (select glob_id, list_sort(list_distinct(list(date_gash))) as g from schedule group by 1),
a as (select h.account, min(m.dati) as m1, min(m.obor_d_y) as d1
  from held h join moved m on m.account = h.account and m.id_mfo = h.id_mfo where lvl = 1 group by 1),
b as (select account, min(dati) as m2 from moved where lvl = 2 group by 1),
c as (select account, min(dati) as m3 from moved where lvl = 3 group by 1),
facts as (select s.*, g[1] as p1, g[2] as p2, g[3] as p3, m1, d1, m2, m3
  from seen s join due using (glob_id) join a using (account) left join b using (account) left join c using (account)
  where len(g) >= 3 and m1 - g[2] < 21),
mins as (select account,
  min(case when m1 - p1 <= 5 and paid >= d1 then dati - m1
           when m1 - p1 <= 5 and d1 > 0 and paid < d1 then datn - m1 else 10000 end) as fpd,
  {less("s1", "m2 - p2 <= 5", "datn - m2")}, {less("s2", "m1 - p1 >= 5", "datn - m1")},
  {less("t1", "m3 - p3 <= 5", "datn - m3")}, {less("t2", "m2 - p2 >= 5", "datn - m2")}
  from facts group by 1),
days as (select date_vyd_d, glob_id, k_vid_cred, cast(max(fpd) as int) as fpd,
  cast(max(case when s1 = 0 then s2 else s1 end) as int) as spd,
  cast(max(case when t1 = 0 then t2 else t1 end) as int) as tpd
  from (select distinct glob_id, account, date_vyd_d, k_vid_cred from facts) f join mins using (account)
  where fpd not in (0, 10000) group by 1, 2, 3)"""


DAYS_VIEWS = ("loans", "loan_accounts", "saldo", "schedule")


def _days_query(select: str, start=START, end=END) -> str:
    views = ", ".join(f"{n} as ({fx.oracle_view(n)})" for n in DAYS_VIEWS)
    return f"with {views}, {default_days_sql(start, end)} {select}"


@query("q_default_days", _days_query(f"select * replace ({iso('date_vyd_d')} as date_vyd_d) from days"))
def _default_days(spark, sf_dir):
    return default_days_on(spark, sf_dir)


@query("q_merge_upsert", _days_query(f"""
  , target as (select *, '2001-01-01' as date_modified from days where k_vid_cred <> 32),
  source as (select date_vyd_d, glob_id, k_vid_cred, fpd + 1 as fpd, cast(null as int) as spd, tpd,
    '{RUN_DATE}' as date_modified from days where k_vid_cred <> 24)
  select {iso('date_vyd_d')} as date_vyd_d, glob_id, k_vid_cred, fpd, spd, tpd, date_modified from source
  union all select {iso('date_vyd_d')}, glob_id, k_vid_cred, fpd, spd, tpd, date_modified from target
  where glob_id not in (select glob_id from source)"""))
def _merge_upsert(spark, sf_dir):
    days = default_days_on(spark, sf_dir)
    # one product is in the target only, one in both, one is new
    target = days.where("k_vid_cred <> 32").withColumn("date_modified", F.lit("2001-01-01"))
    fresh = days.where("k_vid_cred <> 24").withColumn("fpd", F.col("fpd") + 1).withColumn(
        "spd", F.lit(None).cast("int"))
    return refresh(target, fresh, RUN_DATE)


REFRESH_SQL = _days_query(f"""
  , merged as (select date_vyd_d, glob_id, k_vid_cred, fpd, spd, tpd, case when date_vyd_d < date '1998-05-01'
    then '1998-07-10' else '1998-09-10' end as date_modified from days)
  select 'table' as part, * replace ({iso('date_vyd_d')} as date_vyd_d) from merged
  union all select 'backup', {iso('date_vyd_d')}, glob_id, k_vid_cred, fpd, spd, tpd, '1998-07-10' from merged
  where date_vyd_d <= date '1998-06-30'""", "1998-01-01", "1998-09-01")


@query("q_refresh_job", REFRESH_SQL)
def _refresh_job(spark, sf_dir):
    v = fx.views(spark, sf_dir, *DAYS_VIEWS)
    tables = {**v, "accounts": v["loan_accounts"], "saldo": balances_at_rest(v)}
    base = work_dir(spark, "refresh")
    loaded = default_days(tables["loans"], tables["accounts"], tables["saldo"], tables["schedule"], "1998-01-01",
                          "1998-06-30", PRODUCTS)
    overwrite(loaded.withColumn("date_modified", F.lit("1998-07-10")), f"{base}/1")
    current = spark.read.parquet(f"{base}/1")
    merged = refresh_job(tables, current, f"{base}/2", f"{base}/backup", dt.date(1998, 9, 10), PRODUCTS)
    saved = spark.read.parquet(f"{base}/backup").drop("backup_date").withColumn("part", F.lit("backup"))
    return merged.withColumn("part", F.lit("table")).unionByName(saved)


@query("q_refresh_buckets", REFRESH_SQL)
def _refresh_buckets(spark, sf_dir):
    """The refresh job on a table in buckets, which is rewritten in place where the window's loans are."""
    v = fx.views(spark, sf_dir, *DAYS_VIEWS)
    tables = {**v, "accounts": v["loan_accounts"], "saldo": balances_at_rest(v)}
    base, bucket = work_dir(spark, "refresh"), hash_bucket(["glob_id"], 16)
    loaded = default_days(tables["loans"], tables["accounts"], tables["saldo"], tables["schedule"], "1998-01-01", "1998-06-30", PRODUCTS)
    write_buckets(loaded.withColumn("date_modified", F.lit("1998-07-10")), f"{base}/table", bucket)
    merged = refresh_buckets(tables, f"{base}/table", bucket, f"{base}/backup", dt.date(1998, 9, 10), PRODUCTS)
    saved = spark.read.parquet(f"{base}/backup").drop("backup_date").withColumn("part", F.lit("backup"))
    return merged.withColumn("part", F.lit("table")).unionByName(saved)


@query("q_refresh_changed", _days_query(f"select * replace ({iso('date_vyd_d')} as date_vyd_d) from days", START, END))
def _refresh_changed(spark, sf_dir):
    """The mart on balances up to a day, then only what the later movements reach: equal to the mart on all balances."""
    v = fx.views(spark, sf_dir, *DAYS_VIEWS)
    tables = {**v, "accounts": v["loan_accounts"], "saldo": balances_at_rest(v)}
    late = F.col("dati") > F.lit("1998-10-01").cast("date")
    path, bucket = work_dir(spark, "days"), hash_bucket(["glob_id"], 16)
    first = default_days(tables["loans"], tables["accounts"], tables["saldo"].where(~late), tables["schedule"], START, END, PRODUCTS)
    write_buckets(first, path, bucket)
    fresh, touched = changed_days(tables, tables["saldo"].where(late).select("account"), START, END, PRODUCTS)
    return read_buckets(spark, path).join(touched, "glob_id", "left_anti").unionByName(fresh)


def _clamped(c: str) -> str:
    return iso(f"case when {c} is null then date '1900-01-01' when {c} < date '1753-01-01' "
               f"then date '1753-01-01' else {c} end")


REGISTER_VIEWS = ("loans", "loan_accounts", "saldo", "accounts", "clients", "licences", "applications", "states",
                  "currencies", "purposes", "sectors", "sources", "grades", "tax_offices", "provinces", "districts",
                  "staff", "products", "collateral_kinds")


def _code(tab: str, key: str, value: str = "name") -> str:
    return f"(select {value} from {tab} x where x.kod = {key})"


REGISTER_SQL = fx.with_views(*REGISTER_VIEWS, query=f"""
select numdog as dog_num, l.id_mfo, kod_vals as kod_val, coalesce(nullif(client, ''), '0') as client,
  lpad(cast(kod_vals as varchar), 3, '0') || '-' || coalesce({_code('currencies', 'l.kod_vals')}, '') as name_val,
  cast(l.acc_new as varchar) as acc_new,
  coalesce((select cast(min(account) as varchar) from loan_accounts x
    where x.glob_id = l.glob_id and x.rec_activ = 0 and kod_acc = 2), '0') as acc_pros,
  coalesce((select cast(min(account) as varchar) from loan_accounts x
    where x.glob_id = l.glob_id and x.rec_activ = 0 and kod_acc = 1), '0') as acc_ras,
  proc_ss, proc_pr, summa / 1000 as summa, {_clamped('date_vyd_d')} as date_vyd_d,
  {_clamped('date_pog_d')} as date_pog_d,
  {_clamped('(case when ss_status = 3 then date_stop end)')} as dat_pogash,
  coalesce({_code('purposes', 'l.k_cel_ssudy')}, '0') as name_cel,
  coalesce({_code('states', 'l.kod_sost')}, '0') as name_sost,
  k_man, l.glob_id, id_apl,
  cast(kreditospos as varchar) || '_' || coalesce((select klass_name from grades x
    where x.klass_id = l.kreditospos), '') as n_kreditospos,
  cast(inspect as varchar) || '_' || coalesce((select fio from staff x
    where x.kod = l.inspect and x.id_mfo = l.id_mfo), '') as inspect,
  ss_status, {_clamped('date_stop')} as date_stop,
  case k_commis when 0 then 'Процент от суммы кредита' when 1 then 'Фиксир.сумма' when 2 then 'Наличная сумма'
    else 'нет' end as k_commis,
  case k_cred_line when 1 then 'Откр.' when 2 then 'Откр.с умен.лимита' else 'закрытыя' end as n_line,
  val_com, coalesce(pr_serv, 0) as pr_serv, k_vid_cred, k_type_obesp, sumobesp / 1000 as s_obesp,
  a.id_client as id_cl, {_clamped('pas_date_exp_director')} as pas_end,
  coalesce(nullif(post_adr, ''), '0') as post_adr, {_clamped('date_reg')} as date_reg,
  coalesce(num_nalog, 0) as num_nalog,
  cast(kod_nalog_org as varchar) || '_' || coalesce({_code('tax_offices', 'c.kod_nalog_org')}, '') as n_gni,
  coalesce(pas_ser_director, '0') as ser_pas, coalesce(pas_num_director, '0') as num_pas,
  coalesce((select cast(kod as varchar) || ' ' || name from sectors x where x.kod = c.kod_sector), ' ') as n_sector,
  coalesce({_code('sources', 'l.k_ist_cred')}, '0') as n_ist,
  coalesce((select cast(kod as varchar) || ' ' || name from provinces x where x.kod = c.kod_obl), ' ') as n_obl,
  coalesce((select cast(kod as varchar) || ' ' || name from districts x where x.kod = c.kod_reg), ' ') as n_reg,
  {_clamped('date_birth')} as date_birth,
  {_clamped('(select max(date_end) from licences x where x.id_client = a.id_client)')} as liz_end,
  {_clamped('(select min(dati) from saldo x where x.id_mfo = l.id_mfo and x.account = l.acc_new and '
            'x.dati >= l.date_vyd_d and x.obor_d <> 0)')} as dat_vyd,
  coalesce({_code('products', 'l.k_vid_cred')}, '0') as n_vid_cred,
  coalesce({_code('collateral_kinds', 'l.k_type_obesp')}, '0') as n_obesp,
  coalesce((select max(count_work_place) from applications x where x.glob_id = l.id_apl and x.rec_activ = 0), 0)
    as kol_work
from loans l join accounts a on a.id_mfo = l.id_mfo and a.account_new = l.acc_new
  join clients c on c.id_client = a.id_client
where l.rec_activ = 0 and kod_sost > 2 and date_vyd_d between date '{START}' and date '{END}'""")


@query("q_contract_register", REGISTER_SQL)
def _contract_register(spark, sf_dir):
    return reg.contract_register(fx.views(spark, sf_dir, *REGISTER_VIEWS), START, END)


SNAPSHOT_VIEWS = ("loans", "loan_accounts", "saldo", "saldo_val", "classes", "purpose_parts", "products", "statuses")


def _role_balance(role: int, tab: str = "saldo", more: str = "") -> str:
    return (f"coalesce((select abs(s.saldo / 100) from {tab} s join role_acc r on r.account = s.account "
            f"where r.glob_id = l.glob_id and r.kod_acc = {role} and s.id_mfo = l.id_mfo "
            f"and s.dati <= date '{REPORT_DATE}' and s.datn > date '{REPORT_DATE}'{more}), 0)")


def _role_days(role: int, balance: str) -> str:
    return (f"case when {balance} <> 0 then (select d.dpd from dpd d join role_acc r on r.account = d.account "
            f"where r.glob_id = l.glob_id and r.kod_acc = {role} and d.id_mfo = l.id_mfo) end as {balance}_dpd")


DPD_SQL = f"""
hist as (select * from saldo where dati <= date '{REPORT_DATE}'),
marked as (select *, case when saldo <> 0 and not coalesce(lag(saldo) over w <> 0 and lag(datn) over w >= dati, false)
  then 1 else 0 end as opens, row_number() over (partition by account order by dati desc) as back
  from hist window w as (partition by account order by dati)),
dpd as (select m.account, m.id_mfo, cast(date '{REPORT_DATE}' - max(o.dati) as int) as dpd
  from marked m join marked o on o.account = m.account and o.opens = 1
  where m.back = 1 and m.saldo <> 0 and m.datn > date '{REPORT_DATE}' group by 1, 2)"""

SNAPSHOT_SQL = ("with " + ", ".join(f"{n} as ({fx.oracle_view(n)})" for n in SNAPSHOT_VIEWS) + f""",
role_acc as (select glob_id, kod_acc, min(account) as account from loan_accounts where rec_activ = 0 group by 1, 2),
{DPD_SQL},
base as (select glob_id, acc_new, id_mfo, kod_vals, k_man, client, summa / 100 as summa_val, proc_ss,
  {iso('date_vyd_d')} as date_vyd_d, {iso('date_pog_d')} as date_pog_d, klasskach,
  (select name from classes x where x.kod = l.klasskach) as klass, k_cel_ssudy,
  (select name from purpose_parts x where cast(lpad(cast(kod_gr as varchar), 2, '0') ||
    lpad(cast(kod_pgr as varchar), 2, '0') || lpad(cast(kod as varchar), 2, '0') as bigint) = l.k_cel_ssudy) as cel,
  (select name from products x where x.kod = l.k_vid_cred) as vid_kr, k_vid_cred,
  (select case crit_cl when 1 then 'кр/кл.' when 2 then 'м/бизнес' when 3 then 'ф/хоз' when 4 then 'физ.'
    when 5 then 'частн.' when 6 then 'Work Out кл.' else '-' end from statuses x where x.glob_id = l.glob_id) as criter,
  (select abs(s.saldo / 100) from saldo s where s.account = l.acc_new and s.id_mfo = l.id_mfo
    and s.dati <= date '{REPORT_DATE}' and s.datn > date '{REPORT_DATE}') as ost_kr_ekv,
  {", ".join(f"{_role_balance(k)} as {c}" for k, c in snap.EQUIVALENT.items())},
  {_role_balance(4, 'saldo_val', ' and l.kod_vals <> 0')} as ost_157_nom,
  {_role_balance(27, 'saldo_val', ' and l.kod_vals <> 0')} as ost_95413_nom,
  {_role_balance(21, 'saldo_val')} as ost_91501_nom
  from loans l where mejbank in (0, 1, 3, 4) and kod_sost not in (9, 10) and rec_activ = 0
  and (ss_status <> 3 or coalesce(date_stop, date_start) > date '{REPORT_DATE}'))
select l.*, {_role_days(2, 'ost_pros_ekv')}, {_role_days(4, 'ost_157_ekv')}, {_role_days(12, 'ost_proc_ekv')},
  '{REPORT_DT}' as report_dt
from base l where ost_pros_ekv + ost_proc_ekv + ost_157_ekv + ost_95413_ekv + ost_91501_ekv <> 0""")


def snapshot_tables(spark, sf_dir):
    v = fx.views(spark, sf_dir, *SNAPSHOT_VIEWS)
    saldo = fx.at_rest(v["saldo"], "saldo")
    nominal = saldo.withColumn("saldo", F.floor(F.col("saldo") / F.lit(4.0)))
    return {**v, "accounts": v["loan_accounts"], "purposes": v["purpose_parts"], "saldo": saldo, "saldo_val": nominal}


@query("q_snapshot", SNAPSHOT_SQL)
def _snapshot(spark, sf_dir):
    return snap.portfolio_snapshot(snapshot_tables(spark, sf_dir), REPORT_DATE, REPORT_DT)


# -- application mart -------------------------------------------------------------------------------------------------

_APP_TIME = "cast(cast(o_orderdate as date) as timestamp) + interval 1 second * (72900 + 3600 * (k % 4))"
_SHIFTED = f"({_APP_TIME} + interval 5 hour)"
_KATM = "case when k % 3 = 0 then concat(cast(k % 1000 as varchar), ' сум') else '' end"

APPLICATION_SQL: dict[str, str] = {
    "loan_type": "'online'", "app_id": "k", "app_dt": f"strftime({_SHIFTED}, '%Y-%m-%d %H:%M:%S')",
    "status": "o_orderstatus", "client_id": "client", "request_id": "cast(k * 2 as varchar)",
    "loan_amt": "k * 37 % 100000", "asbt_status": "st", "asbt_comment": "concat('st', cast(k % 5 as varchar))",
    "fio": "concat('name ', cast(o_custkey as varchar))", "birth_date": "'1985-03-01 00:00:00'",
    "avg_salary": "cast(k % 5000 as varchar)", "avg_monthly_payment": "cast(k % 500 as varchar)",
    "result": "res", "error_detail": "case when o_orderstatus = 'P' then o_orderpriority end",
    "date": f"strftime({_SHIFTED}, '%Y-%m-%d')", "loan_amt_s": "(k * 37 % 100000) // 100",
    "month": f"strftime({_SHIFTED}, '%YM%m')",
    "unique_flag": "case when row_number() over (partition by cast(moment as date), client "
                   "order by st desc, res desc, moment desc, k) = 1 then 1 else 0 end",
    "Interest_rate": "cast(k % 40 as varchar)", "Term": "cast(k % 36 as varchar)",
    "asbt_dpd_amt": "case when k % 2 = 0 then 'по ИБ' else '' end", "katm_dpd_amt": _KATM,
    "flag_asbt_dpd": "case when k % 2 = 0 then 1 else 0 end", "flag_katm_dpd": "case when k % 3 = 0 then 1 else 0 end",
    "avg_payment": "cast(k % 500 as varchar)", "duration_sec": "cast(k % 60 as varchar)",
    "glob_id": "cast(k as varchar)", "bureau_segment": "o_orderpriority",
}


def _application_oracle() -> str:
    cols = ", ".join(f'{APPLICATION_SQL.get(c, "cast(null as varchar)")} as "{c}"' for c in application_columns())
    return f"""
select {cols} from (select o_orderkey as k, *, o_custkey % 100 as client,
  cast(case o_orderkey % 5 when 0 then 0 when 1 then 0 when 4 then -2 else 1 end as bigint) as st,
  cast(case when o_orderstatus = 'F' then 1 else 0 end as bigint) as res,
  {_SHIFTED.replace('(k %', '(o_orderkey %')} as moment from orders) o"""


@query("q_app_mart", _application_oracle())
def _app_mart(spark, sf_dir):
    return applications(fd.application_docs(spark, sf_dir))


assert HINT_PATH in {p for _, p in APPLICATION_PATHS}
