"""Scans, filters, joins, aggregates and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanmart import fixtures as fx
from loanmart.functions import scalars as sc
from loanmart.functions.calendar import month_window
from loanmart.operators import incremental as inc
from loanmart.operators import ranking as rk
from loanmart.operators import temporal as tm
from loanmart.plans.default_days import first_three_dates
from loanmart.plans.snapshot import open_on
from loanmart.queries.base import iso, iso_time, query
from loanmart.queries.marts import DPD_SQL, REPORT_DATE
from loanmart.sources import readers as rd


def t(name):
    return lambda spark, sf_dir: fx.table(spark, sf_dir, name)


orders, lineitem, events = t("orders"), t("lineitem"), t("events")


@query("q_top_n", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def _top_n(spark, sf_dir):
    return orders(spark, sf_dir).select("o_orderkey", "o_totalprice").orderBy(
        F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(10)


@query("q_distinct", "select distinct o_orderstatus, cast(o_custkey % 7 as int) as id_mfo from orders")
def _distinct(spark, sf_dir):
    return orders(spark, sf_dir).select(
        "o_orderstatus", (F.col("o_custkey") % 7).cast("int").alias("id_mfo")).distinct()


@query("q_range_filter", "select o_orderkey, o_custkey from orders where o_orderkey > 300 and o_orderkey <= 900")
def _range_filter(spark, sf_dir):
    return inc.between_keys(orders(spark, sf_dir), "o_orderkey", 300, 900).select("o_orderkey", "o_custkey")


@query("q_date_slice", f"select event_id, {iso_time('ts')} as ts from events where ts >= timestamp '2024-01-05' "
                       "and ts < timestamp '2024-01-09'")
def _date_slice(spark, sf_dir):
    ts = F.col("ts")
    return events(spark, sf_dir).where(
        (ts >= F.lit("2024-01-05").cast("timestamp")) & (ts < F.lit("2024-01-09").cast("timestamp"))
    ).select("event_id", "ts")


@query("q_key_exists", "select count(*) > 0 as present from orders where o_orderkey = 77")
def _key_exists(spark, sf_dir):
    return rd.key_exists(orders(spark, sf_dir), "o_orderkey", 77)


SALDO = fx.oracle_view("saldo")


@query("q_asof_balance", f"select account, id_mfo, abs(saldo / 100) as balance from ({SALDO}) s "
                         f"where dati <= date '{REPORT_DATE}' and datn > date '{REPORT_DATE}'")
def _asof_balance(spark, sf_dir):
    return tm.balance_on(fx.view(spark, sf_dir, "saldo"), REPORT_DATE)


@query("q_role_pivot", fx.with_views("loan_accounts", query="""
select glob_id, min(case when kod_acc = 2 then account end) as acc_pros,
  min(case when kod_acc = 12 then account end) as acc_proc, min(case when kod_acc = 4 then account end) as acc_157
from loan_accounts where rec_activ = 0 and kod_acc in (2, 12, 4) group by 1"""))
def _role_pivot(spark, sf_dir):
    return tm.role_pivot(fx.view(spark, sf_dir, "loan_accounts"), {2: "acc_pros", 12: "acc_proc", 4: "acc_157"})


@query("q_open_on_date", fx.with_views("loans", query=f"""
select glob_id, ss_status from loans where ss_status <> 3 or coalesce(date_stop, date_start) > date '{REPORT_DATE}'"""))
def _open_on_date(spark, sf_dir):
    return fx.view(spark, sf_dir, "loans").where(open_on(REPORT_DATE)).select("glob_id", "ss_status")


@query("q_days_past_due", f"with saldo as ({SALDO}), {DPD_SQL} select * from dpd")
def _days_past_due(spark, sf_dir):
    """Days from the beginning of an account's current unbroken run of non-zero balances to the report date.

    This is our own definition: the function the snapshot calls for it is not among what there is to read.
    """
    return tm.days_past_due(fx.view(spark, sf_dir, "saldo"), REPORT_DATE)


@query("q_scalar_agg", f"""
select c_custkey, {iso('max(o_orderdate)')} as last_day, {iso('min(o_orderdate)')} as first_day
from customer left join orders on o_custkey = c_custkey group by 1""")
def _scalar_agg(spark, sf_dir):
    per = orders(spark, sf_dir).groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.to_date(F.max("o_orderdate")).alias("last_day"), F.to_date(F.min("o_orderdate")).alias("first_day"))
    return fx.table(spark, sf_dir, "customer").select("c_custkey").join(per, "c_custkey", "left")


@query("q_first_movement", fx.with_views("loans", "saldo", query=f"""
select glob_id, {iso('min(dati)')} as first_movement from loans l join saldo s
on s.id_mfo = l.id_mfo and s.account = l.acc_new and dati >= date_vyd_d and obor_d <> 0 group by 1"""))
def _first_movement(spark, sf_dir):
    return tm.first_movement(fx.view(spark, sf_dir, "loans"), fx.view(spark, sf_dir, "saldo"))


@query("q_computed_key", fx.with_views("loans", "purpose_parts", query="""
select glob_id, k_cel_ssudy, name as cel from loans left join purpose_parts
on kod_gr * 10000 + kod_pgr * 100 + kod = k_cel_ssudy"""))
def _computed_key(spark, sf_dir):
    parts = fx.view(spark, sf_dir, "purpose_parts").select(
        sc.key_from_parts("kod_gr", "kod_pgr", "kod").alias("k_cel_ssudy"), F.col("name").alias("cel"))
    return fx.view(spark, sf_dir, "loans").select("glob_id", "k_cel_ssudy").join(parts, "k_cel_ssudy", "left")


@query("q_schedule_first3", fx.with_views("schedule", query=f"""
select glob_id, {iso('g[1]')} as p1, {iso('g[2]')} as p2, {iso('g[3]')} as p3
from (select glob_id, list_sort(list_distinct(list(date_gash))) as g from schedule group by 1) s where len(g) >= 3"""))
def _schedule_first3(spark, sf_dir):
    return first_three_dates(fx.view(spark, sf_dir, "schedule"))


@query("q_running_sum", f"""
select l_orderkey, l_linenumber, l_suppkey, {iso('l_shipdate')} as day,
  sum(l_quantity) over (partition by l_suppkey order by cast(l_shipdate as date)) / 100 as paid from lineitem""")
def _running_sum(spark, sf_dir):
    rows = lineitem(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.to_date("l_shipdate").alias("day"), "l_quantity")
    totals = rk.running_total(rows, ["l_suppkey"], "day", "l_quantity", "paid", scale=100)
    return rows.drop("l_quantity").join(totals, ["l_suppkey", "day"])


@query("q_dense_rank", """
select distinct l_suppkey, l_returnflag, l_extendedprice,
  cast(dense_rank() over (partition by l_suppkey, l_returnflag order by l_extendedprice) as int) as rank
from lineitem""")
def _dense_rank(spark, sf_dir):
    return rk.dense_ranks(lineitem(spark, sf_dir), ["l_suppkey", "l_returnflag"], "l_extendedprice")


@query("q_daily_unique", f"""
select event_id, user_id, {iso('ts')} as day, case when row_number() over (partition by user_id, cast(ts as date)
  order by event_type desc, value desc, ts desc, event_id) = 1 then 1 else 0 end as unique_flag from events""")
def _daily_unique(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    won = rk.first_per_group(rows, ["day", "user_id"], ["event_type", "value", "ts"], "event_id")
    flags = won.select("event_id", F.lit(1).alias("won"))
    return rows.select("event_id", "user_id", "day").join(flags, "event_id", "left").select(
        "event_id", "user_id", "day", F.coalesce("won", F.lit(0)).alias("unique_flag"))


@query("q_semi_backfill", "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders)")
def _semi_backfill(spark, sf_dir):
    keys = rd.first_column(orders(spark, sf_dir).select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"))
    return inc.only_keys(fx.table(spark, sf_dir, "customer"), keys, "c_custkey").select("c_custkey", "c_name")


@query("q_anti_backfill", "select distinct o_orderkey as number from orders where o_custkey <> 0 and o_orderkey not in "
                          "(select l_orderkey from lineitem)")
def _anti_backfill(spark, sf_dir):
    parent = orders(spark, sf_dir).select(F.col("o_orderkey").alias("number"), "o_custkey")
    child = lineitem(spark, sf_dir).select(F.col("l_orderkey").alias("number"))
    return inc.backfill(parent, child, "number", F.col("o_custkey") != 0)


@query("q_cross_params", fx.with_views("loans", query=f"""
, last as (select cast(date_trunc('month', max(date_vyd_d)) as date) as m from loans),
grid as (select p as product, cast(m - interval 1 month * b as date) as start from last,
  unnest([24, 34, 32]) as x(p), unnest([0, 1, 2]) as y(b))
select product, {iso('start')} as start_date, {iso('last_day(start)')} as end_date,
  (select count(*) from loans where k_vid_cred = product and date_vyd_d between start and last_day(start)) as n_loans
from grid""").replace(") , last", "), last").replace(")\n, last", "), last").replace(") \n, last", "), last"))
def _cross_params(spark, sf_dir):
    loans = fx.view(spark, sf_dir, "loans")
    # the parameter grid is one row per product and month, made by exploding two literal lists
    grid = (
        loans.agg(F.max("date_vyd_d").alias("day"))
        .select("day", F.explode(F.array(*map(F.lit, (24, 34, 32)))).alias("product"))
        .select("product", F.inline(F.array(*[
            F.struct(*(c.alias(n) for c, n in zip(month_window("day", b), ("start_date", "end_date")))) for b in range(3)
        ])))
    )
    counts = loans.groupBy(F.col("k_vid_cred").alias("product"), F.trunc("date_vyd_d", "MM").alias("start_date")).agg(
        F.count("*").alias("n"))
    return grid.join(counts, ["product", "start_date"], "left").select(
        "product", "start_date", "end_date", F.coalesce("n", F.lit(0)).alias("n_loans"))


@query("q_incremental", "select o_orderkey, o_custkey from orders where o_orderkey > (select max(s_suppkey) from supplier)")
def _incremental(spark, sf_dir):
    target = fx.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("o_orderkey"))
    return inc.incremental(orders(spark, sf_dir), target, "o_orderkey").select("o_orderkey", "o_custkey")


@query("q_high_watermark", "select max(o_orderkey) as high from orders")
def _high_watermark(spark, sf_dir):
    written = orders(spark, sf_dir).select(F.format_number("o_orderkey", 0).alias("app_id"))
    return inc.high_watermark(written, "app_id")


@query("q_dedupe", f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, {iso('l_shipdate')} as day from lineitem
qualify row_number() over (partition by l_orderkey, l_linenumber
  order by l_partkey, l_suppkey, l_quantity, l_shipdate) = 1""")
def _dedupe(spark, sf_dir):
    rows = lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                          F.to_date("l_shipdate").alias("day"))
    return inc.once_per_key(rows, ["l_orderkey", "l_linenumber"], "l_partkey", "l_suppkey")


@query("q_copy_select", "select s_suppkey as id, upper(s_name) as name from supplier")
def _copy_select(spark, sf_dir):
    return rd.copy(fx.table(spark, sf_dir, "supplier"),
                   lambda d: d.select(F.col("s_suppkey").alias("id"), F.upper("s_name").alias("name"), "s_acctbal"),
                   ["id", "name"])


@query("q_param_sql", "select o_orderkey, o_orderstatus from orders where o_orderdate >= date '1997-01-01' "
                      "and o_orderdate < date '1998-01-01' and o_orderstatus in ('F', 'P')")
def _param_sql(spark, sf_dir):
    return rd.param_sql(
        spark,
        "select o_orderkey, o_orderstatus from {orders} where o_orderdate >= to_date(:start, 'dd-MM-yyyy') "
        "and o_orderdate < to_date(:end, 'dd-MM-yyyy') and array_contains(:states, o_orderstatus)",
        {"start": "01-01-1997", "end": "01-01-1998", "states": ["F", "P"]},
        orders=orders(spark, sf_dir),
    )


@query("q_text_search", r"""
select doc_id, cast(n as int) as line_number, regexp_replace(line, '^\s+|\s+$', '', 'g') as line
from (select doc_id, unnest(l) as line, unnest(range(1, len(l) + 1)) as n
  from (select doc_id, regexp_split_to_array(text, '\r\n|\r|\n') as l from documents) a) b
where contains(line, 'the ')""")
def _text_search(spark, sf_dir):
    return rd.find_lines(fx.table(spark, sf_dir, "documents"), "text", "the ", ["doc_id"])
