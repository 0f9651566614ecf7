"""Column expressions over the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanmart import fixtures as fx
from loanmart.functions import scalars as sc
from loanmart.functions.calendar import date_ranges, lookback, month_window
from loanmart.queries.base import iso, iso_time, query


def orders(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders")


def _k(n: int):
    return F.col("o_orderkey") % n


@query("q_scalar_nulls", """
select o_orderkey, case when o_orderkey % 3 = 2 then o_orderstatus else '0' end as filled,
  case when o_orderkey % 3 = 2 then o_orderstatus else '' end || '-' || cast(o_custkey as varchar) as joined,
  case when o_orderkey % 2 = 0 then 0 else o_custkey end as number,
  case when o_orderkey % 3 = 2 then o_orderstatus end as nothing from orders""")
def _scalar_nulls(spark, sf_dir):
    part = F.when(_k(3) == 1, F.lit("")).when(_k(3) == 2, F.col("o_orderstatus"))
    return orders(spark, sf_dir).select(
        "o_orderkey", sc.nvl_text(part, "0").alias("filled"),
        sc.concat_text(part, F.lit("-"), "o_custkey").alias("joined"),
        sc.nvl(F.when(_k(2) == 1, F.col("o_custkey")), 0).alias("number"),
        sc.concat_text(part, F.lit(None)).alias("nothing"),
    )


@query("q_decode", """
select o_orderkey, case o_orderkey % 4 when 0 then 'none' when 1 then 'one' when 2 then 'two' else '-' end as label,
  case o_orderstatus when 'F' then 'closed' when 'O' then 'open' end as state from orders""")
def _decode(spark, sf_dir):
    code = F.when(_k(4) != 0, _k(4))
    return orders(spark, sf_dir).select(
        "o_orderkey", sc.decode(code, (1, "one"), ("2", "two"), (None, "none"), default="-").alias("label"),
        sc.decode("o_orderstatus", ("F", "closed"), ("O", "open")).alias("state"),
    )


@query("q_date_clamp", f"""
select o_orderkey, {iso("case when o_orderkey % 3 = 0 then date '1900-01-01' when o_orderkey % 3 = 1 "
                        "then date '1753-01-01' else cast(o_orderdate as date) end")} as day from orders""")
def _date_clamp(spark, sf_dir):
    raw = F.when(_k(3) == 1, F.lit("1699-05-05").cast("date")).when(_k(3) == 2, F.to_date("o_orderdate"))
    return orders(spark, sf_dir).select("o_orderkey", sc.clamp_date(raw).alias("day"))


@query("q_date_parse", f"""
select o_orderkey, case when o_orderkey % 9 < 8 then {iso('cast(o_orderdate as date)')} end as day,
  {iso('cast(o_orderdate as date)')} as day_first,
  case when o_orderkey % 2 = 0 then {iso_time("o_orderdate + interval 1 second * (o_orderkey % 86400)")} end as moment
from orders""")
def _date_parse(spark, sf_dir):
    layouts = ["yyyyMMdd", "dd.MM.yyyy", "dd.MM.yy", "dd/MM/yyyy", "dd-MM-yyyy", "yyyy-MM-dd", "yyyy.MM.dd", "d.M.yyyy"]
    written = F.lit("31st of May")
    for i, layout in enumerate(layouts):
        written = F.when(_k(9) == i, F.date_format("o_orderdate", layout)).otherwise(written)
    moment = F.col("o_orderdate") + F.make_dt_interval(secs=_k(86400))
    stamp = F.when(_k(4) == 0, F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSS")).when(
        _k(4) == 2, F.date_format(moment, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(moment, "dd.MM.yyyy HH"))
    return orders(spark, sf_dir).select(
        "o_orderkey", sc.parse_date(written).alias("day"),
        sc.parse_day_first(F.date_format("o_orderdate", "dd-MM-yyyy")).alias("day_first"),
        sc.parse_timestamp(stamp).alias("moment"),
    )


@query("q_pad_code", """
select o_orderkey, case when o_orderkey > 999 then cast(o_orderkey as varchar)
  else lpad(cast(o_orderkey as varchar), 3, '0') end as code,
  substring('20216' || lpad(cast(o_custkey % 1000 as varchar), 3, '0') || '9001', 6, 3) as currency from orders""")
def _pad_code(spark, sf_dir):
    account = F.concat(F.lit("20216"), sc.pad_code(F.col("o_custkey") % 1000), F.lit("9001"))
    return orders(spark, sf_dir).select(
        "o_orderkey", sc.pad_code("o_orderkey").alias("code"), sc.sub_code(account, 6, 3).alias("currency"))


@query("q_status_flag", """
select o_orderkey, cast(case o_orderkey % 6 when 0 then 0 when 1 then 0 when 2 then 1 when 3 then -1 when 4 then 1 end
  as bigint) as flag
from orders""")
def _status_flag(spark, sf_dir):
    raw = F.element_at(F.array(*[F.lit(v) for v in (None, "0.0", "3", "-1", "7", "abc")]), (_k(6) + 1).cast("int"))
    return orders(spark, sf_dir).select("o_orderkey", sc.status_flag(raw).alias("flag"))


@query("q_tail_cut", """
select o_orderkey, case when o_orderkey % 3 = 0 then cast(o_custkey as varchar)
  when o_orderkey % 3 = 1 then cast(o_custkey as varchar) else '' end as client from orders""")
def _tail_cut(spark, sf_dir):
    raw = F.when(_k(3) == 0, F.col("o_custkey").cast("string")).when(
        _k(3) == 1, F.concat(F.col("o_custkey").cast("string"), F.lit(".0000000000"))).otherwise(F.lit("1.5"))
    return orders(spark, sf_dir).select("o_orderkey", sc.cut_tail(raw).alias("client"))


@query("q_floor_div", "select o_orderkey, cast(floor((o_orderkey - 5000) / 100.0) as bigint) as hundreds from orders")
def _floor_div(spark, sf_dir):
    return orders(spark, sf_dir).select("o_orderkey", sc.floor_div(F.col("o_orderkey") - 5000, 100).alias("hundreds"))


@query("q_prefix_mask", """
select o_orderkey, case when o_orderpriority like '1-%' then o_orderpriority end as kept,
  case when o_orderpriority like '1-%' then 1 else 0 end as has_it,
  case when o_orderpriority like '1-%' then 'of ' || o_orderpriority else '' end as tail from orders""")
def _prefix_mask(spark, sf_dir):
    kept = sc.keep_prefix("o_orderpriority", "1-")
    return orders(spark, sf_dir).select(
        "o_orderkey", kept.alias("kept"), sc.present_flag(kept).alias("has_it"),
        sc.drop_first_word(F.concat(F.lit("due  of   "), kept, F.lit(" "))).alias("tail"))


@query("q_poly_bool", "select o_orderkey, o_orderkey % 4 < 2 as refused from orders where o_orderkey % 4 < 3")
def _poly_bool(spark, sf_dir):
    raw = F.when(_k(4) == 0, F.lit("False")).when(_k(4) == 1, F.lit("false")).when(_k(4) == 2, F.lit("true"))
    flag = sc.poly_bool(raw)
    return orders(spark, sf_dir).where(flag.isNotNull()).select("o_orderkey", (~flag).alias("refused"))


@query("q_month_ranges", f"""
with d as (select distinct cast(o_orderdate as date) as day, cast(o_custkey % 4 as int) as back from orders),
m as (select day, back, cast(date_trunc('month', day) as date) as m0 from d),
w as (select *, cast(m0 - interval 1 month * back as date) as f, m0 - 120 as s from m)
select {iso('day')} as day, back, {iso('f')} as first_day, {iso('last_day(f)')} as last_day,
  {iso("date_trunc('month', s)")} as window_start, {iso('m0')} as window_end from w""")
def _month_ranges(spark, sf_dir):
    days = orders(spark, sf_dir).select(
        F.to_date("o_orderdate").alias("day"), (F.col("o_custkey") % 4).cast("int").alias("back")).distinct()
    first = last = None
    for n in range(4):
        a, b = month_window("day", n)
        hit = F.col("back") == n
        first = F.when(hit, a) if first is None else first.when(hit, a)
        last = F.when(hit, b) if last is None else last.when(hit, b)
    start, end = lookback("day", 120)
    return days.select("day", "back", first.alias("first_day"), last.alias("last_day"),
                       start.alias("window_start"), end.alias("window_end"))


def _ranges_sql(period: str, anchor: str, step: str) -> str:
    return f"""
select '{period}' as period, greatest(s, lo) as a, least(cast(s + interval {step} as date) - 1, hi) as b
from (select lo, hi, cast(unnest(generate_series({anchor}, cast(hi as timestamp), interval {step})) as date) as s
  from bounds) x"""


@query("q_date_ranges", f"""
with bounds as (select cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) as hi from orders),
r as ({_ranges_sql('week', 'cast(lo as timestamp)', '7 day')} union all
  {_ranges_sql('month', "date_trunc('month', lo)::timestamp", '1 month')} union all
  {_ranges_sql('season', "cast(date_trunc('quarter', lo + interval 1 month) - interval 1 month as timestamp)",
               '3 month')})
select period, {iso('a')} as range_start, {iso('b')} as range_end,
  (select count(*) from orders where cast(o_orderdate as date) between a and b) as n_orders from r""")
def _date_ranges(spark, sf_dir):
    days = orders(spark, sf_dir).groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    bounds = days.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    ranges = None
    for period in ("week", "month", "season"):
        part = date_ranges(bounds, "lo", "hi", period).withColumn("period", F.lit(period))
        ranges = part if ranges is None else ranges.unionByName(part)
    each_day = ranges.withColumn("day", F.explode(F.sequence("range_start", "range_end")))
    return each_day.join(days, "day", "left").groupBy("period", "range_start", "range_end").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_orders"))
