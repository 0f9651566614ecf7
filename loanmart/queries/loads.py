"""Sinks, write modes and file-arrival ingest. Each run writes to a fresh folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanmart import fixtures as fx
from loanmart.operators import buckets as bk
from loanmart.operators.merge import typed, upsert
from loanmart.queries.base import iso, iso_time, query
from loanmart.session import settled, work_dir
from loanmart.sources import readers as rd
from loanmart.sources import writers as wr
from loanmart.streaming.ingest import stream_ingest


def _orders(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("day"))


BASE = f"select o_orderkey, o_custkey, o_orderstatus, o_totalprice, {iso('o_orderdate')} as day from orders"


@query("q_upsert_all", f"""
select o_orderkey, o_custkey, case when o_orderstatus <> 'F' then 'U' else o_orderstatus end as o_orderstatus,
  case when o_orderstatus = 'F' then o_totalprice end as o_totalprice, day from ({BASE}) o""")
def _upsert_all(spark, sf_dir):
    """F is in the target only, O in both, P in the source only."""
    rows = _orders(spark, sf_dir)
    source = rows.where("o_orderstatus <> 'F'").withColumns(
        {"o_orderstatus": F.lit("U"), "o_totalprice": F.lit(None).cast("double")})
    return upsert(rows.where("o_orderstatus <> 'P'"), source, ["o_orderkey"])


@query("q_backup_snapshot", f"""
select *, '2001-12-01' as date_modified from ({BASE}) o
union all select * replace (cast(0 as double) as o_totalprice), '2001-12-02' from ({BASE}) o""")
def _backup_snapshot(spark, sf_dir):
    path, rows = work_dir(spark, "backup"), _orders(spark, sf_dir)
    wr.backup(rows, path, "2001-12-01")
    wr.backup(rows, path, "2001-12-02")
    # a repeated run replaces its own snapshot
    wr.backup(rows.withColumn("o_totalprice", F.lit(0.0)), path, "2001-12-02")
    return spark.read.parquet(path)


@query("q_replace_partition", f"""
select o_orderkey, o_custkey, o_orderstatus, case when o_orderstatus = 'F' then 0 else o_totalprice end as o_totalprice,
  day from ({BASE}) o""")
def _replace_partition(spark, sf_dir):
    path, rows = work_dir(spark, "daily"), _orders(spark, sf_dir)
    wr.overwrite(rows, path, ["o_orderstatus"])
    fresh = rows.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
    wr.replace_partitions(fresh, path, ["o_orderstatus"])
    return spark.read.parquet(path)


@query("q_append_roundtrip", """
select c_name as name, c_mktsegment as segment, cast(null as varchar) as "_id", c_custkey as number from customer
union all select s_name, null, null, s_suppkey from supplier""")
def _append_roundtrip(spark, sf_dir):
    path, columns, keys = work_dir(spark, "raw"), ["name", "segment"], ["_id", "number"]
    wr.append_raw(fx.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as number", "c_name as name", "c_mktsegment as segment", "c_acctbal"), path, columns, keys)
    wr.append_raw(fx.table(spark, sf_dir, "supplier").selectExpr("s_suppkey as number", "s_name as name"),
                  path, columns, keys)
    return spark.read.parquet(path)


@query("q_full_reload", f"""
select 'backup' as part, * from ({BASE}) o
union all select 'table', * replace (cast(0 as double) as o_totalprice) from ({BASE}) o""")
def _full_reload(spark, sf_dir):
    base, rows = work_dir(spark, "register"), _orders(spark, sf_dir)
    table, saved = f"{base}/table", f"{base}/backup"
    wr.full_reload(None, rows, table, saved, "2001-12-01")
    wr.full_reload(spark.read.parquet(table), rows.withColumn("o_totalprice", F.lit(0.0)), table, saved, "2001-12-02")
    kept = spark.read.parquet(saved).drop("date_modified").withColumn("part", F.lit("backup"))
    return kept.unionByName(spark.read.parquet(table).withColumn("part", F.lit("table")))


@query("q_reject_split", """
select o_orderkey, case o_orderkey % 10 when 3 then 'amount is no bigint' when 5 then 'day is no date'
  when 7 then 'amount is no bigint, day is no date' else '' end as reason,
  case when o_orderkey % 10 not in (3, 5, 7) then o_custkey end as amount from orders""")
def _reject_split(spark, sf_dir):
    bad = F.col("o_orderkey") % 10
    raw = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(bad.isin(3, 7), F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("amount"),
        F.when(bad.isin(5, 7), F.lit("soon")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))
    good, rejects = typed(raw, {"amount": "bigint", "day": "date"})
    return good.select("o_orderkey", F.lit("").alias("reason"), "amount").unionByName(
        rejects.select("o_orderkey", "reason", F.lit(None).cast("bigint").alias("amount")))


@query("q_csv_per_partition", f"select o_orderkey, o_custkey, o_totalprice, o_orderstatus, day from ({BASE}) o")
def _csv_per_partition(spark, sf_dir):
    path, rows = work_dir(spark, "csv"), _orders(spark, sf_dir)
    wr.csv_per_partition(rows, path, ["o_orderstatus"])
    return spark.read.csv(path, header=True, schema="o_orderkey bigint, o_custkey bigint, o_totalprice double, day date, "
                                                    "o_orderstatus string")


@query("q_dated_export", f"select o_orderkey, o_custkey, day from ({BASE}) o where day >= '1997-01-01' and "
                         "day < '1997-02-01'")
def _dated_export(spark, sf_dir):
    path = work_dir(spark, "export")
    rows = _orders(spark, sf_dir).where("day >= date '1997-01-01' and day < date '1997-02-01'")
    wr.dated_export(rows.select("o_orderkey", "o_custkey", "day"), path, "19970101")
    return rd.read_csv(spark, f"{path}/ds=19970101", "o_orderkey bigint, o_custkey bigint, day date")


@query("q_json_export", "select doc_id, lang, text from documents")
def _json_export(spark, sf_dir):
    path = work_dir(spark, "json")
    wr.json_lines(fx.table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), path)
    return spark.read.json(path, schema="doc_id bigint, lang string, text string")


@query("q_two_sinks", f"select 'csv' as sink, count(*) as n, cast(sum(o_custkey) as bigint) as keys from ({BASE}) o union all "
                      f"select 'table', count(*), cast(sum(o_custkey) as bigint) from ({BASE}) o")
def _two_sinks(spark, sf_dir):
    base, rows = work_dir(spark, "both"), _orders(spark, sf_dir)
    wr.to_many(rows, lambda d: wr.dated_export(d, f"{base}/csv", "x"), lambda d: wr.append(d, f"{base}/table"))
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, day date"
    csv = rd.read_csv(spark, f"{base}/csv/ds=x", schema).withColumn("sink", F.lit("csv"))
    both = csv.unionByName(spark.read.parquet(f"{base}/table").withColumn("sink", F.lit("table")))
    return both.groupBy("sink").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("keys"))


@query("q_stream_ingest", f"select event_id, {iso_time('ts')} as ts, user_id, event_type, value, props from events")
def _stream_ingest(spark, sf_dir):
    """Three drops of several files each, a few files a batch; the load is then called again and finds nothing new."""
    base, events = work_dir(spark, "stream"), fx.table(spark, sf_dir, "events")
    for part in range(3):
        drop = F.coalesce(F.pmod("event_id", F.lit(3)), F.lit(0)) == part
        events.where(drop).repartition(4).write.mode("append").parquet(f"{base}/in")
    for _ in range(2):
        table = stream_ingest(spark, f"{base}/in", events.schema, f"{base}/table", f"{base}/checkpoint", ["event_id"], files_per_batch=5)
    return table


@query("q_upsert_buckets", f"""
select o_orderkey, o_custkey, case when o_orderkey % 64 < 8 then 'U' else o_orderstatus end as o_orderstatus,
  case when o_orderkey % 64 < 8 then 0 else o_totalprice end as o_totalprice, day, cast(1 as bigint) as files_left from ({BASE}) o""")
def _upsert_buckets(spark, sf_dir):
    """Two of sixteen buckets are merged, one half of their rows new; the files of the others keep their names."""
    path, rows = work_dir(spark, "buckets"), _orders(spark, sf_dir)
    bucket = F.pmod(F.floor(F.col("o_orderkey") / 4), F.lit(16)).cast("int")
    bk.write_buckets(rows.where("o_orderkey % 64 >= 4"), path, bucket)
    names = spark.read.parquet(path).select("_metadata.file_path", bk.BUCKET).distinct()
    before = settled(names, "names")
    source = rows.where("o_orderkey % 64 < 8").withColumns({"o_orderstatus": F.lit("U"), "o_totalprice": F.lit(0.0)})
    touched = bk.upsert_buckets(source, path, ["o_orderkey"], bucket)
    after = spark.read.parquet(path).select("_metadata.file_path", bk.BUCKET).distinct()
    same = before.join(after, ["file_path", bk.BUCKET], "left_semi").select(bk.BUCKET).distinct()
    kept = before.where(~F.col(bk.BUCKET).isin(touched)).select(bk.BUCKET).distinct().exceptAll(same).count()
    return bk.read_buckets(spark, path).withColumn("files_left", F.lit(1 if kept == 0 and touched == [0, 1] else 0).cast("bigint"))


@query("q_backfill_bucketed", """
select distinct o_custkey as number from orders where o_custkey % 3 <> 0
  and o_custkey not in (select c_custkey from customer where c_mktsegment in ('BUILDING', 'MACHINERY'))""")
def _backfill_bucketed(spark, sf_dir):
    """Customers of orders that a loaded table lacks; both are key tables in eight buckets."""
    names = [f"keys_{work_dir(spark, 'n').rsplit('-', 1)[1]}" for _ in range(2)]
    orders = fx.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("number"))
    loaded = fx.table(spark, sf_dir, "customer").where("c_mktsegment in ('BUILDING', 'MACHINERY')").select(F.col("c_custkey").alias("number"))
    parent, child = (bk.write_key_table(df, name, ["number"], 8) for df, name in zip((orders, loaded), names))
    found = bk.backfill_bucketed(parent, child, "number", F.col("number") % 3 != 0)
    for name in names:
        spark.sql(f"DROP TABLE {name}")  # the files stay where they lie
    return found
