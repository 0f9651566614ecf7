from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from loanmart.session import settled, work_dir
from loanmart.sources import readers as rd
from loanmart.sources import writers as wr
from loanmart.streaming.ingest import stream_ingest


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_json_documents(spark, tmp_path):
    docs = [{"_id": {"$oid": "a1"}, "number": 5, "created": "2024-01-02T03:04:05Z", "x": "ы"}, {"_id": "b", "x": 1}]
    (tmp_path / "d.json").write_text("\n".join(json.dumps(d, ensure_ascii=False) for d in docs))
    got = rd.read_docs(spark, str(tmp_path / "d.json"), "json").orderBy("_id").collect()
    assert [(r["_id"], r.number) for r in got] == [("a1", 5), ("b", None)]
    assert got[0].created == dt.datetime(2024, 1, 2, 3, 4, 5) and json.loads(got[0].doc)["x"] == "ы"


def test_csv_with_header(spark, tmp_path):
    (tmp_path / "o.csv").write_text("order_id,date,product_name,quantity\n1,2024-01-01,pen,3\n")
    schema = "order_id int, date date, product_name string, quantity int"
    assert rows(rd.read_csv(spark, str(tmp_path / "o.csv"), schema)) == [(1, dt.date(2024, 1, 1), "pen", 3)]
    with pytest.raises(Exception, match="(?i)header"):
        rd.read_csv(spark, str(tmp_path / "o.csv"), schema.replace("product_name", "item")).collect()


def test_jdbc_options_and_predicates():
    start, end = dt.date(2023, 12, 15), dt.date(2024, 2, 10)
    assert rd.month_bounds(start, end) == [
        (dt.date(2023, 12, 15), dt.date(2023, 12, 31)), (dt.date(2024, 1, 1), dt.date(2024, 1, 31)),
        (dt.date(2024, 2, 1), dt.date(2024, 2, 10))]
    assert rd.month_predicates("d", start, end)[2] == "d >= DATE '2024-02-01' AND d < DATE '2024-02-11'"
    assert len(rd.product_month_predicates("p", [24, 34], "d", start, end)) == 6
    options = rd.jdbc_options({"url": "jdbc:x", "user": "u"}, query="select 1", fetchsize=50)
    assert options == {"url": "jdbc:x", "user": "u", "fetchsize": "50", "dbtable": "(select 1) q"}
    with pytest.raises(ValueError):
        rd.jdbc_options({}, query="q", table="t")
    assert wr.jdbc_options({"url": "jdbc:x"}, "t", 500) == {"url": "jdbc:x", "dbtable": "t", "batchsize": "500"}
    assert rd.sql_literal("o'b") == "'o''b'" and rd.sql_literal(None) == "NULL"


def test_month_predicates_cover_every_row_once(spark):
    start, end = dt.date(2023, 1, 1), dt.date(2023, 12, 31)
    df = spark.range(365 * 24).selectExpr("timestamp'2023-01-01 00:00:00' + make_dt_interval(0, id) as t")
    assert sum(df.where(p).count() for p in rd.month_predicates("t", start, end)) == 365 * 24


def test_tables(spark, tmp_path):
    wr.create_table(spark, "contract_t", ["_id", "number"], str(tmp_path / "t"))
    wr.create_table(spark, "contract_t", ["other"])  # exists already
    assert dict(spark.read.table("contract_t").dtypes) == {"_id": "string", "number": "bigint"}
    wr.append_table(spark.sql("select 5L as number, 'a' as _id, 1 as extra"), "contract_t")
    assert rows(spark.read.table("contract_t")) == [("a", 5)]
    assert "contract_t" in rd.list_tables(spark)
    wr.truncate(spark, "contract_t")
    assert spark.read.table("contract_t").count() == 0
    spark.sql("drop table contract_t")
    assert rd.table_or_empty(spark, "contract_t", "a int").count() == 0
    with pytest.raises(ValueError):
        wr.append_table(spark.range(1), "contract_t")
    with pytest.raises(ValueError):
        wr.truncate(spark, "a; drop table b")


def test_replace_table(spark, tmp_path):
    wr.create_table(spark, "again_t", ["a"], str(tmp_path / "a"))
    wr.create_table(spark, "again_t", ["b"], str(tmp_path / "b"), replace=True)
    assert spark.read.table("again_t").columns == ["b"]
    spark.sql("drop table again_t")


def test_backup_twice_on_one_day_keeps_one_snapshot(spark, tmp_path):
    path = str(tmp_path / "b")
    for n in (3, 5):
        wr.backup(spark.range(n), path, "2024-01-01")
    wr.backup(spark.range(2), path, "2024-01-02")
    got = spark.read.parquet(path).groupBy("date_modified").count()
    assert rows(got) == [(dt.date(2024, 1, 1), 5), (dt.date(2024, 1, 2), 2)]


def test_text_stays_readable_in_json(spark, tmp_path):
    wr.json_lines(spark.sql("select 'Просрочка' as hint"), str(tmp_path / "j"))
    text = "".join(p.read_text() for p in (tmp_path / "j").glob("part-*"))
    assert "Просрочка" in text


def test_export_per_product_and_month(spark, tmp_path):
    df = spark.sql("select 24 k_vid_cred, '2024-01' month, 1 v union all select 34, '2024-01', 2")
    wr.csv_per_partition(df, str(tmp_path / "c"), ["k_vid_cred", "month"])
    assert sorted(p.name for p in (tmp_path / "c").glob("k_*")) == ["k_vid_cred=24", "k_vid_cred=34"]


def test_names(spark):
    df = spark.sql("select 1, 2").toDF("", " ")
    assert rd.clean_names(df).columns == ["Unnamed_column", "Unnamed_column_2"]


def test_find_in_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("one\r\n  needle here \nneedle")
    (tmp_path / "sub" / "b.txt").write_text("no\nx needle")
    (tmp_path / "c.log").write_text("needle")
    got = [(r.file_path.rsplit("/", 1)[1], r.line_number, r.line)
           for r in rd.find_in_files(spark, str(tmp_path), "needle", "*.txt").collect()]
    assert sorted(got) == [("a.txt", 2, "needle here"), ("a.txt", 3, "needle"), ("b.txt", 2, "x needle")]


def test_line_numbers_over_many_splits(spark, tmp_path):
    lines = [("needle " if i % 97 == 0 else "straw ") + str(i) for i in range(1, 5001)]
    for name in ("a.txt", "b.txt"):
        (tmp_path / name).write_text("\n".join(lines))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        found = rd.find_in_files(spark, str(tmp_path), "needle")
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        got = sorted((r.file_path[-5:], r.line_number, r.line) for r in found.collect())
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    want = [(n, i, f"needle {i}") for n in ("a.txt", "b.txt") for i in range(97, 5001, 97)]
    assert got == want


def test_work_dir_is_below_the_shared_folder(spark):
    class Session:
        def __init__(self, base):
            self.conf = self
            self.get = lambda key, default: base if key == "spark.checkpoint.dir" else default

    assert work_dir(Session("hdfs://shared/x/"), "n").startswith("hdfs://shared/x/n-")
    assert work_dir(Session(None), "n") != work_dir(Session(None), "n")
    assert settled(spark.range(5), "s").count() == 5


EVENTS = "id bigint, v string"


def ingest(spark, folder, base, **kw):
    return stream_ingest(spark, str(folder), EVENTS, f"{base}/table", f"{base}/checkpoint", ["id"], **kw)


def test_one_drop_or_three_give_the_same_table(spark, tmp_path):
    one, three = tmp_path / "one", tmp_path / "three"
    df = spark.range(90).withColumn("v", F.concat(F.lit("e"), "id"))
    df.coalesce(1).write.parquet(str(one))
    a = rows(ingest(spark, one, tmp_path / "a"))
    for part in range(3):
        df.where(f"id % 3 = {part}").coalesce(1).write.mode("append").parquet(str(three))
        got = ingest(spark, three, tmp_path / "b", files_per_batch=1)
    assert rows(got) == a and len(a) == 90


def test_a_later_file_updates_by_key(spark, tmp_path):
    src = tmp_path / "src"
    spark.sql("select 1L id, 'old' v union all select 2L, 'keep'").coalesce(1).write.parquet(str(src))
    ingest(spark, src, tmp_path)
    spark.sql("select 1L id, 'new' v union all select 3L, 'more'").coalesce(1).write.mode("append").parquet(str(src))
    assert rows(ingest(spark, src, tmp_path)) == [(1, "new"), (2, "keep"), (3, "more")]
    # nothing new: nothing changes
    assert rows(ingest(spark, src, tmp_path)) == [(1, "new"), (2, "keep"), (3, "more")]
