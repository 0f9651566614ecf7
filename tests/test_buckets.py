"""Tables in buckets, ingest into them, key tables without shuffles, marks from footers, refresh by change."""

from __future__ import annotations

import os
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from loanmart.operators import buckets as bk
from loanmart.operators.incremental import footer_mark, footer_max, incremental_files
from loanmart.operators.merge import upsert
from loanmart.plans.bureau import bureau_split, bureau_tagged, load_tagged
from loanmart.plans.default_days import changed_days, default_days, refresh_changed, touched_loans
from loanmart.streaming import ingest as ing
from tests.test_documents import docs

SCHEMA = "k long, a string, b int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partial_upsert_leaves_other_files(spark, tmp_path):
    path, bucket = str(tmp_path / "t"), bk.hash_bucket(["k"], 16)
    target = spark.createDataFrame([(i, "old", i) for i in range(400)] + [(None, "null", 1)], SCHEMA)
    bk.write_buckets(target, path, bucket)
    before = files(path)
    source = spark.createDataFrame([(7, "new", None), (9999, "more", 1)], SCHEMA)
    touched = bk.upsert_buckets(source, path, ["k"], bucket)
    assert 1 <= len(touched) <= 2
    untouched = {f for f in before if int(f.split("_bucket=")[1].split("/")[0]) not in touched}
    assert untouched and untouched <= files(path) and rows(bk.read_buckets(spark, path)) == rows(upsert(target, source, ["k"]))
    # run again: nothing changes; columns that are not updated stay
    bk.upsert_buckets(source, path, ["k"], bucket)
    assert rows(bk.read_buckets(spark, path)) == rows(upsert(target, source, ["k"]))
    bk.upsert_buckets(spark.createDataFrame([(8, "x", 80)], SCHEMA), path, ["k"], bucket, ["b"])
    assert rows(bk.read_buckets(spark, path).where("k = 8")) == [(8, "old", 80)]
    assert bk.upsert_buckets(source.limit(0), path, ["k"], bucket) == []
    with pytest.raises(Exception, match="duplicate source key"):
        bk.upsert_buckets(spark.createDataFrame([(1, "p", 1), (1, "q", 1)], SCHEMA), path, ["k"], bucket)


def test_a_merge_that_was_broken_off_is_finished(spark, tmp_path, monkeypatch):
    """The driver is lost between the removal of an old bucket and its replacement."""
    import shutil

    path, bucket = str(tmp_path / "t"), bk.hash_bucket(["k"], 4)
    target = spark.createDataFrame([(i, "old", i) for i in range(40)], SCHEMA)
    source = spark.createDataFrame([(i, "new", i) for i in range(30, 50)], SCHEMA)
    bk.write_buckets(target, path, bucket)
    real = bk._write

    def lost(rows, at, mode):
        shutil.rmtree(next((tmp_path / "t").glob("_bucket=*")))
        raise RuntimeError("lost")

    monkeypatch.setattr(bk, "_write", lost)
    with pytest.raises(RuntimeError):
        bk.upsert_buckets(source, path, ["k"], bucket)
    monkeypatch.setattr(bk, "_write", real)
    assert bk.read_buckets(spark, path).count() < 50
    bk.upsert_buckets(spark.createDataFrame([(99, "next", 1)], SCHEMA), path, ["k"], bucket)
    want = rows(upsert(target, source, ["k"]).union(spark.createDataFrame([(99, "next", 1)], SCHEMA)))
    assert rows(bk.read_buckets(spark, path)) == want and not bk.recover(spark, path)


def test_random_partial_upserts(spark, tmp_path):
    rng, path, bucket, want = random.Random(1), str(tmp_path / "t"), bk.hash_bucket(["k"], 5), {}
    for _ in range(4):
        batch = {rng.randrange(60): (rng.choice("abc"), rng.randrange(9)) for _ in range(rng.randrange(1, 20))}
        want |= batch
        bk.upsert_buckets(spark.createDataFrame([(k, *v) for k, v in batch.items()], SCHEMA), path, ["k"], bucket)
        assert rows(bk.read_buckets(spark, path)) == sorted(((k, *v) for k, v in want.items()), key=repr)


def test_a_second_batch_reads_touched_buckets_only(spark, tmp_path):
    target, keys = str(tmp_path / "t"), ["id"]
    store = ing.merge_batch(target, keys, buckets=16)

    def batch(name, seconds, *ids):
        frame = spark.createDataFrame([(i, name) for i in ids], "id long, v string")
        return frame.withColumns({"source_file": F.lit(name), "arrived": F.timestamp_seconds(F.lit(seconds))})

    store(batch("a", 100, *range(300)), 0)
    first = files(target)
    store(batch("b", 200, 5, 1000), 1)
    now = files(target)
    assert len(first & now) >= len(first) - 2 and len({f.split("_bucket=")[1].split("/")[0] for f in now}) == 16
    table = rows(ing.current(spark, target))
    assert table == sorted([(i, "b" if i == 5 else "a") for i in range(300)] + [(1000, "b")], key=repr)
    # an old batch that comes again, and the same one twice, change nothing
    store(batch("a", 100, *range(300)), 7)
    store(batch("b", 200, 5, 1000), 1)
    assert rows(ing.current(spark, target)) == table


def test_rows_without_a_key_and_no_files_at_all(spark, tmp_path):
    src, target = tmp_path / "in", str(tmp_path / "t")
    src.mkdir()
    assert ing.stream_ingest(spark, str(src), "id long, v string", target, str(tmp_path / "c"), ["id"]).collect() == []
    spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "id long, v string").coalesce(1).write.mode("append").parquet(str(src))
    for checkpoint in ("c", "c", "other"):  # nothing new, then a lost checkpoint
        got = ing.stream_ingest(spark, str(src), "id long, v string", target, str(tmp_path / checkpoint), ["id"])
        assert rows(got) == [(1, "c"), (None, "a"), (None, "b")]


def test_partitions_do_not_grow_with_files(spark, tmp_path):
    src, target = tmp_path / "in", str(tmp_path / "t")
    for i in range(12):
        spark.range(i, i + 3).withColumn("v", F.lit(str(i))).coalesce(1).write.mode("append").parquet(str(src))
    ing.stream_ingest(spark, str(src), "id long, v string", target, str(tmp_path / "c"), ["id"], files_per_batch=5, buckets=4)
    assert sorted(d for d in os.listdir(target) if d.startswith("_bucket")) == [f"_bucket={i}" for i in range(4)]


def test_waiting_for_a_file(spark, tmp_path):
    src, ready = tmp_path / "in", tmp_path / "ready"
    src.mkdir()
    spark.range(5).withColumn("v", F.lit("x")).coalesce(1).write.parquet(str(ready))
    late = next(ready.glob("part-*"))

    def stream():
        return ing.arriving(spark, str(src), "id long, v string")

    at = time.monotonic()
    assert not ing.load_when_arrived(stream(), str(tmp_path / "t"), str(tmp_path / "c"), ["id"], wait_s=2, poke_s=0.3)
    assert 1.5 < time.monotonic() - at < 20 and not (tmp_path / "t").exists()
    mover = threading.Timer(1.5, lambda: os.rename(late, src / "late.parquet"))
    mover.start()
    at = time.monotonic()
    assert ing.load_when_arrived(stream(), str(tmp_path / "t"), str(tmp_path / "c"), ["id"], wait_s=60, poke_s=0.3)
    assert time.monotonic() - at < 50 and ing.current(spark, str(tmp_path / "t")).count() == 5


def test_key_tables_join_without_a_shuffle(spark, tmp_path):
    rng, names = random.Random(3), ("bucketed_parent", "bucketed_child")
    parent = [(rng.randrange(80), rng.randrange(4)) for _ in range(300)]
    child = [(rng.randrange(80),) for _ in range(40)]
    try:
        p = bk.write_key_table(spark.createDataFrame(parent, "number long, n int"), names[0], ["number"], 4, str(tmp_path / "p"))
        c = bk.write_key_table(spark.createDataFrame(child, "number long"), names[1], ["number"], 4, str(tmp_path / "c"))
        found = bk.backfill_bucketed(p, c, "number", F.col("n") != 0)
        assert "Exchange" not in plan(found)
        assert sorted(r.number for r in found.collect()) == sorted({k for k, n in parent if n} - {k for k, in child})
        few = bk.only_keys_bucketed(p, c, "number")
        assert "Exchange" not in plan(few) and few.count() == sum((k,) in child for k, _ in parent)
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_marks_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1, 500, 3).withColumn("v", F.lit("x")).repartition(3).write.parquet(path)
    assert footer_max(spark, path, "id") == 499
    assert "PushedAggregation: [MAX(id)]" in plan(footer_mark(spark, path, "id"))
    assert rows(incremental_files(spark.range(490, 503), path, "id")) == [(500,), (501,), (502,)]
    spark.range(0).write.parquet(path + "0")
    assert footer_max(spark, path + "0", "id") is None and incremental_files(spark.range(3), path + "0", "id").count() == 3
    with pytest.raises(ValueError):
        footer_max(spark, path, "v")
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_rows_and_rejects_in_one_scan(spark, tmp_path):
    from loanmart.contracts import ENTITIES
    from tests.test_documents import at

    e = ENTITIES["contracts"]
    given = docs(spark, at(e.path, [{"contract_id": "a"}, 5, None, {"contract_id": "b"}]), at(e.path, {"contract_id": "c"}), at(e.path, "x"), None)
    given.write.parquet(str(tmp_path / "docs"))
    given = spark.read.parquet(str(tmp_path / "docs"))
    assert plan(bureau_tagged(given, "contracts")).count("FileScan") == 1
    counts = load_tagged(given, "contracts", str(tmp_path / "out"))
    good, bad = bureau_split(given, "contracts")
    assert counts == {"row": good.count(), "reject": bad.count()} and counts["row"] == 3
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows(back.where("kind = 'row'").select("row.contract_id")) == [("a",), ("b",), ("c",)]
    assert rows(back.where("kind = 'reject'").select("raw")) == rows(bad.select("raw"))


def lending(spark, seed):
    rng = random.Random(seed)
    day = lambda n: f"2024-{1 + n // 28:02d}-{1 + n % 28:02d}"
    loans = [(i, 1, 0, rng.choice((24, 34, 32, 11)), day(rng.randrange(40))) for i in range(60)]
    links = [(i, rng.choice((2, 12)), rng.randrange(30) if rng.random() < 0.7 else 100 + i) for i in range(60) for _ in range(rng.randrange(1, 3))]
    saldo = [(a, 1, day(d := rng.randrange(300)), day(d + rng.randrange(1, 20)), rng.randrange(3), rng.choice((0, 1, 1, 2, 3))) for a in {x[2] for x in links} for _ in range(6)]
    schedule = [(i, day(n)) for i in range(60) for n in sorted(rng.sample(range(20, 200), 4))]
    date = lambda df, *cols: df.withColumns({c: F.col(c).cast("date") for c in cols})
    return {
        "loans": date(spark.createDataFrame(loans, "glob_id long, id_mfo int, rec_activ int, k_vid_cred int, date_vyd_d string"), "date_vyd_d"),
        "accounts": spark.createDataFrame(links, "glob_id long, kod_acc int, account long"),
        "saldo": date(spark.createDataFrame(saldo, "account long, id_mfo int, dati string, datn string, obor_c long, obor_d_y long"), "dati", "datn"),
        "schedule": date(spark.createDataFrame(schedule, "glob_id long, date_gash string"), "date_gash"),
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_refresh_by_change_equals_the_full_one(spark, seed, tmp_path):
    import datetime as dt

    t, span, products = lending(spark, seed), ("2024-01-01", "2024-12-31"), (24, 34, 32)
    changed = spark.createDataFrame([(a,) for a in (3, 101, 7777)], "account long")
    full = {r.glob_id: tuple(r) for r in default_days(t["loans"], t["accounts"], t["saldo"], t["schedule"], *span, products).collect()}
    fresh, loans = changed_days(t, changed, *span, products)
    reached = {r.glob_id for r in loans.collect()}
    assert {r.glob_id: tuple(r) for r in fresh.collect()} == {g: r for g, r in full.items() if g in reached}
    # with the changed accounts' movements taken away, the days of all other loans are the same
    before = {**t, "saldo": t["saldo"].join(changed, "account", "left_anti")}
    old = {r.glob_id: tuple(r) for r in default_days(before["loans"], before["accounts"], before["saldo"], before["schedule"], *span, products).collect()}
    assert {g: r for g, r in old.items() if g not in reached} == {g: r for g, r in full.items() if g not in reached}
    path, bucket = str(tmp_path / "days"), bk.hash_bucket(["glob_id"], 8)
    bk.write_buckets(default_days(before["loans"], before["accounts"], before["saldo"], before["schedule"], *span, products).withColumn("date_modified", F.lit("2024-01-01")), path, bucket)
    refresh_changed(t, changed, path, bucket, dt.date(2024, 3, 10), products)
    assert bk.read_buckets(spark, path).count() >= len(old)


def test_touched_loans_follow_shared_accounts(spark):
    links = spark.createDataFrame([(1, 10), (2, 10), (2, 20), (3, 20), (3, 30), (4, 40), (None, 10), (5, None)], "glob_id long, account long")
    assert rows(touched_loans(links, spark.createDataFrame([(30,), (99,)], "account long"))) == [(1,), (2,), (3,)]
    assert rows(touched_loans(links, spark.createDataFrame([(99,), (None,)], "account long"))) == []
