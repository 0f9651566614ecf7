from __future__ import annotations

import datetime as dt

from loanmart.operators.temporal import as_of, balance_on, days_past_due, first_movement, role_pivot

SCHEMA = "id_mfo int, account bigint, dati date, datn date, saldo bigint, obor_d bigint"


def d(s):
    return dt.date.fromisoformat(s)


def balances(spark, *rows):
    return spark.createDataFrame([(1, a, d(s), d(e), v, v) for a, s, e, v in rows], SCHEMA)


def test_interval_is_half_open(spark):
    df = balances(spark, (1, "2024-01-01", "2024-02-01", 5), (1, "2024-02-01", "2024-03-01", 6),
                  (2, "2024-01-01", "2024-01-10", 7), (2, "2024-01-20", "2024-03-01", 8))
    on = lambda x: sorted((r.account, r.saldo) for r in as_of(df, x).collect())
    assert on("2024-01-01") == [(1, 5), (2, 7)]
    assert on("2024-02-01") == [(1, 6), (2, 8)]
    assert on("2024-01-10") == [(1, 5)]
    assert on("2024-03-01") == []


def test_balance_is_absolute_and_in_major_units(spark):
    df = balances(spark, (1, "2024-01-01", "2024-02-01", -250))
    assert balance_on(df, "2024-01-15").first().balance == 2.5


def test_smallest_active_account_per_role(spark):
    df = spark.createDataFrame(
        [(1, 2, 30, 0), (1, 2, 20, 0), (1, 2, 10, 1), (1, 12, 40, 0), (2, 45, 50, 0)],
        "glob_id bigint, kod_acc int, account bigint, rec_activ int")
    got = [tuple(r) for r in role_pivot(df, {2: "a", 12: "b"}).collect()]
    assert got == [(1, 20, 40)]


def test_days_past_due(spark):
    df = balances(
        spark,
        # unbroken since the second row
        (1, "2024-01-01", "2024-01-05", 0), (1, "2024-01-05", "2024-01-20", 5), (1, "2024-01-20", "2024-02-20", 9),
        # paid off before the date
        (2, "2024-01-01", "2024-01-05", 5), (2, "2024-01-05", "2024-03-05", 0),
        # a gap starts a new run
        (3, "2024-01-01", "2024-01-05", 5), (3, "2024-01-10", "2024-03-05", 5),
        # no interval covers the date
        (4, "2024-01-01", "2024-01-05", 5),
        # starts after the date
        (5, "2024-02-02", "2024-03-05", 5),
        # zero in between
        (6, "2024-01-01", "2024-01-05", 5), (6, "2024-01-05", "2024-01-06", 0), (6, "2024-01-06", "2024-03-05", 5),
    )
    got = {r.account: r.dpd for r in days_past_due(df, "2024-02-01").collect()}
    assert got == {1: 27, 3: 22, 6: 26}


def test_first_movement(spark):
    df = balances(spark, (1, "2024-01-01", "2024-01-05", 3), (1, "2024-01-10", "2024-01-12", 0),
                  (1, "2024-01-15", "2024-01-20", 4))
    loans = spark.createDataFrame([(7, 1, 1, d("2024-01-02")), (8, 1, 1, d("2024-02-02")), (9, 2, 1, d("2024-01-01"))],
                                  "glob_id bigint, id_mfo int, acc_new bigint, date_vyd_d date")
    assert [tuple(r) for r in first_movement(loans, df).collect()] == [(7, d("2024-01-15"))]


def test_first_movement_of_a_shared_account(spark):
    df = balances(spark, *[(1, f"2024-01-{k:02}", f"2024-01-{k + 1:02}", 1 if k % 5 == 0 else 0) for k in range(1, 28)])
    days = [(k, 1, 1, d(f"2024-01-{k:02}")) for k in range(1, 28)] + [(99, 1, 1, None)]
    loans = spark.createDataFrame(days, "glob_id bigint, id_mfo int, acc_new bigint, date_vyd_d date")
    moved = {r.dati for r in df.where("obor_d <> 0").select("dati").collect()}
    want = {k: min(m for m in moved if m >= day) for k, _, _, day in days if day and any(m >= day for m in moved)}
    assert want and {r.glob_id: r.first_movement for r in first_movement(loans, df).collect()} == want
