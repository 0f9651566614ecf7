"""Interval-valid balances, account roles and day counts.

A balance row is valid on ``[dati, datn)``. All functions reduce to one row per account and day before any window, so a
window partition holds at most one row per day of history, whatever the number of source rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BALANCE_KEYS = ("id_mfo", "account")


def day(value: str | dt.date) -> Column:
    return F.lit(value).cast("date")


def as_of(balances: DataFrame, date: str | dt.date, start: str = "dati", end: str = "datn") -> DataFrame:
    """Rows valid on a date. Plain comparisons with a literal, so both reach the scan."""
    return balances.where((F.col(start) <= day(date)) & (F.col(end) > day(date)))


def balance_on(balances: DataFrame, date: str | dt.date, per: int = 100) -> DataFrame:
    """One absolute balance in major units per account on a date. Overlapping intervals: the latest start counts,
    then the latest end, then the largest amount."""
    rows = as_of(balances, date)
    return rows.groupBy(*BALANCE_KEYS).agg((F.abs(F.max_by("saldo", F.struct("dati", "datn", "saldo"))) / F.lit(per)).alias("balance"))


def account_by_role(accounts: DataFrame, roles: Sequence[int]) -> DataFrame:
    """Active account of each role, long form (glob_id, kod_acc, account); the smallest account where there are several."""
    live = accounts.where((F.col("rec_activ") == 0) & F.col("kod_acc").isin(*roles))
    return live.groupBy("glob_id", "kod_acc").agg(F.min("account").alias("account"))


def role_pivot(accounts: DataFrame, roles: Mapping[int, str]) -> DataFrame:
    """One row per loan with one account column per role: one aggregate instead of a self-join per role."""
    live = accounts.where((F.col("rec_activ") == 0) & F.col("kod_acc").isin(*roles))
    return live.groupBy("glob_id").agg(
        *[F.min(F.when(F.col("kod_acc") == k, F.col("account"))).alias(name) for k, name in roles.items()]
    )


def first_movement(loans: DataFrame, balances: DataFrame) -> DataFrame:
    """First day on or after disbursement on which the loan account moved, per loan (glob_id, first_movement).

    Days of movement and days of disbursement are set in one order per account, each once, and the next movement is the
    minimum of what follows: a shared account costs its days, not its loans times its days.
    """
    loan = loans.select("glob_id", "id_mfo", F.col("acc_new").alias("account"), "date_vyd_d")
    asked = loan.select(*BALANCE_KEYS, F.col("date_vyd_d").alias("_day")).where(F.col("_day").isNotNull()).distinct()
    moves = balances.where(F.col("obor_d") != 0).select(*BALANCE_KEYS, "dati").join(asked, list(BALANCE_KEYS), "left_semi")
    days = asked.withColumn("_moved", F.lit(None).cast("date")).unionByName(
        moves.distinct().select(*BALANCE_KEYS, F.col("dati").alias("_day"), F.col("dati").alias("_moved")))
    on = Window.partitionBy(*BALANCE_KEYS).orderBy("_day").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    nearest = days.withColumn("_next", F.min("_moved").over(on)).where(F.col("_moved").isNull() & F.col("_next").isNotNull())
    hit = loan.join(nearest.select(*BALANCE_KEYS, F.col("_day").alias("date_vyd_d"), "_next"), [*BALANCE_KEYS, "date_vyd_d"])
    return hit.groupBy("glob_id").agg(F.min("_next").alias("first_movement"))


def days_past_due(balances: DataFrame, date: str | dt.date) -> DataFrame:
    """Days from the start of the current unbroken run of non-zero balance to ``date``, per account.

    A run breaks at a zero balance and at a gap between intervals. Accounts whose balance is zero or unknown on the
    date give no row. This is our own definition of the day count.
    """
    history = balances.where(F.col("dati") <= day(date))
    daily = history.groupBy(*BALANCE_KEYS, "dati").agg(
        F.max("datn").alias("datn"), F.max_by("saldo", F.struct("datn", "saldo")).alias("saldo")
    )
    back = Window.partitionBy(*BALANCE_KEYS).orderBy("dati")
    debt = F.coalesce(F.col("saldo") != 0, F.lit(False))
    unbroken = F.coalesce(F.lag(debt).over(back) & (F.lag("datn").over(back) >= F.col("dati")), F.lit(False))
    runs = daily.select(*BALANCE_KEYS, "dati", "datn", debt.alias("debt"), (debt & ~unbroken).alias("opens"))
    last = runs.groupBy(*BALANCE_KEYS).agg(
        F.max(F.when(F.col("opens"), F.col("dati"))).alias("since"),
        F.max_by(F.struct("debt", "datn"), "dati").alias("now"),
    )
    return last.where(F.col("now.debt") & (F.col("now.datn") > day(date))).select(
        *BALANCE_KEYS, F.datediff(day(date), F.col("since")).alias("dpd")
    )
