"""Payment-default days (first, second, third instalment) per loan, and their refresh.

Everything about an account is reduced before it is joined: movements to one row per account, branch and day, amounts to
the three smallest distinct ones. So no task receives all movements of a busy account.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanmart.operators.buckets import read_buckets, upsert_buckets
from loanmart.operators.merge import upsert
from loanmart.operators.ranking import smallest_distinct
from loanmart.operators.temporal import day
from loanmart.session import remove_dir, settle, settled
from loanmart.sources.writers import backup, overwrite

# Account roles that carry overdue amounts, the day limits, and the sentinel for "no default".
OVERDUE_ROLES = (2, 12)
GRACE_DAYS = 5
SECOND_LIMIT_DAYS = 21
NO_DEFAULT = 10000


def loans_in_scope(loans: DataFrame, start: str, end: str, products: Sequence[int]) -> DataFrame:
    return loans.where(
        (F.col("rec_activ") == 0)
        & F.col("k_vid_cred").isin(*products)
        & F.col("date_vyd_d").between(day(start), day(end))
    ).select("glob_id", "id_mfo", "date_vyd_d", "k_vid_cred")


def first_three_dates(schedule: DataFrame) -> DataFrame:
    """First three distinct payment dates per loan; loans with fewer are dropped."""
    ranked = smallest_distinct(schedule, ["glob_id"], "date_gash", 3)
    dates = ranked.groupBy("glob_id").agg(
        *[F.max(F.when(F.col("rank") == n, F.col("date_gash"))).alias(f"p{n}") for n in (1, 2, 3)]
    )
    return dates.where(F.col("p3").isNotNull())


def account_facts(moves: DataFrame) -> DataFrame:
    """What an account's movements (with ``own``: the branch is one of its loans') say, per account and branch.

    ``paid`` runs over all branches of the account; ``d1`` is the smallest overdue amount, ``m1``, ``m2``, ``m3`` the first days of
    the three smallest distinct ones. Days and amounts are two kinds of rows in one plan, so the movements, which are the
    largest input, travel once; a window holds an account's days and distinct amounts per branch, not its movements.
    """
    kinds = moves.withColumn("by_amount", F.explode(F.array(F.lit(False), F.lit(True))))
    reduced = kinds.groupBy(
        "account", "id_mfo", "own", "by_amount",
        F.when(~F.col("by_amount"), F.col("dati")).alias("day"), F.when(F.col("by_amount"), F.col("obor_d_y")).alias("amount"),
    ).agg(F.sum("obor_c").alias("paid_day"), F.max("datn").alias("datn"), F.min("dati").alias("first_day"))
    # rows of the wanted kind come first in each order
    whole = Window.partitionBy("account")
    level = F.when(F.col("by_amount"), F.col("level"))
    own = F.col("own")
    known = (
        reduced.withColumn("paid", F.sum("paid_day").over(whole.orderBy("by_amount", "day")))
        .withColumn("level", F.dense_rank().over(whole.orderBy(F.col("by_amount").desc(), "amount")))
        .withColumns({
            "d1": F.max(F.when((level == 1) & own, F.col("amount"))).over(whole),
            "m1": F.min(F.when((level == 1) & own, F.col("first_day"))).over(whole),
            "m2": F.min(F.when(level == 2, F.col("first_day"))).over(whole),
            "m3": F.min(F.when(level == 3, F.col("first_day"))).over(whole),
        })
    )
    unpaid, covered = F.col("paid") < F.col("d1"), F.col("paid") >= F.col("d1")
    return known.where(~F.col("by_amount")).groupBy("account", "id_mfo").agg(
        F.count("*").alias("n_rows"),
        F.count_if(unpaid).alias("n_unpaid"),
        F.count_if(covered).alias("n_covered"),
        F.min(F.when(covered, F.col("day"))).alias("covered_on"),
        F.max("datn").alias("datn"),
        *[F.max(c).alias(c) for c in ("d1", "m1", "m2", "m3")],
    )


def _min_or_zero(applies: Column, value: Column) -> Column:
    """Smallest over an account's rows of ``value`` where the row is unpaid and the case applies, else 0."""
    applies = F.coalesce(applies, F.lit(False))
    some, all_rows = F.col("n_unpaid") > 0, F.col("n_unpaid") == F.col("n_rows")
    return F.least(F.when(applies & some, value), F.when(~applies | ~all_rows, F.lit(0)))


def default_days(loans: DataFrame, accounts: DataFrame, saldo: DataFrame, schedule: DataFrame, start: str, end: str,
                 products: Sequence[int]) -> DataFrame:
    """One row per loan with a first-payment default: date_vyd_d, glob_id, k_vid_cred, fpd, spd, tpd (days)."""
    scope = loans_in_scope(loans, start, end, products)
    roles = accounts.where(F.col("kod_acc").isin(*OVERDUE_ROLES)).select("glob_id", "account")
    # balances and instalments are cut to the loans in scope before anything else; Spark broadcasts the written key
    # table if its size allows, and shuffles by key otherwise
    held = settled(scope.join(roles, "glob_id"), "default-days-scope")
    moves = saldo.where(F.col("obor_d_y") != 0).select("account", "id_mfo", "dati", "datn", "obor_c", "obor_d_y")
    branches = held.groupBy("account").agg(F.collect_set("id_mfo").alias("branches"))
    moves = moves.join(branches, "account").withColumn("own", F.array_contains("branches", F.col("id_mfo"))).drop("branches")

    # per account and branch first, so that an account shared by many loans is joined as a single row
    per_account = held.join(account_facts(moves), ["account", "id_mfo"])
    # one row per loan and account from here on; it is read three times below
    per_account = settled(per_account, "default-days")
    loan_end = per_account.groupBy("glob_id").agg(F.max("datn").alias("loan_datn"))

    def days(a: str, b: str) -> Column:
        return F.datediff(F.col(a), F.col(b))

    owed = F.col("d1") > 0
    on_time = days("m1", "p1") <= GRACE_DAYS
    n_open = F.when(owed, F.col("n_unpaid")).otherwise(F.lit(0))
    fpd = F.least(
        F.when(on_time, days("covered_on", "m1")),
        F.when(on_time & (n_open > 0), days("loan_datn", "m1")),
        F.when(~on_time | (F.col("n_covered") + n_open < F.col("n_rows")), F.lit(NO_DEFAULT)),
    )
    cases = (
        per_account.where(F.col("m1").isNotNull())
        .join(loan_end, "glob_id")
        .join(first_three_dates(schedule.join(held.select("glob_id"), "glob_id", "left_semi")), "glob_id")
        .where(days("m1", "p2") < SECOND_LIMIT_DAYS)
        .select(
            "glob_id", "account", "date_vyd_d", "k_vid_cred",
            fpd.alias("fpd"),
            _min_or_zero(owed & (days("m2", "p2") <= GRACE_DAYS), days("loan_datn", "m2")).alias("spd_1"),
            _min_or_zero(owed & (days("m1", "p1") >= GRACE_DAYS), days("loan_datn", "m1")).alias("spd_2"),
            _min_or_zero(owed & (days("m3", "p3") <= GRACE_DAYS), days("loan_datn", "m3")).alias("tpd_1"),
            _min_or_zero(owed & (days("m2", "p2") >= GRACE_DAYS), days("loan_datn", "m2")).alias("tpd_2"),
        )
    )
    # an account may serve several loans; its minima run over all of them
    cases = settled(cases, "default-days-cases")
    values = ("fpd", "spd_1", "spd_2", "tpd_1", "tpd_2")
    by_account = cases.groupBy("account").agg(*[F.min(c).alias(c) for c in values])
    late = cases.drop(*values).join(by_account.where(~F.col("fpd").isin(0, NO_DEFAULT)), "account")
    return late.groupBy("date_vyd_d", "glob_id", "k_vid_cred").agg(
        F.max("fpd").alias("fpd"),
        F.max(F.when(F.col("spd_1") == 0, F.col("spd_2")).otherwise(F.col("spd_1"))).alias("spd"),
        F.max(F.when(F.col("tpd_1") == 0, F.col("tpd_2")).otherwise(F.col("tpd_1"))).alias("tpd"),
    )


def refresh(target: DataFrame, fresh: DataFrame, run_date: str) -> DataFrame:
    """Stamp a recomputed window and merge it into the table: days and stamp are updated, new loans are added.

    The recomputed rows go through a staging table, as the merge reads them more than once.
    """
    stamped = settled(fresh.withColumn("date_modified", F.lit(run_date)), "default-days-staging")
    return upsert(target, stamped, ["glob_id"], ["fpd", "spd", "tpd", "date_modified"])


def refresh_window(run_date: dt.date, days: int = 120) -> tuple[str, str]:
    """Disbursement dates to recompute: first of the month ``days`` before this month's first, up to that first."""
    end = run_date.replace(day=1)
    return (end - dt.timedelta(days=days)).replace(day=1).isoformat(), end.isoformat()


def refresh_job(tables: Mapping[str, DataFrame], current: DataFrame, out_path: str, backup_path: str,
                run_date: dt.date, products: Sequence[int], days: int = 120) -> DataFrame:
    """The scheduled refresh: recompute the look-back window, back up the current table, write the merged one.

    ``tables``: loans, accounts, saldo, schedule. The merged table goes to ``out_path``, which must not be the place
    ``current`` is read from; pointing readers to the new place is the switch.
    """
    fresh = default_days(tables["loans"], tables["accounts"], tables["saldo"], tables["schedule"],
                         *refresh_window(run_date, days), products)
    backup(current, backup_path, run_date.isoformat(), "backup_date")
    overwrite(refresh(current, fresh, run_date.isoformat()), out_path)
    return current.sparkSession.read.schema(current.schema).parquet(out_path)


def refresh_buckets(tables: Mapping[str, DataFrame], path: str, bucket: Column, backup_path: str, run_date: dt.date, products: Sequence[int],
                    days: int = 120) -> DataFrame:
    """:func:`refresh_job` on a table of buckets at ``path``: recompute the look-back window, back up, and rewrite in place
    only the buckets that hold its loans."""
    fresh = default_days(tables["loans"], tables["accounts"], tables["saldo"], tables["schedule"], *refresh_window(run_date, days), products)
    spark = fresh.sparkSession
    backup(read_buckets(spark, path), backup_path, run_date.isoformat(), "backup_date")
    upsert_buckets(fresh.withColumn("date_modified", F.lit(run_date.isoformat())), path, ["glob_id"], bucket, ["fpd", "spd", "tpd", "date_modified"])
    return read_buckets(spark, path)


def touched_loans(links: DataFrame, accounts: DataFrame) -> DataFrame:
    """Loans (``glob_id``) whose days may change when ``accounts`` (``account``) have new movements.

    A loan's days depend on its accounts' cases, and an account's on those of all its loans, so both are followed until
    nothing is added. Each round joins keys only and is written; rounds are as many as the longest chain of shared accounts.
    """
    spark = links.sparkSession
    pairs = settled(links.select("glob_id", "account").where("glob_id is not null and account is not null").distinct(), "loan-links")
    found, path = settle(accounts.select("account").distinct().join(pairs, "account").select("glob_id").distinct(), "touched")
    size = found.count()
    while size:
        shared = pairs.join(found, "glob_id", "left_semi").select("account").distinct()
        grown, fresh = settle(pairs.join(shared, "account", "left_semi").select("glob_id").distinct(), "touched")
        before, size = size, grown.count()
        remove_dir(spark, path)
        found, path = grown, fresh
        if size == before:
            break
    return found


def changed_days(tables: Mapping[str, DataFrame], changed: DataFrame, start: str, end: str,
                 products: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """Days of the loans that ``changed`` accounts reach, equal to their rows in a full :func:`default_days`; and those loans.

    A loan that is among the second and not the first has no days now.
    """
    scope = loans_in_scope(tables["loans"], start, end, products)
    held = tables["accounts"].where(F.col("kod_acc").isin(*OVERDUE_ROLES)).join(scope.select("glob_id"), "glob_id", "left_semi")
    loans = touched_loans(held, changed)
    few = tables["loans"].join(loans, "glob_id", "left_semi")
    return default_days(few, tables["accounts"], tables["saldo"], tables["schedule"], start, end, products), loans


def refresh_changed(tables: Mapping[str, DataFrame], changed: DataFrame, path: str, bucket: Column, run_date: dt.date, products: Sequence[int],
                    days: int = 120) -> list[int]:
    """The refresh by change into a table of buckets: only days that ``changed`` accounts reach are recomputed, and only
    the buckets that hold them are rewritten. Loans that have no days any more keep their last ones, as in :func:`refresh`."""
    fresh, _ = changed_days(tables, changed, *refresh_window(run_date, days), products)
    return upsert_buckets(fresh.withColumn("date_modified", F.lit(run_date.isoformat())), path, ["glob_id"], bucket, ["fpd", "spd", "tpd", "date_modified"])
