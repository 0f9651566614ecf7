"""Loan portfolio on a report date, from interval-valid balances."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.functions.scalars import decode, key_from_parts
from loanmart.operators.temporal import account_by_role, balance_on, day, days_past_due
from loanmart.session import settled

# Balance column per account role, in local and in nominal currency.
EQUIVALENT = {2: "ost_pros_ekv", 4: "ost_157_ekv", 12: "ost_proc_ekv", 27: "ost_95413_ekv", 21: "ost_91501_ekv",
              11: "ost_16309_ekv", 18: "ost_16405_ekv"}
NOMINAL = {4: "ost_157_nom", 27: "ost_95413_nom", 21: "ost_91501_nom"}
# nominal balances of these roles count for foreign-currency loans only
FOREIGN_ONLY = (4, 27)
# roles whose days past due are reported
OVERDUE = {2: "ost_pros_ekv", 4: "ost_157_ekv", 12: "ost_proc_ekv"}
# a loan is reported when these sum to something
REPORTED = ("ost_pros_ekv", "ost_proc_ekv", "ost_157_ekv", "ost_95413_ekv", "ost_91501_ekv")
MAIN_ACCOUNT = 0

# Borrower classes.
CRITERIA = ((1, "кр/кл."), (2, "м/бизнес"), (3, "ф/хоз"), (4, "физ."), (5, "частн."), (6, "Work Out кл."))

COLUMNS = (
    "glob_id", "acc_new", "id_mfo", "kod_vals", "k_man", "client", "summa_val", "ost_pros_ekv", "ost_157_ekv",
    "ost_proc_ekv", "ost_kr_ekv", "proc_ss", "date_vyd_d", "date_pog_d", "ost_95413_ekv", "ost_91501_ekv",
    "ost_16309_ekv", "ost_16405_ekv", "ost_157_nom", "ost_95413_nom", "ost_91501_nom", "klasskach", "klass",
    "k_cel_ssudy", "cel", "vid_kr", "k_vid_cred", "criter", "ost_pros_ekv_dpd", "ost_157_ekv_dpd", "ost_proc_ekv_dpd",
    "report_dt",
)


def open_on(date: str) -> Column:
    """Not closed, or closed only after the date."""
    return (F.col("ss_status") != 3) | (
        (F.col("ss_status") == 3) & (F.coalesce("date_stop", "date_start") > day(date))
    )


def open_loans(loans: DataFrame, date: str) -> DataFrame:
    return loans.where(
        F.col("mejbank").isin(0, 1, 3, 4) & ~F.col("kod_sost").isin(9, 10) & (F.col("rec_activ") == 0) & open_on(date)
    )


def loan_balances(loans: DataFrame, accounts: DataFrame, saldo: DataFrame, saldo_val: DataFrame,
                  date: str) -> DataFrame:
    """Balance of every reported role per loan. Each balance table is scanned once for all roles."""
    keys = loans.select("glob_id", "id_mfo", "kod_vals")
    roles = account_by_role(accounts, sorted({*EQUIVALENT, *NOMINAL}))
    by_role = keys.join(roles, "glob_id")
    main = loans.select("glob_id", "id_mfo", "kod_vals", F.lit(MAIN_ACCOUNT).alias("kod_acc"),
                        F.col("acc_new").alias("account"))
    # balances are cut to the accounts of open loans before they are reduced
    local = by_role.unionByName(main)
    local = local.join(balance_on(saldo.join(local, ["id_mfo", "account"], "left_semi"), date), ["id_mfo", "account"])
    nominal = by_role.where(
        F.col("kod_acc").isin(*NOMINAL) & (~F.col("kod_acc").isin(*FOREIGN_ONLY) | (F.col("kod_vals") != 0))
    )
    nominal = nominal.join(balance_on(saldo_val.join(nominal, ["id_mfo", "account"], "left_semi"), date), ["id_mfo", "account"])
    role, amount = F.col("kod_acc"), F.col("balance")
    found = local.select("glob_id", role, amount, F.lit(False).alias("nom"), "account").unionByName(
        nominal.select("glob_id", role, amount, F.lit(True).alias("nom"), "account")
    )
    nom = F.col("nom")
    return found.groupBy("glob_id").agg(
        *[F.max(F.when(~nom & (role == k), amount)).alias(c)
          for k, c in {MAIN_ACCOUNT: "ost_kr_ekv", **EQUIVALENT}.items()],
        *[F.max(F.when(nom & (role == k), amount)).alias(c) for k, c in NOMINAL.items()],
        *[F.max(F.when(~nom & (role == k), F.col("account"))).alias(f"_acc_{k}") for k in OVERDUE],
    )


def overdue_days(balances: DataFrame, saldo: DataFrame, date: str) -> DataFrame:
    """Days past due per loan and overdue role, for the roles with a balance only."""
    owing = balances.select(
        "glob_id", "id_mfo",
        F.inline(F.array(*[
            F.struct(F.lit(k).alias("kod_acc"), F.when(F.col(c) != 0, F.col(f"_acc_{k}")).alias("account"))
            for k, c in OVERDUE.items()
        ])),
    ).where(F.col("account").isNotNull())
    # only the history of owing accounts matters
    owing = settled(owing, "snapshot-owing")
    history = saldo.select("id_mfo", "account", "dati", "datn", "saldo").join(owing, ["id_mfo", "account"], "left_semi")
    days = owing.join(days_past_due(history, date), ["id_mfo", "account"])
    return days.groupBy("glob_id").agg(
        *[F.max(F.when(F.col("kod_acc") == k, F.col("dpd"))).alias(f"{c}_dpd") for k, c in OVERDUE.items()]
    )


def portfolio_snapshot(tables: Mapping[str, DataFrame], date: str, report_dt: str) -> DataFrame:
    """Open loans with any overdue or off-balance amount on ``date``.

    ``tables``: loans, accounts, saldo, saldo_val, classes(kod, name), purposes(kod_gr, kod_pgr, kod, name),
    products(kod, name), statuses(glob_id, crit_cl). Code tables are joined without hints: Spark broadcasts them by
    their measured size.
    """
    loans = open_loans(tables["loans"], date)
    balances = loan_balances(loans, tables["accounts"], tables["saldo"], tables["saldo_val"], date)
    zero_filled = [*EQUIVALENT.values(), *NOMINAL.values()]
    owed = balances.fillna(0.0, subset=zero_filled).where(sum(F.col(c) for c in REPORTED) != 0)
    # one row per reported loan; read for the result and for the search of overdue histories
    owed = settled(owed.join(loans.select("glob_id", "id_mfo"), "glob_id"), "snapshot")
    classes = tables["classes"].select(F.col("kod").alias("klasskach"), F.col("name").alias("klass"))
    products = tables["products"].select(F.col("kod").alias("k_vid_cred"), F.col("name").alias("vid_kr"))
    purposes = tables["purposes"].select(
        key_from_parts("kod_gr", "kod_pgr", "kod").alias("k_cel_ssudy"), F.col("name").alias("cel")
    )
    status = tables["statuses"].select("glob_id", decode("crit_cl", *CRITERIA, default="-").alias("criter"))
    return (
        loans.join(owed.drop("id_mfo"), "glob_id")
        .join(overdue_days(owed, tables["saldo"], date), "glob_id", "left")
        .join(status, "glob_id", "left")
        .join(classes, "klasskach", "left")
        .join(products, "k_vid_cred", "left")
        .join(purposes, "k_cel_ssudy", "left")
        .withColumn("summa_val", F.col("summa") / F.lit(100))
        .withColumn("report_dt", F.lit(report_dt))
        .select(*COLUMNS)
    )
