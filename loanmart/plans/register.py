"""Contract register: loans with client, code names, role accounts and first movement."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.functions.scalars import clamp_date, concat_text, decode, nvl, nvl_text, pad_code
from loanmart.operators.temporal import BALANCE_KEYS, day, first_movement, role_pivot
from loanmart.session import settled

# Labels of the commission and credit-line codes.
COMMISSION = ((0, "Процент от суммы кредита"), (1, "Фиксир.сумма"), (2, "Наличная сумма"))
NO_COMMISSION = "нет"
CREDIT_LINE = ((1, "Откр."), (2, "Откр.с умен.лимита"))
CLOSED_LINE = "закрытыя"

# Accounts shown beside the loan account.
ROLES = {2: "acc_pros", 1: "acc_ras"}

CLOSED = 3


def _names(table: DataFrame, key: str, out: str, *more: str) -> DataFrame:
    return table.select(F.col("kod").alias(key), F.col("name").alias(out), *more)


def loans_in_period(loans: DataFrame, start: str, end: str) -> DataFrame:
    return loans.where(
        (F.col("rec_activ") == 0) & (F.col("kod_sost") > 2) & F.col("date_vyd_d").between(day(start), day(end))
    )


def _labelled(code: str, name: str, joint: str = " ") -> Column:
    """``code joint name``; the joint stays when the name is missing, as null parts count as empty."""
    return nvl_text(concat_text(code, F.lit(joint), name), "0")


def contract_register(tables: Mapping[str, DataFrame], start: str, end: str) -> DataFrame:
    """Register of loans disbursed in ``[start, end]``, 48 columns, nulls replaced by the target's defaults.

    ``tables``: loans, loan_accounts, saldo, accounts, clients, licences, applications, and the code tables states,
    currencies, purposes, sectors, sources, grades, tax_offices, provinces, districts, staff, products, collateral_kinds.
    Code tables carry no broadcast hint: Spark broadcasts those that prove small.
    """
    loans = loans_in_period(tables["loans"], start, end)
    # movements are looked up for the loans of the period only
    keys = settled(loans.select("glob_id", "id_mfo", "acc_new", "date_vyd_d"), "register-loans")
    moves = tables["saldo"].join(keys.select("id_mfo", F.col("acc_new").alias("account")), list(BALANCE_KEYS), "left_semi")
    accounts = tables["accounts"].select("id_mfo", F.col("account_new").alias("acc_new"), "id_client")
    licences = tables["licences"].groupBy("id_client").agg(F.max("date_end").alias("liz_end"))
    jobs = (
        tables["applications"].where(F.col("rec_activ") == 0)
        .groupBy(F.col("glob_id").alias("id_apl")).agg(F.max("count_work_place").alias("kol_work"))
    )
    # one row per client, so that the loans are shuffled by client once and a client with very many loans can be split
    clients = tables["clients"].join(licences, "id_client", "left")
    grades = tables["grades"].select(F.col("klass_id").alias("kreditospos"), "klass_name")
    staff = tables["staff"].select(F.col("kod").alias("inspect"), "id_mfo", "fio")

    joined = (
        loans.join(role_pivot(tables["loan_accounts"], ROLES), "glob_id", "left")
        .join(first_movement(keys, moves), "glob_id", "left")
        .join(jobs, "id_apl", "left")
        .join(accounts, ["id_mfo", "acc_new"])
        .join(clients, "id_client")
        .join(_names(tables["states"], "kod_sost", "name_sost_"), "kod_sost", "left")
        .join(_names(tables["currencies"], "kod_vals", "val_name"), "kod_vals", "left")
        .join(_names(tables["purposes"], "k_cel_ssudy", "cel_name"), "k_cel_ssudy", "left")
        .join(_names(tables["sectors"], "kod_sector", "sector_name", F.col("kod").alias("sector_kod")),
              "kod_sector", "left")
        .join(_names(tables["sources"], "k_ist_cred", "ist_name"), "k_ist_cred", "left")
        .join(grades, "kreditospos", "left")
        .join(_names(tables["tax_offices"], "kod_nalog_org", "gni_name"), "kod_nalog_org", "left")
        .join(_names(tables["provinces"], "kod_obl", "obl_name", F.col("kod").alias("obl_kod")), "kod_obl", "left")
        .join(_names(tables["districts"], "kod_reg", "reg_name", F.col("kod").alias("reg_kod")), "kod_reg", "left")
        .join(staff, ["inspect", "id_mfo"], "left")
        .join(_names(tables["products"], "k_vid_cred", "vid_name"), "k_vid_cred", "left")
        .join(_names(tables["collateral_kinds"], "k_type_obesp", "obesp_name"), "k_type_obesp", "left")
    )
    closed_on = F.when(F.col("ss_status") == CLOSED, F.col("date_stop"))
    return joined.select(
        nvl("numdog", 0).alias("dog_num"),
        nvl("id_mfo", 0).alias("id_mfo"),
        nvl("kod_vals", 0).alias("kod_val"),
        nvl_text("client", "0").alias("client"),
        nvl_text(concat_text(pad_code("kod_vals"), F.lit("-"), "val_name"), "0").alias("name_val"),
        nvl_text("acc_new", "0").alias("acc_new"),
        nvl_text("acc_pros", "0").alias("acc_pros"),
        nvl_text("acc_ras", "0").alias("acc_ras"),
        nvl("proc_ss", 0).alias("proc_ss"),
        nvl("proc_pr", 0).alias("proc_pr"),
        nvl(F.col("summa") / F.lit(1000), 0.0).alias("summa"),
        clamp_date("date_vyd_d").alias("date_vyd_d"),
        clamp_date("date_pog_d").alias("date_pog_d"),
        clamp_date(closed_on).alias("dat_pogash"),
        nvl_text("cel_name", "0").alias("name_cel"),
        nvl_text("name_sost_", "0").alias("name_sost"),
        nvl("k_man", 0).alias("k_man"),
        nvl("glob_id", 0).alias("glob_id"),
        nvl("id_apl", 0).alias("id_apl"),
        _labelled("kreditospos", "klass_name", "_").alias("n_kreditospos"),
        _labelled("inspect", "fio", "_").alias("inspect"),
        nvl("ss_status", 0).alias("ss_status"),
        clamp_date("date_stop").alias("date_stop"),
        decode("k_commis", *COMMISSION, default=NO_COMMISSION).alias("k_commis"),
        decode("k_cred_line", *CREDIT_LINE, default=CLOSED_LINE).alias("n_line"),
        nvl("val_com", 0).alias("val_com"),
        nvl("pr_serv", 0).alias("pr_serv"),
        nvl("k_vid_cred", 0).alias("k_vid_cred"),
        nvl("k_type_obesp", 0).alias("k_type_obesp"),
        nvl(F.col("sumobesp") / F.lit(1000), 0.0).alias("s_obesp"),
        nvl("id_client", 0).alias("id_cl"),
        clamp_date("pas_date_exp_director").alias("pas_end"),
        nvl_text("post_adr", "0").alias("post_adr"),
        clamp_date("date_reg").alias("date_reg"),
        nvl("num_nalog", 0).alias("num_nalog"),
        _labelled("kod_nalog_org", "gni_name", "_").alias("n_gni"),
        nvl_text("pas_ser_director", "0").alias("ser_pas"),
        nvl_text("pas_num_director", "0").alias("num_pas"),
        _labelled("sector_kod", "sector_name").alias("n_sector"),
        nvl_text("ist_name", "0").alias("n_ist"),
        _labelled("obl_kod", "obl_name").alias("n_obl"),
        _labelled("reg_kod", "reg_name").alias("n_reg"),
        clamp_date("date_birth").alias("date_birth"),
        clamp_date("liz_end").alias("liz_end"),
        clamp_date("first_movement").alias("dat_vyd"),
        nvl_text("vid_name", "0").alias("n_vid_cred"),
        nvl_text("obesp_name", "0").alias("n_obesp"),
        nvl("kol_work", 0).alias("kol_work"),
    )
