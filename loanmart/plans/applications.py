"""Application mart: one typed row per application document, with one flagged application per client and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.contracts import APPLICATION_PATHS, OVERDUE_HINT, application_columns
from loanmart.functions.scalars import (
    cut_tail,
    drop_first_word,
    floor_div,
    keep_prefix,
    month_stamp,
    parse_timestamp,
    poly_flag,
    present_flag,
    shift_hours,
    status_flag,
)
from loanmart.operators.documents import select_paths
from loanmart.operators.incremental import between_keys
from loanmart.operators.ranking import first_per_group
from loanmart.session import settled

DUPLICATE_PATHS = {"avg_payment": "avg_monthly_payment"}


def flatten_applications(docs: DataFrame) -> DataFrame:
    """The 70 source columns as text, from one parse per document."""
    return select_paths(docs, dict(APPLICATION_PATHS))


def _whole(c: str) -> Column:
    return F.col(c).try_cast("double").cast("bigint")


def type_applications(flat: DataFrame, tz_shift_hours: int = 5) -> DataFrame:
    """Types, dates and derived columns, without the daily flag."""
    typed = flat.withColumns({
        "app_id": F.col("app_id").try_cast("bigint"),
        "app_dt": shift_hours(parse_timestamp("app_dt"), tz_shift_hours),
        "asbt_status": status_flag("asbt_status"),
        "client_id": cut_tail("client_id").try_cast("bigint"),
        "result": poly_flag("result"),
        "birth_date": parse_timestamp("birth_date"),
        "loan_amt": F.when(F.col("loan_amt").isNull(), F.lit(0).cast("bigint")).otherwise(_whole("loan_amt")),
        "asbt_dpd_amt": keep_prefix("asbt_dpd_amt", OVERDUE_HINT),
        "katm_dpd_amt": keep_prefix("katm_dpd_amt", OVERDUE_HINT),
    })
    dated = typed.withColumn("date", F.to_date("app_dt"))
    return dated.withColumns({
        "loan_amt_s": floor_div("loan_amt", 100),
        "month": month_stamp("date"),
        "flag_asbt_dpd": present_flag("asbt_dpd_amt"),
        "flag_katm_dpd": present_flag("katm_dpd_amt"),
        "asbt_dpd_amt": drop_first_word("asbt_dpd_amt"),
        "katm_dpd_amt": drop_first_word("katm_dpd_amt"),
    })


def flag_daily_first(rows: DataFrame) -> DataFrame:
    """Mark one application per client and day: best status, then result, then the latest.

    The winners come from an aggregate, not from a window, so a client with very many applications is no bottleneck;
    they are joined back by the application id.
    """
    best = first_per_group(rows, ["date", "client_id"], ["asbt_status", "result", "app_dt"], "app_id")
    winners = best.select("app_id").distinct().withColumn("_won", F.lit(1))
    flagged = rows.join(winners, "app_id", "left")
    return flagged.withColumn("unique_flag", F.coalesce("_won", F.lit(0))).drop("_won")


def applications(docs: DataFrame, above: int | None = None, upto: int | None = None,
                 tz_shift_hours: int = 5) -> DataFrame:
    """Application documents with ``above < number <= upto`` as the finished mart (76 columns)."""
    if above is not None:
        docs = between_keys(docs, "number", above, upto)
    # documents are far larger than the rows made from them: parse them once
    typed = settled(type_applications(flatten_applications(docs), tz_shift_hours), "applications")
    return flag_daily_first(typed).selectExpr(*[f"`{c}`" for c in application_columns()])


def application_rejects(docs: DataFrame) -> DataFrame:
    """Applications with a value that does not fit its type: id, and the names of the columns at fault."""
    flat = flatten_applications(docs)
    checks = {
        "client_id": cut_tail("client_id").try_cast("bigint"),
        "asbt_status": status_flag("asbt_status"),
        "result": poly_flag("result"),
        "app_dt": parse_timestamp("app_dt"),
        "birth_date": parse_timestamp("birth_date"),
        "loan_amt": _whole("loan_amt"),
    }
    faults = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull() & good.isNull(), F.lit(c)) for c, good in checks.items()
    ]))
    return flat.select("app_id", F.array_join(faults, ", ").alias("reason")).where(F.col("reason") != "")
