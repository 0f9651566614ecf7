"""Column contracts and the map from bureau documents to tables.

An :class:`Entity` names where a child lives in a document, which parent values travel with it, and the fixed column
list of the target table. ``unnest`` (see ``operators.documents``) turns an entity into rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Columns that are numbers in every table; all other raw columns are text.
NUMBER_COLUMNS = {"number"}


def words(text: str) -> tuple[str, ...]:
    return tuple(text.split())


def raw_schema(columns) -> T.StructType:
    """Raw-zone schema of a contract: text everywhere except the document number."""
    return T.StructType(
        [T.StructField(c, T.LongType() if c in NUMBER_COLUMNS else T.StringType()) for c in columns]
    )


def read_contract(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column list from a text file with one column per line (a few dozen lines, so it is read by the driver)."""
    lines = spark.read.text(path, wholetext=True).first()[0].splitlines()
    return tuple(c.strip() for c in lines if c.strip())


@dataclass(frozen=True)
class Entity:
    """One target table.

    path      dotted path of the child: one object or a list of objects
    columns   column contract, in order
    parents   output column -> document column, or dotted path inside the document
    nested    (wrapper, child) pair inside the child for the second level, else None
    carry     output column -> field of the outer child, kept beside the second level
    rename    output column -> field of the child, where the names differ
    child_wins  on a name clash the child's own field is taken
    essential   key columns added at the end when the contract lacks them
    """

    name: str
    path: str
    columns: tuple[str, ...]
    parents: Mapping[str, str] = field(default_factory=dict)
    nested: tuple[str, str] | None = None
    carry: Mapping[str, str] = field(default_factory=dict)
    rename: Mapping[str, str] = field(default_factory=dict)
    child_wins: bool = True
    essential: tuple[str, ...] = ("_id", "number")

    @property
    def output(self) -> tuple[str, ...]:
        return (*self.columns, *[c for c in self.essential if c not in self.columns])


# ---------------------------------------------------------------------------------------------------------------------
# Column lists and document paths of the bureau tables. They define the data format.
# ---------------------------------------------------------------------------------------------------------------------

CONTRACTS = words("""
    _id number org branch org_name org_type contract_status contract_id contract_date contract_date_change
    contract_end_date contract_end_date_change contract_closing_date claim_id claim_date claim_id_change
    juridical_status credit_type currency percent percent_change security_qty class_asset_quality
    class_asset_quality_change reserve_bal_sum reserve_bal_change amount amount_change amount_issued
    amount_issued_change actual_monthly_average_payment actual_monthly_average_payment_change
    closed_lawsuit_principal_sum closed_lawsuit_principal_sum_change closed_offbalance_princial_sum
    closed_offbalance_princial_sum_change closed_offbalance_percent_sum closed_offbalance_percent_sum_change
    total_debt_sum""")

CONTINGENT_LIABILITIES = words("""
    _id number subject_type org branch org_name contract_status contract_id contract_date contract_end_date
    contract_closing_date credit_type currency amount amount_change security_amount total_debt_sum
    total_debt_sum_change overdue_debt_sum overdue_debt_sum_change percent percent_change max_current_overdue
    max_current_overdue_change max_overdue_principal max_overdue_principal_change
    max_current_uninter_overdue_percent max_current_uninter_overdue_percent_change max_uninter_overdue_percent
    max_uninter_overdue_percent_change""")

OPEN_CONTRACTS = words("""
    _id number monthly_average_payment total_debt_sum overdue_debt_sum org contract_id branch org_name currency""")

OVERDUE_PRINCIPALS = words("""
    number contract_id overdue_principal_sum overdue_date overdue_principal_change overdue_principal_days _id""")

# Assumption: the published list for this table repeats the principal names; the procent names follow the same pattern.
OVERDUE_PROCENTS = words("""
    number contract_id overdue_procent_sum overdue_date overdue_procent_change overdue_procent_days _id""")

OVERVIEW = words("""
    _id number claims_qty contracts_qty contingent_liabilities_qty credit_request_qty subscriptions_qty
    average_monthly_payment overdue_principal_qty max_overdue_principal_days max_overdue_principal_sum
    max_uninter_overdue_percent_days total_overdue_percent_sum actual_average_monthly_payment""")

SCORING = words("_id number scoring_version scoring_grade scoring_class scoring_level")

RESULTS = words("""
    number clientId is_ok expired_summa is_exists_stop_factor summa_other_mikrozaym summa_other_avtocredit
    summa_other_ipoteka today_payment loan_summa num_all_credits_ib num_all_other num_all_IB bureau_segment
    num_active_micro_ib sum_active_micro_ib scoring_level scoring_class scoring_grade score_cutoff
    current_dlq_bureau current_dlq_total""")

RESULTS_ERRORS = words("""
    number clientId is_ok bureau_segment score_cutoff current_dlq_bureau current_dlq_total errmsg message hint""")

CLAIMS_WO_CONTRACTS = words("""
    _id number rejection_date summa org claim_id credit_duration rejection_reason currency org_name branch
    claim_date""")

CLIENT = words("""
    _id number pinfl live_address registration_district birth_date inn client_type founders oked email_change
    katm_sir juridical_status name live_address_change registration_address email registration_address_change""")

CREDIT_REQS = words("""
    _id number org user_id claim_id report_type consent_date org_name demand_date_time branch consent_id""")

SCORING_DYNAMICS = words("_id number period score_point score_date")

PHONES = words("_id number phone_number phone_number_change")

SYSINFO = words("""
    _id number subject_type org claim_id report_type branch demand_id user_id consent_date report_name org_name
    demand_date_time consent_id claim_date""")

LOAN_FIELDS = words("""
    uuid inf_confirm_date currency relationship open_date final_pmt_date fact_close_date type credit_limit
    cur_to_base_limit outstanding pmt_string_60m status next_pmt previous_pmt initial_pmt ttl_delq_7 ttl_delq_8_29
    ttl_delq_30_59 ttl_delq_60_89 ttl_delq_90_119 ttl_delq_120_plus pmt_freq delq_balance max_delq_balance is_own
    current_delq pmt_string_start interest_rate last_payment_date next_payment_date curr_balance_amt collateral_code
    business_category principal_outstanding principal_past_due int_outstanding int_past_due other_outstanding
    other_past_due ensured_amount coborrowers_count next_pmt_principal next_pmt_principal_date next_pmt_interest
    next_pmt_interest_date principal_repayment_amount principal_repaid_amount""")

GENERAL_CBR_LOANS = ("number", "id", *LOAN_FIELDS)

GENERAL_CBR_SCORES = words("number client_id card_id score_value score_date score_name")

LOANS_OVERVIEW = words("""
    number id inquiry_1_week loans_coborrower loans_main_borrower inquiry_recent_period first_loan_date ttl_accounts
    ttl_delq_60_89 inquiry_9_month inquiry_12_month ttl_delq_90_plus inquiry_3_month ttl_delq_30_l24m loans_active
    loans_active_coborrower ttl_delq_30_59_l24m max_overdue_status inquiry_6_month ttl_inquiries ttl_delq_30
    inquiry_1_month ttl_delq_90_119_l24m inquiry_1_day ttl_delq_60_89_l24m worst_status_ever last_loan_date
    ttl_delq_120_plus_l24m pay_load ttl_delq_30_59""")

COLLATERALS = words("""
    number uuid client_id collateral_code collateral_id open_date value currency end_date fact_end_date""")

GUARANTORS = words("number uuid_loan client_id uuid_gtr sum currency open_date end_date fact_end_date")

PAYMENTS = words("""
    number uuid client_id payment_date payment_amount currency payment_amount_principal payment_amount_interest
    payment_amount_other total_payment_amount total_payment_principal total_payment_interest total_payment_other
    payment_terms_compliance""")

MONTHLY_DETAIL = words("""
    number client_id uuid date history_date status worst_status pmt_pat delq_balance max_delq_balance next_pmt
    outstanding balance_amt""")

CREDIT_LIST = words("""
    number idMfo id globId nikiId numDog dateDog client namAcc idClient accNew status inspect kodVal kodSost procSs
    procPr basPer dateVydD datePogD sumRas mejBank summa sumObesp srok vidCred celSsudy typeOpesp istCred numTran
    charVal namStatus nameIns nameType saldo repaymentAccount repaymentAccountRest summaGashP summaPr summaPrOsn
    summaPrProc summaGNext dateGash summaGMin saldoIn saldoF""")

EMPLOYER = words("_id number inn title type regionID")

REPORT_077 = "data.katm_077.return.data"
RESULT_077 = "data.katm_077.result"
CACHE_077 = "reports.077"
REPORT_333 = "data.katm_333.return.data.general_cbr"

_KEYS = {"_id": "_id", "number": "number"}
_RESULT = {"number": "number", "clientId": "request.clientId", "is_ok": f"{RESULT_077}.is_ok"}
_LOAN = {"number": "number", "client_id": "request.clientId"}


def _online(name, tail, columns, **kw):
    return Entity(name, f"{REPORT_077}.{tail}", columns, _KEYS, **kw)


def _offline(name, tail, columns, **kw):
    # the cache has no document number; the column stays null
    return Entity(name, f"{CACHE_077}.{tail}", columns, {"_id": "_id"}, **kw)


def _overdue(which):
    return {"nested": (f"overdue_{which}s", f"overdue_{which}"), "carry": {"contract_id": "contract_id"}}


def _per_loan(name, columns, child, uuid="uuid", rename=None):
    return Entity(
        name, f"{REPORT_333}.loans.loan", columns, _LOAN,
        nested=(f"{child}s", child), carry={uuid: "uuid"}, rename=rename or {}, child_wins=False, essential=(),
    )


_ALL = [
    _online("contingent_liabilities", "contingent_liabilities.contingent_liability", CONTINGENT_LIABILITIES),
    _online("contracts", "contracts.contract", CONTRACTS),
    _online("open_contracts", "open_contracts.open_contract", OPEN_CONTRACTS),
    Entity("overdue_principals", f"{REPORT_077}.contracts.contract", OVERDUE_PRINCIPALS, {"number": "number"},
           **_overdue("principal")),
    Entity("overdue_procents", f"{REPORT_077}.contracts.contract", OVERDUE_PROCENTS, {"number": "number"},
           **_overdue("procent")),
    _online("overview", "overview", OVERVIEW),
    _online("scoring", "scorring", SCORING),
    Entity("results", f"{RESULT_077}.data", RESULTS, _RESULT),
    Entity("results_errors", f"{RESULT_077}.error", RESULTS_ERRORS, {**_RESULT, "hint": f"{RESULT_077}.hint"}),
    _offline("contingent_liabilities_offline", "contingent_liabilities.contingent_liability",
             CONTINGENT_LIABILITIES),
    _offline("contracts_offline", "contracts.contract", CONTRACTS),
    _offline("open_contracts_offline", "open_contracts.open_contract", OPEN_CONTRACTS),
    _offline("overdue_principals_offline", "contracts.contract", OVERDUE_PRINCIPALS, **_overdue("principal")),
    _offline("overdue_procents_offline", "contracts.contract", OVERDUE_PROCENTS, **_overdue("procent")),
    _offline("overview_offline", "overview", OVERVIEW),
    # Column lists without a published path; the paths are assumed to follow the pattern of their neighbours.
    _online("claims_wo_contracts", "claims_wo_contracts.claim_wo_contracts", CLAIMS_WO_CONTRACTS),
    _online("client", "client", CLIENT),
    _online("credit_reqs", "credit_reqs.credit_req", CREDIT_REQS),
    _online("dynamics_of_scoring_ball", "dynamics_of_scoring_ball", SCORING_DYNAMICS),
    _online("phones", "phones.phone", PHONES),
    _online("sysinfo", "sysinfo", SYSINFO),
    Entity("open_contracts_333", f"{REPORT_333}.open_contracts.open_contract", LOAN_FIELDS, essential=()),
    Entity("general_cbr_loans", f"{REPORT_333}.loans.loan", GENERAL_CBR_LOANS,
           {"number": "number", "id": "request.clientId"}, essential=()),
    Entity("general_cbr_scores", f"{REPORT_333}.scores.score", GENERAL_CBR_SCORES,
           {"number": "number", "client_id": "request.clientId"}, essential=()),
    Entity("loans_overview", f"{REPORT_333}.loans_overview", LOANS_OVERVIEW,
           {"number": "number", "id": "request.clientId"}, essential=()),
    _per_loan("collaterals", COLLATERALS, "collateral"),
    _per_loan("guarantors", GUARANTORS, "guarantor", uuid="uuid_loan", rename={"uuid_gtr": "uuid"}),
    _per_loan("payments", PAYMENTS, "payment"),
    _per_loan("monthly_detail", MONTHLY_DETAIL, "monthly_detail"),
    Entity("credit_list", "data.asbt_credit_list.return.object", CREDIT_LIST, {"number": "number"}),
    Entity("employer", "data.uzasbo_salary.result.data.lastEmployer", EMPLOYER, _KEYS),
]

ENTITIES: dict[str, Entity] = {e.name: e for e in _ALL}

# Paths of the tables that carry a single value beside the document number.
HINT_PATH = f"{RESULT_077}.hint"
CACHE_ID_PATH = "credit.katm_cache_id"

# The application mart reads these document paths under these names, in this order.
APPLICATION_PATHS: tuple[tuple[str, str], ...] = (
    ("loan_type", "type"),
    ("app_id", "number"),
    ("app_dt", "created"),
    ("status", "status"),
    ("client_id", "request.clientId"),
    ("request_id", "request.requestId"),
    ("credprogid", "request.credProgId"),
    ("loan_amt", "request.amount"),
    ("asbt_status", "asbt.status"),
    ("asbt_comment", "asbt.statusName"),
    ("fio", "data.asbt_service_client.result.data.fio"),
    ("phone", "data.asbt_service_client.result.data.phone"),
    ("pinfl", "data.asbt_service_client.result.data.pinfl"),
    ("id_series", "data.asbt_service_client.result.data.pasSer"),
    ("id_number", "data.asbt_service_client.result.data.pasNum"),
    ("birth_date", "data.asbt_service_client.result.data.dateBirth"),
    ("address", "data.asbt_service_client.result.data.postAdr"),
    ("avg_salary", "data._salary.result.data.avgByMonthReal"),
    ("salary_source", "data._salary.result.data.salary_from"),
    ("employer_INN", "data._salary.result.data.lastEmployer.inn"),
    ("employer_name", "data._salary.result.data.lastEmployer.title"),
    ("avg_monthly_payment", "data.katm_077.result.data.today_payment"),
    ("result", "result.is_ok"),
    ("error", "result.error.errmsg"),
    ("error_detail", "result.error.message"),
    ("avg_payment", "data.katm_077.result.data.today_payment"),
    ("overall_debt", "data.katm_077.result.data.loan_summa"),
    ("avg_remainder", "data.crm_light_check_stop_factor.result.data.credit.avg_remainder"),
    ("annuitet_cash", "data.crm_light_check_stop_factor.result.data.credit.annuitet_cash"),
    ("region_residence", "data.asbt_service_client.result.data.kodOblAddress"),
    ("Interest_rate", "request.rate"),
    ("Term", "request.term"),
    ("katm_dpd_amt", "data.katm_077.result.hint"),
    ("asbt_dpd_amt", "data.asbt_credit_list.result.hint"),
    ("duration_sec", "duration_sec"),
    ("uzasbo_working", "data.uzasbo_working.return.Success"),
    ("summa_limit", "response.data.summaLimit"),
    ("segment", "response.data.segment"),
    ("scoring_grade", "data.katm_077.return.data.scorring.scoring_grade"),
    ("kodOblAddress", "data.asbt_service_client.return.object.kodOblAddress"),
    ("kodRegAddress", "data.asbt_service_client.return.object.kodRegAddress"),
    ("_task_check_limitV2_Current_cash_outstanding", "data._task_check_limitV2.payload.Current_cash_outstanding"),
    ("_task_check_limitV2_Current_pmt", "data._task_check_limitV2.payload.Current_pmt"),
    ("_task_check_limitV2_Final_Limit", "data._task_check_limitV2.payload.Final_Limit"),
    ("_task_check_limitV2_IR", "data._task_check_limitV2.payload.IR"),
    ("_task_check_limitV2_LTI_cutoff", "data._task_check_limitV2.payload.LTI_cutoff"),
    ("_task_check_limitV2_Limit_by_LTI", "data._task_check_limitV2.payload.Limit_by_LTI"),
    ("_task_check_limitV2_Limit_by_Out", "data._task_check_limitV2.payload.Limit_by_Out"),
    ("_task_check_limitV2_Limit_by_PTI_CB", "data._task_check_limitV2.payload.Limit_by_PTI_CB"),
    ("_task_check_limitV2_Limit_by_PTI_FACT", "data._task_check_limitV2.payload.Limit_by_PTI_FACT"),
    ("_task_check_limitV2_Max_PTI_pmt", "data._task_check_limitV2.payload.Max_PTI_pmt"),
    ("_task_check_limitV2_Max_product_Limit", "data._task_check_limitV2.payload.Max_product_Limit"),
    ("_task_check_limitV2_PTI_cutoff", "data._task_check_limitV2.payload.PTI_cutoff"),
    ("_task_check_limitV2_Term", "data._task_check_limitV2.payload.Term"),
    ("prc", "result.data.prc"),
    ("percentBySegmentAndIncome", "result.data.percentBySegmentAndIncome"),
    ("katm_333_duration_sec", "data.katm_333.duration_sec"),
    ("katm_333_is_from_cache", "data.katm_333.is_from_cache"),
    ("summa_other_mikrozaym", "data.katm_077.result.data.summa_other_mikrozaym"),
    ("payload_segment", "data._salaryV2.payload.segment"),
    ("payload_salarySegment", "data._salaryV2.payload.salarySegment"),
    ("payload_Salary", "data._salaryV2.payload.Salary"),
    ("statement", "request.statement"),
    ("current_dlq_IB", "data.asbt_credit_list.result.current_dlq_IB"),
    ("current_dlq_bureau", "data.katm_077.result.data.current_dlq_bureau"),
    ("current_dlq_total", "data.katm_077.result.data.current_dlq_total"),
    ("glob_id", "asbt.globId"),
    ("Current_cash_outstanding_IB", "data._task_check_limitV2.payload.Current_cash_outstanding_IB"),
    ("Current_cash_outstanding_bureau", "data._task_check_limitV2.payload.Current_cash_outstanding_bureau"),
    ("bureau_segment", "data.katm_077.result.data.bureau_segment"),
)

# Columns that follow the first 25 in the finished application mart.
APPLICATION_DERIVED = words("""
    date loan_amt_s month unique_flag Interest_rate Term asbt_dpd_amt katm_dpd_amt flag_asbt_dpd flag_katm_dpd""")

# Fixed value: the hint text that marks an overdue amount.
OVERDUE_HINT = "Просрочка"


def application_columns() -> list[str]:
    names = [n for n, _ in APPLICATION_PATHS]
    tail = [n for n in names[25:] if n not in APPLICATION_DERIVED]
    return [*names[:25], *APPLICATION_DERIVED, *tail]
