"""Star schema: dimensions with surrogate keys, facts, daily summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.calendar import calendar, date_bounds
from ..operators.history import current
from ..operators.keys import with_surrogate_key
from ..operators.schedule import daily_totals, instalments, is_plan, payment_bits, plan_totals
from ..operators.star import Lookup, attach_keys
from ..sources.registers import KeyRegister

# The columns of each dimension, after its key.
DIMENSION_COLUMNS = {
    "dim_branch": ("branch_id", "branch_name", "city", "state", "region", "opened_date", "is_active"),
    "dim_customer": (
        "customer_id", "full_name", "dob", "gender", "pan", "phone", "email", "address", "city", "state",
        "segment", "risk_rating", "home_branch_id", "kyc_status", "record_source", "load_ts",
        "effective_start_date", "effective_end_date", "is_current",
    ),
    "dim_account": (
        "account_id", "customer_id", "branch_id", "account_type", "currency", "status", "open_date",
        "overdraft_limit", "record_source", "load_ts", "effective_start_date", "effective_end_date", "is_current",
    ),
    "dim_card": (
        "card_id", "customer_id", "linked_account_id", "card_type", "status", "issued_date", "credit_limit",
    ),
    "dim_loan": (
        "loan_id", "customer_id", "branch_id", "status", "start_date", "interest_rate_apr", "principal_amount",
        "tenure_months", "effective_from", "effective_to", "is_current",
    ),
    "dim_channel": ("channel_name",),
    "dim_txn_type": ("txn_type_name",),
}
# dimension -> (silver table, surrogate key, historised)
DIMENSION_SOURCES = {
    "dim_branch": ("branches", "branch_key", False),
    "dim_customer": ("customers", "customer_key", True),
    "dim_account": ("accounts", "account_key", True),
    "dim_card": ("cards", "card_key", False),
    "dim_loan": ("loans", "loan_key", True),
    "dim_channel": ("channels", "channel_key", False),
    "dim_txn_type": ("txn_types", "txn_type_key", False),
}
# tables whose business dates bound the calendar
DATED_TABLES = ("transactions", "balances_daily", "loans", "loan_payments", "accounts", "cards", "branches")


def dimension(name: str, silver: DataFrame, register: KeyRegister | None = None) -> DataFrame:
    """A dimension with its surrogate keys: those that the register holds stay, and only
    members it does not know are numbered. Without a register all are numbered."""
    _, key, historised = DIMENSION_SOURCES[name]
    rows = current(silver) if historised else silver
    rows = rows.withColumnsRenamed({"silver_load_ts": "load_ts"}).select(*DIMENSION_COLUMNS[name])
    if register is None:
        return with_surrogate_key(rows, DIMENSION_COLUMNS[name][0], key)
    register.grow(rows)
    return register.attach(rows)


def dim_date(tables: dict[str, DataFrame]) -> DataFrame:
    return calendar(date_bounds(tables))


def _day(column: str):
    return F.to_date(column)


def fact_transactions(txns: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return attach_keys(txns, [
        Lookup(dims["dim_account"], "account_key", "account_id", "account_id"),
        Lookup(dims["dim_customer"], "customer_key", "customer_id", "customer_id"),
        Lookup(dims["dim_branch"], "branch_key", "branch_id", "branch_id"),
        Lookup(dims["dim_channel"], "channel_key", "channel_name", "channel"),
        Lookup(dims["dim_txn_type"], "txn_type_key", "txn_type_name", "txn_type"),
        Lookup(dims["dim_date"].withColumnRenamed("Date_Key", "date_key"), "date_key", "Date", _day("transaction_ts")),
    ]).select(
        "account_key", "branch_key", "channel_key", "counterparty", "currency", "customer_key", "date_key",
        "direction", "is_fraud_label", "merchant_category", "transaction_id", "transaction_ts", "txn_type_key", "amount",
    )


def fact_daily_balances(balances: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return attach_keys(balances, [
        Lookup(dims["dim_account"], "account_key", "account_id", "account_id"),
        Lookup(dims["dim_customer"], "customer_key", "customer_id", "customer_id"),
        Lookup(dims["dim_branch"], "branch_key", "branch_id", "branch_id"),
        Lookup(dims["dim_date"].withColumnRenamed("Date_Key", "date_key"), "date_key", "Date", _day("snapshot_date")),
    ]).select("account_key", "customer_key", "branch_key", "date_key", "snapshot_date", "end_of_day_balance", "currency")


def fact_loans(loans: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    # smallest dimension first: what a later lookup shuffles holds numbers in place of texts
    return attach_keys(current(loans), [
        Lookup(dims["dim_branch"], "branch_key", "branch_id", "branch_id"),
        Lookup(dims["dim_date"].withColumnRenamed("Date_Key", "date_key"), "date_key", "Date", "start_date"),
        Lookup(dims["dim_customer"], "customer_key", "customer_id", "customer_id"),
        Lookup(dims["dim_loan"], "loan_key", "loan_id", "loan_id"),
    ]).select(
        "loan_key", "date_key", "customer_key", "branch_key",
        "principal_amount", "interest_rate_apr", "tenure_months", "status",
    )


def fact_loan_payments(payments: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """From payments, or from the plans that they follow from: then keys are looked up once for
    each loan, before its payments multiply."""
    if is_plan(payments):
        return payments_of(keyed_plans(payments, dims), dims)
    return _dated_payments(attach_keys(payments, _payment_lookups(dims)), dims)


# keys that all payments of a plan share
PLAN_KEYS = ("branch_key", "customer_key", "loan_key")


def _payment_lookups(dims: Mapping[str, DataFrame]) -> list[Lookup]:
    return [
        Lookup(dims["dim_branch"], "branch_key", "branch_id", "branch_id"),
        Lookup(dims["dim_customer"], "customer_key", "customer_id", "customer_id"),
        Lookup(dims["dim_loan"], "loan_key", "loan_id", "loan_id"),
    ]


def _with_day(payments: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return attach_keys(payments, [
        Lookup(dims["dim_date"].withColumnRenamed("Date_Key", "date_key"), "date_key", "Date", _day("payment_date")),
    ])


def _dated_payments(payments: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return _with_day(payments, dims).select("branch_key", "customer_key", "date_key", "loan_key", "payment_amount", "payment_id", "status")


def keyed_plans(plans: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Payment plans with the keys that all payments of a loan share."""
    return attach_keys(plans, _payment_lookups(dims)).drop("customer_id", "branch_id")


def payments_of(plans: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The payments of keyed plans; their days meet the calendar alone, which is small."""
    return _dated_payments(instalments(plans, PLAN_KEYS), dims)


def summed_payments(plans: DataFrame, dims: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame | None:
    """Payments of keyed plans in fewer rows: the named columns, each combination of them that the
    payments have, and ``payment_amount`` summed up by them, in one row or several. None where rows
    would hardly be fewer than the payments."""
    keys = [c for c in PLAN_KEYS if c in columns]
    of_days = set(columns) - set(keys)
    if not of_days:
        return plan_totals(plans, keys)
    if of_days <= {"date_key", "status"} and set(keys) <= {"branch_key"}:
        return _with_day(daily_totals(plans, keys), dims).select(*columns, "payment_amount")
    return None


def numbered_payments(plans: DataFrame, columns: Sequence[str]) -> DataFrame | None:
    """The ids of the payments of keyed plans as bits, with the named columns and the status; see ``payment_bits``. None
    where plans do not have the columns."""
    keys = [c for c in PLAN_KEYS if c in columns]
    return payment_bits(plans, keys) if set(columns) <= {*keys, "status"} else None
