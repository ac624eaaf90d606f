"""Typed layer: cleaned, validated, de-duplicated and historised tables.

Each function takes the raw (and parent) frames and returns frames; nothing is
written here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import code, day, lower_text, moment, money, rate, text, whole
from ..operators.cleaning import audited, clean, event_time, merge_changes, require_keys, split
from ..operators.history import MICROS, SECONDS, history
from ..operators.integrity import Parent, keep_children, mark_orphans, split_orphans
from ..operators.latest import latest

CUSTOMER_RULES = {
    "customer_id": text, "full_name": text, "dob": day, "gender": code, "pan": code, "phone": text,
    "email": lower_text, "address": text, "city": text, "state": text, "segment": code, "risk_rating": code,
    "home_branch_id": text, "kyc_status": code, "created_at": moment, "updated_at": moment,
}
BRANCH_RULES = {
    "branch_id": text, "branch_name": text, "city": text, "state": text, "region": code,
    "opened_date": day, "is_active": whole,
}
ACCOUNT_RULES = {
    "account_id": text, "customer_id": text, "branch_id": text, "account_type": code, "currency": code,
    "status": code, "open_date": day, "overdraft_limit": money, "created_at": moment, "updated_at": moment,
}
CARD_RULES = {
    "card_id": text, "customer_id": text, "linked_account_id": text, "card_type": code, "status": code,
    "issued_date": day, "credit_limit": money, "created_at": moment, "updated_at": moment,
}
TRANSACTION_RULES = {
    "transaction_id": text, "transaction_ts": moment, "account_id": text, "customer_id": text, "branch_id": text,
    "txn_type": code, "channel": code, "direction": code, "amount": money, "currency": code,
    "merchant_category": code, "counterparty": text, "is_fraud_label": whole, "created_at": moment,
}
BALANCE_RULES = {
    "account_id": text, "customer_id": text, "branch_id": text, "currency": code,
    "snapshot_date": day, "end_of_day_balance": money,
}
LOAN_RULES = {
    "loan_id": text, "customer_id": text, "branch_id": text, "status": code, "start_date": day,
    "interest_rate_apr": rate, "principal_amount": money, "tenure_months": whole,
}

# The verdict on a row of a checked table.
ACCEPTED = "accepted"

# The columns whose change makes a new version.
CUSTOMER_TRACKED = (
    "full_name", "dob", "gender", "pan", "phone", "email", "address",
    "city", "state", "segment", "risk_rating", "home_branch_id", "kyc_status",
)
ACCOUNT_TRACKED = (
    "customer_id", "branch_id", "account_type", "currency", "status", "open_date", "overdraft_limit",
)
LOAN_TRACKED = (
    "customer_id", "branch_id", "status", "start_date", "interest_rate_apr", "principal_amount", "tenure_months",
)
# What settles the order of loans of equal start and principal.
LOAN_TIES = ("branch_id", "customer_id", "interest_rate_apr", "status", "tenure_months", "record_source")


def clean_customers(base: DataFrame, delta: DataFrame, load_ts=None) -> DataFrame:
    rows = audited(clean(merge_changes(base, delta), CUSTOMER_RULES), load_ts)
    return require_keys(rows, ["customer_id"])


def _timed(rows: DataFrame, load_ts) -> DataFrame:
    return rows.withColumn("_at", event_time(["updated_at", "created_at"], load_ts))


def timed_customers(base: DataFrame, delta: DataFrame, load_ts=None) -> DataFrame:
    """Cleaned customers with the time ``_at`` that their history goes by."""
    return _timed(clean_customers(base, delta, load_ts), load_ts)


def _versions(rows: DataFrame, key: str, tracked, load_ts, sources: tuple[DataFrame, ...]) -> DataFrame:
    """Busy keys are counted in the sources' key column, not on the rows: that leaves
    out all the work that made them, and can only find more keys."""
    timed = _timed(rows, load_ts)
    named = reduce(DataFrame.unionByName, (s.select(text(F.col(key)).alias(key)) for s in sources))
    return history(timed, key, "_at", tracked, SECONDS, ties=[*tracked, "record_source"], count_in=named).drop("_at")


def customers(base: DataFrame, delta: DataFrame, load_ts=None) -> DataFrame:
    return _versions(clean_customers(base, delta, load_ts), "customer_id", CUSTOMER_TRACKED, load_ts, (base, delta))


def branches(raw: DataFrame, load_ts=None) -> tuple[DataFrame, DataFrame]:
    """(branches, rejected): a branch without an id is rejected."""
    return split(audited(clean(raw, BRANCH_RULES), load_ts), F.col("branch_id").isNotNull())


def accounts(base: DataFrame, delta: DataFrame, customers: DataFrame, branches: DataFrame, load_ts=None) -> DataFrame:
    rows = require_keys(audited(clean(merge_changes(base, delta), ACCOUNT_RULES), load_ts), ["account_id"])
    parents = {"customer_id": Parent(customers, "customer_id"), "branch_id": Parent(branches, "branch_id")}
    return _versions(keep_children(rows, parents), "account_id", ACCOUNT_TRACKED, load_ts, (base, delta))


def _card_parents(customers: DataFrame, accounts: DataFrame) -> dict[str, Parent]:
    return {"customer_id": Parent(customers, "customer_id"), "linked_account_id": Parent(accounts, "account_id")}


def cards(raw: DataFrame, customers: DataFrame, accounts: DataFrame, load_ts=None) -> tuple[DataFrame, DataFrame]:
    """(cards, rejected): a card of an unknown customer or account is rejected."""
    return split_orphans(audited(clean(raw, CARD_RULES), load_ts), _card_parents(customers, accounts))


def checked_cards(raw: DataFrame, customers: DataFrame, accounts: DataFrame, load_ts=None) -> DataFrame:
    """All cards with ``accepted``: stored once, both halves are read from there."""
    rows = audited(clean(raw, CARD_RULES), load_ts)
    parents = _card_parents(customers, accounts)
    found = [F.col(f"_found_{c}") for c in parents]
    return mark_orphans(rows, parents).select(*rows.columns, reduce(lambda a, b: a & b, found).alias(ACCEPTED))


def checked_branches(raw: DataFrame, load_ts=None) -> DataFrame:
    return audited(clean(raw, BRANCH_RULES), load_ts).withColumn(ACCEPTED, F.col("branch_id").isNotNull())


def domain(raw: DataFrame, column: str, name: str) -> DataFrame:
    """The values a column takes, cleaned: a base dimension."""
    return raw.select(code(F.col(column)).alias(name)).where(F.col(name).isNotNull()).distinct()


def clean_transactions(raw: DataFrame, load_ts=None) -> DataFrame:
    return audited(clean(raw, TRANSACTION_RULES), load_ts)


def transactions(
    raw: DataFrame, accounts: DataFrame, customers: DataFrame, branches: DataFrame,
    channels: DataFrame, txn_types: DataFrame, load_ts=None,
) -> DataFrame:
    rows = clean_transactions(raw, load_ts)
    ties = ["amount", "account_id", *sorted({*TRANSACTION_RULES, "record_source"} - {"transaction_id", "transaction_ts", "amount", "account_id"})]
    newest = latest(rows, "transaction_id", ["transaction_ts"], ties)
    parents = {
        "account_id": Parent(accounts, "account_id"),
        "customer_id": Parent(customers, "customer_id"),
        "branch_id": Parent(branches, "branch_id"),
        "channel": Parent(channels, "channel_name"),
        "txn_type": Parent(txn_types, "txn_type_name"),
    }
    return keep_children(newest, parents)


def balances(raw: DataFrame, accounts: DataFrame, customers: DataFrame, branches: DataFrame, load_ts=None) -> DataFrame:
    parents = {
        "account_id": Parent(accounts, "account_id"),
        "customer_id": Parent(customers, "customer_id"),
        "branch_id": Parent(branches, "branch_id"),
    }
    return keep_children(audited(clean(raw, BALANCE_RULES), load_ts), parents)


def newest_loans(raw: DataFrame, load_ts=None) -> DataFrame:
    """One row per loan id. Loans carry no change time, so the order is made
    explicit: latest start, then greatest principal, then all other columns."""
    rows = require_keys(audited(clean(raw, LOAN_RULES), load_ts), ["loan_id"])
    return latest(rows, "loan_id", ["start_date"], ["principal_amount", *LOAN_TIES])


def loans(raw: DataFrame, customers: DataFrame, branches: DataFrame, load_ts=None) -> DataFrame:
    parents = {"customer_id": Parent(customers, "customer_id"), "branch_id": Parent(branches, "branch_id")}
    rows = newest_loans(raw, load_ts).withColumn("_at", F.col("silver_load_ts"))
    # one row per loan: no key is busy, and there are no ties to sort by. An orphan takes its whole history
    # along, so parents are looked for last: newest row and history then share the shuffle by loan
    versions = history(rows, "loan_id", "_at", LOAN_TRACKED, MICROS, ties=(), hot_rows=None).drop("_at")
    return keep_children(versions, parents)
