"""The measure catalogue: names, packs, and what each measure computes.

A measure is either an operand (one aggregate) or a formula over other measures.
Formulas are plain columns over the operands, so a pack costs one pass per fact and
context, however many ratios it shows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import blank
from ..functions.blank import average_sql, distinct_sql, rows_sql, sum_sql
from ..functions.text import EXPOSURE_LIMITS, EXPOSURE_NAMES, band
from .model import B, BRANCH, C, CUSTOMER, DATE, L, P, T, Operand


@dataclass(frozen=True)
class Options:
    """Words the typed layer uses, limits and switches.

    Text is compared as the typed layer stores it (upper case), and generated
    payments are PAID or PENDING, so PAID counts as success.
    """

    credit: tuple[str, ...] = ("CREDIT",)
    debit: tuple[str, ...] = ("DEBIT",)
    active: tuple[str, ...] = ("ACTIVE",)
    closed: tuple[str, ...] = ("CLOSED",)
    bad: tuple[str, ...] = ("NPA",)
    success: tuple[str, ...] = ("SUCCESS", "PAID")
    failed: tuple[str, ...] = ("FAILED",)
    high_value: int = 100_000
    top_n: int = 10
    contributors: float = 0.8
    limits: tuple[float, ...] = EXPOSURE_LIMITS
    bands: tuple[str, ...] = EXPOSURE_NAMES
    # count every customer in context, as the two customer counts do when filters
    # do not reach the customer table
    literal_customers: bool = False


@dataclass(frozen=True)
class Ranked:
    """Rank of, or running total down to, a measure among all customer names."""

    base: str
    kind: str  # "rank" or "running"


Formula = Operand | Ranked | Callable[[Callable], Column]
NAMES = "dim_customer.full_name"


def slug(name: str) -> str:
    """Column name of a measure."""
    spoken = name.lower().replace("%", " pct").replace("&", "and")
    return re.sub(r"[^a-z0-9]+", "_", spoken).strip("_")


def ratio(top: str, bottom, alternate: float | None = 0) -> Formula:
    return lambda m: blank.divide(m(top), m(bottom), alternate)


def difference(a: str, b: str) -> Formula:
    return lambda m: blank.subtract(m(a), m(b))


def growth(now: str, before: str, alternate: float | None = 0) -> Formula:
    return lambda m: blank.divide(blank.subtract(m(now), m(before)), m(before), alternate)


def same(name: str) -> Formula:
    return lambda m: m(name)


def _among(column: str, words: tuple[str, ...]) -> str:
    listed = ", ".join("'" + w.replace("'", "''") + "'" for w in words)
    return f"{column} in ({listed})"


@lru_cache
def catalogue(options: Options = Options()) -> dict[str, dict[str, Formula]]:
    """pack -> measure name -> formula."""
    o = options
    fraud = "is_fraud_label = 1"
    high = f"amount >= {o.high_value}"
    clear_direction = (f"{T}.direction",)
    clear_fraud = (f"{T}.is_fraud_label",)
    clear_loan_status = (f"{L}.status",)
    clear_payment_status = (f"{P}.status",)
    by_date, by_customer = (DATE,), (DATE, CUSTOMER)

    def distinct(fact: str, column: str, where: str | None = None, **rest) -> Operand:
        return Operand(fact, distinct_sql(column, where), distinct=column, **rest)

    def payments(where: str | None = None, **rest) -> Operand:
        """Payments are named by their loan and a running number."""
        return distinct(P, "payment_id", where, serial=where or "true", **rest)

    def customers(where: str | None = None, **rest) -> Operand:
        """Known customers with transactions; none is blank."""
        known = "customer_key is not null" + (f" and {where}" if where else "")
        return Operand(T, distinct_sql("customer_key", known), distinct="customer_key", **rest)

    def total(fact: str, column: str, where: str | None = None, **rest) -> Operand:
        return Operand(fact, sum_sql(column, where), adds=True, sums=None if where else column, **rest)

    def count(fact: str, where: str | None = None, **rest) -> Operand:
        return Operand(fact, rows_sql(where), adds=True, **rest)

    txn: dict[str, Formula] = {
        "Total Transactions": distinct(T, "transaction_id"),
        "Total Transaction Amount": total(T, "amount"),
        "Average Transaction Amount": ratio("Total Transaction Amount", "Total Transactions"),
        "Transacting Customers": distinct(T, "customer_key"),
        "Transacting Accounts": distinct(T, "account_key"),
        "Active Transaction Branches": distinct(T, "branch_key"),
        "Transactions per Customer": ratio("Total Transactions", "Transacting Customers"),
        "Transactions per Branch": ratio("Total Transactions", "Active Transaction Branches"),
        "Credit Transactions": distinct(T, "transaction_id", _among("direction", o.credit), clear=clear_direction),
        "Debit Transactions": distinct(T, "transaction_id", _among("direction", o.debit), clear=clear_direction),
        "Credit Amount": total(T, "amount", _among("direction", o.credit), clear=clear_direction),
        "Debit Amount": total(T, "amount", _among("direction", o.debit), clear=clear_direction),
        "Net Transaction Flow": difference("Credit Amount", "Debit Amount"),
        "Credit Share %": ratio("Credit Amount", "Total Transaction Amount"),
        "Fraud Transaction Count": count(T, fraud, clear=clear_fraud),
        "Non Fraud Transactions": difference("Total Transactions", "Fraud Transaction Count"),
        "Fraud Amount": total(T, "amount", fraud, clear=clear_fraud),
        "Fraud Rate %": ratio("Fraud Transaction Count", "Total Transactions"),
        "Fraud Amount %": ratio("Fraud Amount", "Total Transaction Amount"),
        "Average Fraud Amount": ratio("Fraud Amount", "Fraud Transaction Count"),
        "High Value Transactions": distinct(T, "transaction_id", high),
        "High Value Transaction Amount": total(T, "amount", high),
        "High Value Fraud Transactions": distinct(T, "transaction_id", f"{high} and {fraud}"),
        "Unique Counterparties": distinct(T, "counterparty"),
        "Unique Merchant Categories": distinct(T, "merchant_category"),
        "Average Amount per Counterparty": ratio("Total Transaction Amount", "Unique Counterparties"),
        "Fraud Rate % by Channel": ratio("Fraud Transaction Count", Operand(T, "nullif(count(transaction_id), 0)"), None),
        "High Risk Customers Count": (
            distinct(CUSTOMER, "customer_id") if o.literal_customers
            else customers(fraud, clear=clear_fraud)
        ),
        "Fraud Loss Amount": same("Fraud Amount"),
    }

    loan: dict[str, Formula] = {
        "Total Loans": count(L, through=by_date),
        "Loan Customers": distinct(L, "customer_key"),
        "Loan Branches": distinct(L, "branch_key"),
        "Total Principal Disbursed": total(L, "principal_amount"),
        "Average Loan Size": ratio("Total Loan Exposure", "Total Loans"),
        "Average Loan Tenure": Operand(L, average_sql("tenure_months"), through=by_date),
        "Average Interest Rate": lambda m: blank.divide(
            m(Operand(L, average_sql("cast(interest_rate_apr as double)"), through=by_date)), F.lit(100)
        ),
        "Weighted Avg APR": ratio_of(total(L, "principal_amount * interest_rate_apr"), "Total Principal Disbursed"),
        "Active Loans": count(L, _among("status", o.active), through=by_date, clear=clear_loan_status),
        "Closed Loans": count(L, _among("status", o.closed), through=by_date, clear=clear_loan_status),
        "Active Loan %": ratio("Active Loans", "Total Loans"),
        "Closed Loan %": ratio("Closed Loans", "Total Loans"),
        "Loans per Loan Customer": ratio("Total Loans", "Loan Customers"),
        "Principal per Loan Customer": ratio("Total Principal Disbursed", "Loan Customers"),
        "NPA %": ratio_of(count(L, _among("status", o.bad), clear=clear_loan_status), "Total Loans"),
    }

    pay: dict[str, Formula] = {
        "Total Payments": payments(),
        "Total Payment Amount": total(P, "payment_amount", through=by_date),
        "Average Payment Amount": ratio("Total Payment Amount", "Total Payments"),
        "Paying Customers": distinct(P, "customer_key"),
        "Loans With Payments": distinct(P, "loan_key"),
        "Payment Branches": distinct(P, "branch_key"),
        "Payments per Loan": ratio("Total Payments", "Loans With Payments"),
        "Payment Amount per Loan": ratio("Total Payment Amount", "Loans With Payments"),
        "Successful Payments": payments(_among("status", o.success), clear=clear_payment_status),
        "Failed Payments": payments(_among("status", o.failed), clear=clear_payment_status),
        "Payment Success Rate %": ratio("Successful Payments", "Total Payments"),
        "Payment Failure Rate %": ratio("Failed Payments", "Total Payments"),
        "Repayment to Disbursement %": ratio("Total Payment Amount", "Total Principal Disbursed"),
        "Loans With No Payments": difference("Total Loans", "Loans With Payments"),
        "Loan Payment Penetration %": ratio("Loans With Payments", "Total Loans"),
        "Distinct Paid Loans": distinct(P, "loan_key", through=by_date),
    }

    overlap: dict[str, Formula] = {
        "Customers With Both Loans and Transactions": Operand(L, "", both=(T, "customer_key")),
        "Loan Customers Doing Transactions %": ratio("Customers With Both Loans and Transactions", "Loan Customers"),
        "Transaction Customers With Loans %": ratio("Customers With Both Loans and Transactions", "Transacting Customers"),
        "Transaction Only Customers": difference("Transacting Customers", "Customers With Both Loans and Transactions"),
        "Loan Only Customers": difference("Loan Customers", "Customers With Both Loans and Transactions"),
    }

    branch: dict[str, Formula] = {
        "Branch Balance": total(B, "end_of_day_balance", through=by_date),
        "Branch Loan Amount": total(L, "principal_amount", through=by_date),
        "Branch Payment Amount": total(P, "payment_amount", through=by_date),
        "Avg Transactions per Branch": ratio("Total Transactions", distinct(BRANCH, "branch_id"), None),
        "Payment to Loan Principal %": ratio("Branch Payment Amount", "Branch Loan Amount"),
        "Avg Loan Disbursement per Branch": ratio("Branch Loan Amount", distinct(BRANCH, "branch_id"), None),
        "Active Customers": (
            distinct(CUSTOMER, "customer_id") if o.literal_customers
            else customers(given=((f"{BRANCH}.is_active", (1,)),))
        ),
        "Branch Efficiency Score": ratio("Avg Transactions per Branch", "Active Customers", None),
        "Loan to Deposit Ratio": ratio("Branch Loan Amount", "Branch Balance", None),
        "Loan to Avg Balance Ratio": ratio("Total Loan Amount", "Branch Balance", None),
    }

    executive: dict[str, Formula] = {
        "Total Loan Amount": total(L, "principal_amount", through=by_date),
        "Loan Rows By Date": count(L),
        "Loan Rows": count(L),
        "Total Loan Amount Fixed": total(L, "principal_amount", dates=("single",)),
        "Loan to Payment Ratio": ratio("Total Payment Amount", "Total Loan Amount"),
        "Loan to Balance Ratio": ratio("Total Loan Amount", "Total Balance"),
        "Total Balance": total(B, "end_of_day_balance", through=by_date),
        "Branch Fraud Count": count(T, fraud, clear=clear_fraud),
        "Loan vs Payment Gap": difference("Total Loan Amount", "Total Payment Amount"),
        "Repayment Coverage %": ratio("Total Payment Amount", "Total Loan Amount"),
        "Loan to Balance Ratio %": ratio("Total Loan Amount", "Total Balance"),
        "Net Contribution": lambda m: blank.subtract(
            blank.add(m("Total Transaction Amount"), m("Total Payment Amount")), m("Total Loan Amount")
        ),
        "Segment Risk Score": lambda m: blank.add(
            blank.subtract(_times(m("Total Loan Amount"), "0.5"), _times(m("Total Payment Amount"), "0.3")),
            _times(m("Fraud Amount"), "0.2"),
        ),
    }

    exposure = total(L, "principal_amount", through=by_customer)
    borrowers = distinct(L, "customer_key", through=by_customer)
    segment: dict[str, Formula] = {
        "Distinct Borrowers by Bucket": borrowers,
        "Total Loan Exposure": total(L, "principal_amount", through=by_date),
        "Loan per Customer": ratio("Total Loan Exposure", "Distinct Borrowers by Bucket"),
        "Borrower Share %": ratio("Distinct Borrowers by Bucket", replace(borrowers, clear=(f"{CUSTOMER}.segment",))),
        "Total Loan Exposure by Segment": exposure,
        "Total Loans by Segment": count(L, through=by_customer),
        "Top 10 Customers %": ratio_of(replace(exposure, top=(o.top_n, f"{CUSTOMER}.customer_id")), "Total Loan Exposure"),
        "Loan Bucket": lambda m: band(m("Total Loan Exposure by Segment"), o.limits, o.bands),
        "Customers per Bucket": distinct(L, "customer_key", through=by_date),
        "Total Loan Exposure by Segment & Bucket": same("Total Loan Exposure by Segment"),
        "Distinct Borrowers by Segment & Bucket": same("Distinct Borrowers by Bucket"),
        "Exposure %": ratio("Total Loan Exposure by Segment & Bucket", "Total Loan Exposure"),
        "Borrower %": ratio("Distinct Borrowers by Bucket", "Customers per Bucket"),
    }

    def share(name: str, lifted: str = BRANCH, alternate: float | None = 0) -> Formula:
        return lambda m: blank.divide(m(name), m(m.operand(name, clear=(lifted,))), alternate)

    shares: dict[str, Formula] = {
        "Transaction Share %": share("Total Transactions"),
        "Transaction Amount Share %": share("Total Transaction Amount"),
        "Loan Share %": share("Total Loans"),
        "Principal Share %": share("Total Principal Disbursed"),
        "Payment Share %": share("Total Payment Amount"),
        "Fraud Rate by Branch %": ratio("Fraud Transaction Count", "Total Transactions"),
        "Branch Deposit Share %": share("Branch Balance"),
        "Branch Transaction Share %": share("Total Transaction Amount"),
        "Branch Loan Share %": share("Branch Loan Amount"),
        "Loan Contribution %": share("Total Loan Exposure", f"{BRANCH}.branch_name", None),
        "Transaction Contribution %": share("Total Transaction Amount", f"{BRANCH}.branch_name", None),
    }

    closing = ("closing",)
    deposit: dict[str, Formula] = {
        "Total Deposit Balance": total(B, "end_of_day_balance", dates=closing),
        "Deposit Customers": distinct(B, "customer_key", dates=closing),
        "Deposit Accounts": distinct(B, "account_key", dates=closing),
        "Avg Deposit Balance per Customer": ratio("Total Deposit Balance", "Deposit Customers"),
        "Avg Deposit Balance per Account": ratio("Total Deposit Balance", "Deposit Accounts"),
        "Deposit Branches": distinct(B, "branch_key", dates=closing),
        "Avg Deposit Balance per Branch": ratio("Total Deposit Balance", "Deposit Branches"),
    }

    products = "int(account_count > 0) + int(card_count > 0) + int(loan_count > 0)"
    portfolio: dict[str, Formula] = {
        "Portfolio Customers": distinct(C, "customer_key", dates=closing),
        "Customer Portfolio Balance": total(C, "total_balance", dates=closing),
        "Avg Portfolio Balance per Customer": ratio("Customer Portfolio Balance", "Portfolio Customers"),
        "Customer Transaction Count Snapshot": total(C, "transaction_count", dates=closing),
        "Customer Transaction Amount Snapshot": total(C, "transaction_amount", dates=closing),
        "Avg Transactions per Customer": ratio("Customer Transaction Count Snapshot", "Portfolio Customers"),
        "Avg Transaction Amount per Customer": ratio("Customer Transaction Amount Snapshot", "Portfolio Customers"),
        "Avg Accounts per Customer Snapshot": ratio_of(total(C, "account_count", dates=closing), "Portfolio Customers"),
        "Avg Cards per Customer Snapshot": ratio_of(total(C, "card_count", dates=closing), "Portfolio Customers"),
        "Avg Loans per Customer Snapshot": ratio_of(total(C, "loan_count", dates=closing), "Portfolio Customers"),
        "Avg Products per Customer": ratio_of(
            total(C, "account_count + card_count + loan_count", dates=closing), "Portfolio Customers"
        ),
        "Customers With Account": distinct(C, "customer_key", "account_count > 0", dates=closing),
        "Customers With Card": distinct(C, "customer_key", "card_count > 0", dates=closing),
        "Customers With Loan": distinct(C, "customer_key", "loan_count > 0", dates=closing),
        "Multi Product Customers": count(C, f"{products} >= 2", dates=closing),
        "Cross Sell Ratio %": ratio("Multi Product Customers", "Portfolio Customers"),
        "Account Penetration %": ratio("Customers With Account", "Portfolio Customers"),
        "Card Penetration %": ratio("Customers With Card", "Portfolio Customers"),
        "Loan Penetration %": ratio("Customers With Loan", "Portfolio Customers"),
        "Customer Fraud Txn Count Snapshot": total(C, "fraud_txn_count", dates=closing),
        "Customers With Fraud Activity": distinct(C, "customer_key", "fraud_txn_count > 0", dates=closing),
        "Fraud Incidence %": ratio("Customers With Fraud Activity", "Portfolio Customers"),
        "Fraud Txns per Fraud Customer": ratio("Customer Fraud Txn Count Snapshot", "Customers With Fraud Activity"),
    }

    def at(name: str, step: str) -> Formula:
        return lambda m: m(m.operand(name, step=step))

    time: dict[str, Formula] = {
        "Transaction Amount MTD": at("Total Transaction Amount", "mtd"),
        "Transaction Amount YTD": at("Total Transaction Amount", "ytd"),
        "Previous Month Transaction Amount": at("Total Transaction Amount", "previous_month"),
        "MoM Transaction Growth %": growth("Total Transaction Amount", "Previous Month Transaction Amount"),
        "Principal Disbursed MTD": at("Total Principal Disbursed", "mtd"),
        "Principal Disbursed YTD": at("Total Principal Disbursed", "ytd"),
        "Previous Month Principal Disbursed": at("Total Principal Disbursed", "previous_month"),
        "MoM Loan Disbursement Growth %": growth("Total Principal Disbursed", "Previous Month Principal Disbursed"),
        "Payment Amount MTD": at("Total Payment Amount", "mtd"),
        "Payment Amount YTD": at("Total Payment Amount", "ytd"),
        "Previous Month Payment Amount": at("Total Payment Amount", "previous_month"),
        "MoM Payment Growth %": growth("Total Payment Amount", "Previous Month Payment Amount"),
        "Deposit Balance MTD": at("Total Deposit Balance", "mtd"),
        "Deposit Balance YTD": at("Total Deposit Balance", "ytd"),
        "Previous Month Deposit Balance": at("Total Deposit Balance", "previous_month"),
        "MoM Deposit Growth %": growth("Total Deposit Balance", "Previous Month Deposit Balance"),
        "Previous Month Portfolio Balance": at("Customer Portfolio Balance", "previous_month"),
        "MoM Portfolio Growth %": growth("Customer Portfolio Balance", "Previous Month Portfolio Balance"),
        "Loan Growth %": growth("Total Loan Exposure", "Previous Period Loan Exposure"),
        "Previous Period Loan Exposure": at("Total Loan Exposure", "previous_month"),
        "Loan Amount PM": at("Total Loan Amount", "previous_month"),
        "Loan MoM %": growth("Total Loan Amount", "Loan Amount PM", None),
    }

    def contributes(m) -> Column:
        return blank.zero(m("Cumulative Exposure %")) <= o.contributors

    # The words and colours of the contribution flags.
    pareto: dict[str, Formula] = {
        "Customer Rank by Exposure": Ranked("Total Loan Exposure by Segment", "rank"),
        "Cumulative Loan Exposure": Ranked("Total Loan Exposure by Segment", "running"),
        "Total Loan Exposure Overall": replace(exposure, clear=(NAMES,)),
        "Cumulative Exposure %": ratio("Cumulative Loan Exposure", "Total Loan Exposure Overall", None),
        "Top 80% Flag": lambda m: F.when(contributes(m), "Top Contributors").otherwise("Others"),
        "Color Flag": lambda m: F.when(contributes(m), "#2ECC71").otherwise("#D3D3D3"),
    }

    return {
        "txn": txn, "loan": loan, "pay": pay, "overlap": overlap, "branch": branch, "exec": executive,
        "segment": segment, "share": shares, "deposit": deposit, "portfolio": portfolio, "time": time, "pareto": pareto,
    }


def ratio_of(top: Operand, bottom: str, alternate: float | None = 0) -> Formula:
    return lambda m: blank.divide(m(top), m(bottom), alternate)


def _times(c: Column, factor: str) -> Column:
    return c * F.lit(factor).cast("decimal(2,1)")


@lru_cache
def measures(options: Options = Options()) -> dict[str, Formula]:
    """measure name -> formula, over all packs."""
    return {name: formula for pack in catalogue(options).values() for name, formula in pack.items()}
