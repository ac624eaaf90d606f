"""Filter contexts on a tiny star, worked out by hand."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, values
from lakemart.operators.calendar import calendar
from lakemart.plans.catalogue import Options, catalogue, measures, slug
from lakemart.plans.model import RELATIONSHIPS, related
from lakemart.plans.report import pack, report


@pytest.fixture(scope="module")
def star(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    bounds = make([("t", "c", date(2024, 1, 1), date(2024, 4, 30))], "table_name string, column_name string, min_date date, max_date date")
    d = Decimal
    return {
        "dim_date": calendar(bounds, 31).cache(),
        "dim_branch": make([(1, "b1", "North One", "N", 1), (2, "b2", "North Two", "N", 0), (3, "b3", "South", "S", 1)],
                           "branch_key long, branch_id string, branch_name string, region string, is_active int"),
        "dim_customer": make([(1, "c1", "Ann", "GOLD"), (2, "c2", "Ann", "BASE"), (3, "c3", "Bob", "BASE"), (4, "c4", "Cy", "BASE")],
                             "customer_key long, customer_id string, full_name string, segment string"),
        "dim_account": make([(1, "a1")], "account_key long, account_id string"),
        "dim_channel": make([(1, "WEB")], "channel_key long, channel_name string"),
        "dim_txn_type": make([(1, "X")], "txn_type_key long, txn_type_name string"),
        "dim_loan": make([(1, "l1"), (2, "l2"), (3, "l3")], "loan_key long, loan_id string"),
        "fact_transactions": make(
            [("t1", 1, 1, 1, 1, 20240131, "CREDIT", d(100), 1, 1, 1, "m", None), ("t2", 1, 2, 1, 1, 20240201, "DEBIT", d(200000), 0, 1, 1, "m", "p"),
             ("t3", 3, 1, 1, 1, 20240229, "DEBIT", d(50), 0, 1, 1, "n", "p"), ("t4", None, 3, 1, 1, 20240301, "CREDIT", d(7), 1, 1, 1, "n", "q")],
            "transaction_id string, branch_key long, customer_key long, account_key long, x int, date_key int, direction string, "
            "amount decimal(18,2), is_fraud_label int, channel_key long, txn_type_key long, merchant_category string, counterparty string"),
        "fact_loans": make(
            [(1, 20240110, 1, 1, d(300), d("10.0000"), 12, "ACTIVE"), (2, 20240215, 2, 1, d(200), d("5.0000"), 6, "NPA"),
             (3, 20240220, 3, 3, d(100), d("1.0000"), 3, "CLOSED")],
            "loan_key long, date_key int, customer_key long, branch_key long, principal_amount decimal(18,2), "
            "interest_rate_apr decimal(10,4), tenure_months int, status string"),
        "fact_loan_payments": make(
            [("p1", 1, 1, 1, 20240210, d(25), "PAID"), ("p2", 1, 1, 1, 20240310, d(25), "PENDING")],
            "payment_id string, loan_key long, customer_key long, branch_key long, date_key int, payment_amount decimal(19,2), status string"),
        "fact_daily_balances": make(
            [(1, 1, 1, 20240130, d(10)), (1, 2, 3, 20240130, d(5)), (1, 1, 1, 20240131, d(20)), (1, 1, 1, 20240205, d(30))],
            "account_key long, customer_key long, branch_key long, date_key int, end_of_day_balance decimal(18,2)"),
        "fact_customer_daily_wide": make(
            [(1, 20240131, 1, 1, 1, 2, d(10), d(5), 1), (2, 20240131, 0, 0, 1, 0, d(0), d(0), 0)],
            "customer_key long, date_key int, account_count long, card_count long, loan_count long, transaction_count long, "
            "total_balance decimal(28,2), transaction_amount decimal(28,2), fraud_txn_count long"),
    }


def one(df, key, name):
    return {r[key]: r[name] for r in df.collect()}


def test_every_measure_is_there():
    assert len(measures()) == 170 and len(RELATIONSHIPS) == 15
    assert len({slug(n) for n in measures()}) == 170
    assert slug("Top 80% Flag") == "top_80_pct_flag"
    assert related("fact_loan_payments") == {"dim_loan", "dim_branch"}


@pytest.mark.parametrize("name", list(catalogue()))
def test_every_pack_runs(star, name):
    by = {"pareto": ["dim_customer.full_name"], "time": ["dim_date.Year_Month"]}.get(name, ["dim_branch.region"])
    assert pack(star, name, by).count() >= 2


def test_unknown_members_form_a_null_group(star):
    got = one(report(star, ["Total Transactions"], ["dim_branch.branch_name"]), "branch_name", "total_transactions")
    assert got == {"North One": 2, "North Two": None, "South": 1, None: 1}


def test_filters_drop_unknown_members(star):
    got = report(star, ["Total Transactions"], [], {"dim_branch.region": ["N", "S"]}).first()
    assert got[0] == 3
    assert report(star, ["Total Transactions"]).first()[0] == 4


def test_own_filter_replaces_but_row_filter_intersects(star):
    names = ["Credit Transactions", "High Value Transactions", "Fraud Transaction Count"]
    got = {r["direction"]: tuple(r)[1:] for r in report(star, names, ["fact_transactions.direction"]).collect()}
    assert got == {"CREDIT": (2, None, 2), "DEBIT": (2, 1, None)}
    filtered = report(star, names, [], {"fact_transactions.direction": ["DEBIT"]}).first()
    assert tuple(filtered) == (2, 1, None)


def test_unrelated_columns_repeat_the_total(star):
    got = one(report(star, ["Total Principal Disbursed", "Total Loan Exposure by Segment"], ["dim_customer.segment"]), "segment", "total_principal_disbursed")
    assert got == {"GOLD": Decimal(600), "BASE": Decimal(600)}
    virtual = one(report(star, ["Total Loan Exposure by Segment"], ["dim_customer.segment"]), "segment", "total_loan_exposure_by_segment")
    assert virtual == {"GOLD": Decimal(300), "BASE": Decimal(300)}


def test_payments_meet_dates_only_virtually(star):
    got = report(star, ["Total Payments", "Total Payment Amount"], ["dim_date.Year_Month"])
    rows = {r["Year_Month"]: (r[1], r[2]) for r in got.collect()}
    assert rows["2024-02"] == (2, Decimal(25)) and rows["2024-01"] == (2, None)


def test_shares_lift_one_table(star):
    got = {tuple(r)[:2]: tuple(r)[2:] for r in report(
        star, ["Loan Share %", "Loan Contribution %"], ["dim_branch.region", "dim_branch.branch_name"]).collect()}
    assert got[("N", "North One")] == (2 / 3, 1.0) and got[("S", "South")] == (1 / 3, 1.0)
    assert got[("N", "North Two")] == (None, None)


def test_overlap_counts_keys_of_both_facts(star):
    got = one(report(star, ["Customers With Both Loans and Transactions"], ["dim_branch.branch_name"]),
              "branch_name", "customers_with_both_loans_and_transactions")
    assert got == {"North One": 2, "North Two": None, "South": None}
    assert report(star, ["Customers With Both Loans and Transactions"]).first()[0] == 3


def test_closing_dates(star):
    last = one(report(star, ["Total Deposit Balance"], ["dim_date.Year_Month"]), "Year_Month", "total_deposit_balance")
    assert last["2024-01"] == 20 and last["2024-02"] == 30 and last["2024-03"] is None
    calendar_day = one(report(star, ["Total Deposit Balance"], ["dim_date.Year_Month"], closing="calendar"), "Year_Month", "total_deposit_balance")
    assert calendar_day["2024-01"] == 20 and calendar_day["2024-02"] is None
    assert report(star, ["Total Deposit Balance"]).first()[0] == 30
    assert report(star, ["Total Deposit Balance"], closing="calendar").first()[0] is None


def test_to_date_and_previous_month(star):
    names = ["Transaction Amount MTD", "Transaction Amount YTD", "Previous Month Transaction Amount", "Deposit Balance YTD", "Previous Month Deposit Balance"]
    months = {r["Year_Month"]: tuple(r)[1:] for r in report(star, names, ["dim_date.Year_Month"]).collect()}
    assert months["2024-02"] == (Decimal(200050), Decimal(200150), Decimal(100), Decimal(30), Decimal(20))
    assert months["2024-04"] == (None, Decimal(200157), Decimal(7), Decimal(30), None)
    days = {r["Date"]: tuple(r)[1:] for r in report(star, names, ["dim_date.Date"]).collect()}
    assert days[date(2024, 2, 1)][:2] == (Decimal(200000), Decimal(200100))
    assert days[date(2024, 2, 15)][:2] == (Decimal(200000), Decimal(200100))  # a day without rows
    assert days[date(2024, 2, 29)][2] is None and days[date(2024, 3, 31)][2] == 50  # 31 March looks at 29 February
    quarter = {r["quarter"]: r[1] for r in report(star, ["Previous Month Transaction Amount"], ["dim_date.quarter"]).collect()}
    assert quarter["Q1"] == 200150  # December to February


def test_date_filter_does_not_cut_the_running_total(star):
    got = report(star, ["Transaction Amount YTD", "Total Transaction Amount"], ["dim_date.Date"],
                 {"dim_date.Date": lambda c: c == date(2024, 2, 29)}).collect()
    assert [tuple(r) for r in got] == [(date(2024, 2, 29), Decimal(200150), Decimal(50))]


def test_single_date_needs_exactly_one_day(star):
    assert report(star, ["Total Loan Amount Fixed"]).first()[0] is None
    picked = report(star, ["Total Loan Amount Fixed"], [], {"dim_date.Date": lambda c: c == date(2024, 2, 15)}).first()
    assert picked[0] == 200


def test_names_merge_and_rank(star):
    rows = {r["full_name"]: tuple(r)[1:] for r in pack(star, "pareto", ["dim_customer.full_name"]).collect()}
    assert rows["Ann"] == (1, Decimal(500), Decimal(600), 500 / 600, "Others", "#D3D3D3")
    assert rows["Bob"] == (2, Decimal(600), Decimal(600), 1.0, "Others", "#D3D3D3")
    assert rows["Cy"][:2] == (3, Decimal(600))
    loose = pack(star, "pareto", ["dim_customer.full_name"], options=Options(contributors=500 / 600))
    assert one(loose, "full_name", "top_80_pct_flag")["Ann"] == "Top Contributors"  # exactly at the limit
    # a filter on names hides rows but does not change ranks
    only = report(star, ["Customer Rank by Exposure"], ["dim_customer.full_name"], {"dim_customer.full_name": ["Bob"]}).collect()
    assert [tuple(r) for r in only] == [("Bob", 2)]


def test_top_customers_and_blank_groups(star):
    options = Options(top_n=1)
    got = one(report(star, ["Top 10 Customers %"], options=options, by=["dim_customer.segment"]), "segment", "top_10_customers_pct")
    assert got == {"GOLD": 0.5, "BASE": 200 / 600}
    empty = report(star, ["Loan Bucket", "Total Loans"], [], {"dim_date.Year": [1999]}).first()
    assert tuple(empty) == ("Small", None)


def test_customer_counts_in_both_readings(star):
    names = ["High Risk Customers Count", "Active Customers"]
    assert tuple(report(star, names).first()) == (2, 2)
    assert tuple(report(star, names, options=Options(literal_customers=True)).first()) == (4, 4)


def test_portfolio_products(star):
    got = report(star, ["Multi Product Customers", "Customers With Card", "Avg Products per Customer"]).first()
    assert tuple(got) == (1, 1, 2.0)


def test_plans_have_no_pairwise_joins(star):
    for name, by in (("txn", "dim_branch.region"), ("pay", "dim_branch.region"), ("share", "dim_branch.branch_name"), ("time", "dim_date.Year_Month")):
        plan = plan_of(pack(star, name, [by]))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_distinct_counts_do_not_multiply_rows(star):
    """Each pass counts one column: no row is expanded once per counted column."""
    plan = plan_of(pack(star, "txn", ["dim_channel.channel_name"]))
    for line in plan.splitlines():
        if "Expand [" in line:
            assert line.count("], [") == 1  # one projection, then the output columns


def test_closing_days_come_from_the_kept_days(spark, star, tmp_path):
    """Each aggregate then scans its fact once, and values stay as they are."""
    fact, days = "fact_daily_balances", "days_of_fact_daily_balances"
    stored = dict(star)
    star[fact].write.parquet(f"{tmp_path}/fact")
    stored[fact] = spark.read.parquet(f"{tmp_path}/fact")
    without = report(stored, ["Total Deposit Balance"], ["dim_date.Year_Month"])
    stored[days] = spark.createDataFrame(sorted({(r["date_key"],) for r in star[fact].collect()}, key=str), "date_key int")
    kept = report(stored, ["Total Deposit Balance"], ["dim_date.Year_Month"])
    assert plan_of(without).count("FileScan parquet") == 2 and plan_of(kept).count("FileScan parquet") == 1
    assert values(kept) == values(without)


def test_lifted_totals_do_not_read_the_fact_again(spark, star, tmp_path):
    """A share's whole is summed up from the parts that the report shows: one scan and one
    shuffle of the fact serve both, and values are those of a report without parts."""
    stored = dict(star)
    for fact in ("fact_transactions", "fact_loans"):
        star[fact].write.parquet(f"{tmp_path}/{fact}")
        stored[fact] = spark.read.parquet(f"{tmp_path}/{fact}")
    by = ["dim_branch.region", "dim_branch.branch_name"]
    shares = ["Transaction Amount Share %", "Transaction Contribution %", "Principal Share %", "Loan Share %", "Total Loan Exposure"]
    rows = {r["branch_name"]: r for r in report(stored, shares, by).collect()}
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # a plan before it runs then shows what is reused
    try:
        plan = plan_of(report(stored, shares, by))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len([s for s in scans if "amount" in s]) == len(scans) == 2, plan
    assert "ReusedExchange [dim_branch__region" in plan
    assert rows["North One"]["transaction_amount_share_pct"] == pytest.approx(200100 / 200157)
    assert rows["North One"]["transaction_contribution_pct"] == pytest.approx(1)
    assert rows["South"]["principal_share_pct"] == pytest.approx(100 / 600)
    assert rows["South"]["loan_share_pct"] == pytest.approx(1 / 3)
    # a filter on the lifted column: the whole is not the sum of the parts shown
    one_region = report(stored, shares, by, {"dim_branch.region": ["S"]}).collect()
    assert [r["transaction_amount_share_pct"] for r in one_region] == [pytest.approx(50 / 200157)]


def test_columns_that_no_measure_sees_together(star):
    """Each measure's groups stand beside every member of the column it does not see."""
    by = ["dim_branch.region", "dim_channel.channel_name"]
    got = report(star, ["Total Loans", "Total Payments"], by)
    assert values(got, "region", "channel_name", "total_loans", "total_payments") == [("N", "WEB", 2, 2), ("S", "WEB", 1, None)]
    both = report(star, ["Total Loans", "Total Deposit Balance"], ["dim_loan.loan_id", "dim_account.account_id"], closing="calendar")
    assert values(both, "loan_id", "account_id", "total_loans") == [("l1", "a1", 1), ("l2", "a1", 1), ("l3", "a1", 1)]
    none = report(star, ["Total Loans"], ["dim_channel.channel_name", "dim_txn_type.txn_type_name"])
    assert values(none) == [("WEB", "X", 3)]
    filtered = report(star, ["Total Loans"], by, {"dim_channel.channel_name": ["no such"]})
    assert values(filtered) == []


def test_ranks_of_groups_that_are_no_names(star):
    ranks = ["Total Loan Exposure by Segment", "Customer Rank by Exposure", "Cumulative Loan Exposure", "Top 80% Flag"]
    shown = [slug(n) for n in ranks]
    d = Decimal
    # names: Ann 500, Bob 100, Cy blank
    assert values(report(star, ranks), *shown) == [(d(600), 1, None, "Top Contributors")]
    assert values(report(star, ranks, ["dim_branch.region"]), "region", *shown) == [
        ("N", d(500), 1, d(500), "Others"), ("S", d(100), 1, d(100), "Others")]
    # BASE: Ann 200, Bob 100, Cy 0; a filter on the names hides none of them from the ranks
    among = report(star, ranks[:3], ["dim_customer.segment"], {"dim_customer.full_name": ["Bob"]})
    assert values(among, "segment", *shown[:3]) == [("BASE", d(100), 2, d(300))]


def test_payment_ids_are_counted_by_loan_and_exactly(star, spark):
    """Ids of any form count as often as a plain distinct count says; a loan's ids leave a map task as one row."""
    ids = ["a_1", "a_1", "a_01", "a_1_1", "a_63", "a_64", "a_0", "a_", "a_-1", "a", "_5", "5", "_", "", "a_2147483648", "a_2147483647", None, None]
    rows = [(n, k % 3 + 1, 1, 1, 20240210, Decimal(1), ("PAID", "PENDING", None)[k % 3]) for k, n in enumerate(ids * 2)]
    payments = spark.createDataFrame(rows, star["fact_loan_payments"].schema)
    mine = {**star, "fact_loan_payments": payments}
    names = ["Total Payments", "Successful Payments", "Failed Payments"]
    for by, group in ((["fact_loan_payments.status"], "status"), (["dim_loan.loan_id"], "loan_key"), ([], None)):
        keys = [group] if group else []
        plain = payments.groupBy(*keys).agg(*(
            F.expr(f"nullif(count(distinct struct(payment_id)) filter (where {w}), 0)").alias(f"v{i}")
            for i, w in enumerate(("true", "true" if group == "status" else "status in ('SUCCESS', 'PAID')", "status = 'FAILED'"))
        ))
        got = report(mine, names, by)
        if group == "status":  # the two counts of one status lift the grouping by it
            assert values(got, "status", "total_payments") == values(plain, "status", "v0")
        elif group:
            assert values(got.drop("loan_id")) == values(plain.drop(group))
        else:
            assert values(got) == values(plain)

    per_loan = spark.range(50).selectExpr("id + 1 as loan_key", "explode(sequence(1, 40)) as n").selectExpr(
        "'L' || loan_key || '_' || n as payment_id", "loan_key", "1L as customer_key", "1L as branch_key", "20240210 as date_key",
        "cast(1 as decimal(19,2)) as payment_amount", "'PAID' as status",
    )
    counted = report({**star, "fact_loan_payments": per_loan}, ["Total Payments"])
    sent = plan_of(counted)
    assert counted.collect() == [(2000,)]
    assert "bit_or" in sent and "hashpartitioning(_name" in sent and "hashpartitioning(payment_id" not in sent
