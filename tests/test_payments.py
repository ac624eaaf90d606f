"""Payment plans that are summed up and counted without a row for each payment."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, values
from lakemart.operators.schedule import daily_totals, instalments, payment_bits, payment_plans, plan_totals
from lakemart.plans import gold, loads
from lakemart.plans.medallion import BuiltLayer, Shorter
from lakemart.plans.model import _serials
from lakemart.plans.catalogue import catalogue
from lakemart.plans.report import pack, report

AS_OF = "2001-03-15"


@pytest.fixture(scope="module")
def loans(spark):
    draw = random.Random(5)
    days = [date(2000, 1, 31), date(2000, 2, 29), date(1999, 12, 30), date(2001, 3, 15), date(2001, 2, 15), date(2003, 5, 1), date(1996, 1, 28)]
    rows = [
        (draw.choice(["a", "b", "c", "d", "e_1", "f", "g", None]), draw.choice(["c1", "c2", None]), draw.choice(["b1", "b2", None]),
         draw.choice(days), Decimal(draw.randint(-500, 90000)) / 100, draw.choice([1, 2, 3, 12, 63, 64, 65, 150]))
        for _ in range(60)
    ]
    rows += [("z", "c1", "b1", date(2000, 1, 31), Decimal(7), 0), ("y", "c1", "b1", None, Decimal(7), 3)]
    return spark.createDataFrame(rows, "loan_id string, customer_id string, branch_id string, start_date date, principal_amount decimal(18,2), tenure_months int")


@pytest.mark.parametrize("as_of", [AS_OF, "1990-01-01", "2040-01-01"])
@pytest.mark.parametrize("by", [(), ("branch_id",), ("branch_id", "customer_id", "loan_id")])
def test_totals_equal_those_of_whole_rows(loans, by, as_of):
    plans = payment_plans(loans, as_of, "2024-01-01 00:00:00")
    rows = instalments(plans)
    wanted = rows.groupBy(*by, "payment_date", "status").agg(F.sum("payment_amount").alias("payment_amount"))
    columns = [*by, "payment_date", "status", "payment_amount"]
    assert values(daily_totals(plans, by), *columns) == values(wanted, *columns) != []
    whole = rows.groupBy(*by).agg(F.sum("payment_amount").alias("payment_amount"))
    assert values(plan_totals(plans, by).groupBy(*by).agg(F.sum("payment_amount"))) == values(whole)
    counts = [f"nullif(count(distinct struct(payment_id)) filter (where {w}), 0)" for w in ("true", "status = 'PAID'", "status = 'PENDING'")]
    payments = {f"n{i}": o for i, o in enumerate(_counted())}
    got = _serials(payment_bits(plans, by), by, payments)
    assert values(got) == values(rows.groupBy(*by).agg(*(F.expr(c) for c in counts)))
    assert "tenure_months" in plan_of(payment_bits(plans, by))


def _counted():
    from dataclasses import replace

    base = catalogue()["pay"]["Total Payments"]
    return [replace(base, serial=w) for w in ("true", "status = 'PAID'", "status = 'PENDING'")]


@pytest.fixture(scope="module")
def stars(spark, loans, tmp_path_factory):
    """One star with payments as plans, and one with the same payments as rows."""
    folder = str(tmp_path_factory.mktemp("stars"))
    make = spark.createDataFrame
    plans = payment_plans(loans, AS_OF, "2024-01-01 00:00:00")
    days = spark.sql("select explode(sequence(date'1996-01-01', date'2012-12-31')) Date").select(
        "Date", F.date_format("Date", "yyyyMMdd").cast("int").alias("Date_Key"), F.year("Date").alias("Year"),
        F.date_format("Date", "yyyy-MM").alias("Year_Month"),
    )
    dims = {
        "dim_date": days.where("Date <> date'2001-03-31'").cache(),  # payments of one day have no date
        "dim_branch": make([(1, "b1", "North", "N"), (2, "b2", "South", "S")], "branch_key long, branch_id string, branch_name string, region string"),
        "dim_customer": make([(1, "c1", "GOLD"), (2, "c2", "BASE")], "customer_key long, customer_id string, segment string"),
        "dim_loan": make([(k, n) for k, n in enumerate(["a", "b", "c", "d", "e_1", "f"])], "loan_key long, loan_id string"),
        "dim_account": make([], "account_key long, account_id string"),
    }
    facts = {
        "fact_loans": make([(1, 20000131, 1, 1, Decimal(300), Decimal(1), 12, "ACTIVE")], "loan_key long, date_key int, customer_key long, branch_key long, "
                           "principal_amount decimal(18,2), interest_rate_apr decimal(10,4), tenure_months int, status string"),
        "fact_transactions": make([("t", 1, 1, 1, 20010101, Decimal(9), 1, "CREDIT")], "transaction_id string, branch_key long, customer_key long, account_key long, "
                                  "date_key int, amount decimal(18,2), is_fraud_label int, direction string"),
        "fact_daily_balances": make([(1, 1, 1, 20010131, Decimal(10))], "account_key long, customer_key long, branch_key long, date_key int, "
                                    "end_of_day_balance decimal(18,2)"),
        "fact_customer_daily_wide": make([(1, 20010131, Decimal(1))], "customer_key long, date_key int, total_balance decimal(28,2)"),
    }
    name = "fact_loan_payments"

    def summed(kept, columns):
        found = gold.summed_payments(kept, dims, columns)
        return found if found is None or "date_key" not in columns else loads.monthly(found)

    kept = {t: (lambda df=df: df) for t, df in {**dims, **facts}.items()}
    layer = BuiltLayer(
        spark, "pay", folder, {**kept, name: lambda: gold.keyed_plans(plans, dims)},
        {name: lambda p: loads.monthly(gold.payments_of(p, dims))}, {name: Shorter(("payment_amount",), summed, "payment_id", gold.numbered_payments)},
    )
    rows = {t: layer.table(t) for t in kept} | {name: layer.table(name).cache()}
    return layer, rows


@pytest.mark.parametrize("by, where", [
    ((), {}), (("dim_branch.region",), {}), (("dim_date.Year_Month",), {}), (("dim_date.Date",), {"dim_date.Year": [2001]}),
    (("dim_branch.region", "dim_date.Year"), {}), (("fact_loan_payments.status",), {}), (("dim_loan.loan_id",), {"dim_branch.region": ["N"]}),
    (("dim_loan.loan_id", "dim_date.Year"), {}), (("dim_branch.region",), {"fact_loan_payments.status": ["PAID"]}),
    (("dim_branch.region",), {"dim_date.Year": [2000, 2001]}), (("fact_loan_payments.payment_id",), {}), (("dim_customer.segment",), {}),
])
def test_reports_over_plans_equal_those_over_rows(stars, by, where):
    layer, rows = stars
    names = [*catalogue()["pay"], "Payment Amount MTD", "Payment Amount YTD", "Previous Month Payment Amount", "Branch Payment Amount", "Payment Share %"]
    over_plans = report(layer.all(), names, by, where)
    over_rows = report(rows, names, by, where)
    assert over_plans.dtypes == over_rows.dtypes and values(over_plans) == values(over_rows)


def test_no_row_is_made_for_each_payment(stars):
    """Neither in the payment pack, nor in daily sums, nor in the daily summary; columns that plans do not share need rows."""
    layer, rows = stars
    star = layer.all()
    each = "sequence(1, tenure_months"
    assert each not in plan_of(pack(star, "pay", ["dim_branch.region"]))
    assert each not in plan_of(pack(star, "time", ["dim_date.Date"], closing="calendar"))
    wide = loads.summary("fact_branch_daily_wide", layer.lookup)
    assert each not in plan_of(wide) and each in plan_of(layer.table("fact_loan_payments"))
    wanted = loads.summary("fact_branch_daily_wide", lambda t, by=(): rows[t])
    assert wide.dtypes == wanted.dtypes and values(wide) == values(wanted) != []
    one_month = loads.summary("fact_branch_daily_wide", lambda t, by=(): layer.lookup(t, by) if by else loads.monthly(layer.table(t)), [200103, None])
    assert values(one_month) == values(wanted.where("date_key is null or date_key div 100 = 200103")) != []
