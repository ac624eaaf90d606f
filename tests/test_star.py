import inspect
import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, values
from lakemart.operators import marts, quality
from lakemart.operators.calendar import (
    business_dates, calendar, date_bounds, is_business_date, observed_dates,
)
from lakemart.operators.keys import with_surrogate_key
from lakemart.operators.ranking import rank_by_value, top
from lakemart.operators.schedule import payment_schedule
from lakemart.operators.star import Lookup, attach_keys
from lakemart.plans.medallion import open_lake
from lakemart.sources.schemas import GOLD, conform, gold_schema, undeclared


def test_keys_are_dense_and_stable(spark):
    df = spark.range(500).select(F.concat(F.lit("id"), "id").alias("id"))
    results = {repr(values(with_surrogate_key(df.repartition(n), "id", "key", digits))) for n in (1, 3, 7) for digits in (3,)}
    assert len(results) == 1
    keys = [r[0] for r in values(with_surrogate_key(df, "id", "key"), "key")]
    assert sorted(keys) == list(range(500))
    with pytest.raises(ValueError):
        with_surrogate_key(df, "id", "key", 9)


def test_calendar_edges(frame):
    bounds = frame([("t", "c", date(2023, 12, 30), date(2024, 4, 2))], "table_name string, column_name string, min_date date, max_date date")
    days = {r["Date"]: r for r in calendar(bounds, 365).collect()}
    assert len(days) == 3 + 92 + 365
    leap = days[date(2024, 2, 29)]
    assert (leap["Is_Month_End"], leap["Day_Of_Year"], leap["Date_Key"]) == (1, 60, 20240229)
    march, april = days[date(2024, 3, 31)], days[date(2024, 4, 1)]
    assert (march["Financial_Year"], march["Financial_Quarter"], march["Is_Quarter_End"]) == ("2023-2024", "Q4", 1)
    assert (april["Financial_Year"], april["Financial_Quarter"], april["Is_Quarter_Start"]) == ("2024-2025", "Q1", 1)
    assert days[date(2024, 12, 30)]["Week_Number"] == 1
    new_year = days[date(2024, 12, 31)]
    assert (new_year["Is_Year_End"], new_year["quarter"], new_year["Year_Quarter"]) == (1, "Q4", "2024-Q4")
    sunday = days[date(2024, 3, 31)]
    assert (sunday["Day_Of_Week"], sunday["Is_Weekend"], sunday["Day_Name"], sunday["Day_Short"]) == (1, 1, "Sunday", "Sun")
    assert [c.lower() for c in calendar(bounds).columns] == [c.lower() for c in gold_schema("dim_date").fieldNames()]
    assert calendar(bounds).dtypes == [(f.name, f.dataType.simpleString()) for f in gold_schema("dim_date").fields]


def test_date_columns_by_name_and_type(frame):
    assert not any(map(is_business_date, ("DOB", "effective_from", "created_at", "valid_to", "silver_load_ts")))
    df = frame([(date(2024, 1, 1), "x", date(2020, 1, 1))], "open_date date, name string, birth_date date")
    assert business_dates(df) == ["open_date"]
    assert values(date_bounds({"a": df, "b": df.select("name")})) == [("a", "open_date", date(2024, 1, 1), date(2024, 1, 1))]
    with pytest.raises(ValueError):
        date_bounds({"b": df.select("name")})
    with pytest.raises(Exception, match="no bounds"):
        calendar(date_bounds({"a": df.where("false")})).count()


def test_observed_dates(frame):
    one = frame([(date(2024, 1, 1),), (None,)], "a date")
    two = frame([(date(2024, 1, 1),), (date(2024, 1, 2),)], "b date")
    assert [r["date_key"] for r in observed_dates(one, two).orderBy("Date").collect()] == [20240101, 20240102]


def test_schedule(frame):
    loans = frame(
        [("a", "c", "b", date(2024, 1, 31), Decimal("100.00"), 7), ("none", "c", "b", date(2024, 1, 1), Decimal("1.00"), 0),
         ("null", "c", "b", date(2024, 1, 1), Decimal("1.00"), None), ("nodate", "c", "b", None, Decimal("1.00"), 3)],
        "loan_id string, customer_id string, branch_id string, start_date date, principal_amount decimal(18,2), tenure_months int",
    )
    got = payment_schedule(loans, "2024-03-31", "2024-01-01 00:00:00").orderBy("installment_no").collect()
    assert [r["payment_date"] for r in got[:4]] == [date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 31), date(2024, 4, 30)]
    assert [r["status"] for r in got] == ["PAID"] * 3 + ["PENDING"] * 4
    assert {r["payment_amount"] for r in got} == {Decimal("14.29")}
    assert got[0]["payment_id"] == "a_1" and len(got) == 7


def test_lookup_keeps_rows(frame):
    facts = frame([("x", 1), ("nope", 2), (None, 3)], "id string, n int")
    dim = frame([(10, "x"), (11, "y")], "dim_key long, id string")
    assert values(attach_keys(facts, [Lookup(dim, "dim_key", "id", "id")]), "n", "dim_key") == [(1, 10), (2, None), (3, None)]


def test_days_are_looked_up_as_numbers(frame):
    from lakemart.operators.schedule import instalments, payment_plans

    facts = frame([(1, date(2024, 1, 31)), (2, None), (3, date(1969, 12, 31)), (4, date(2024, 2, 1))], "n int, day date")
    days = frame([(20240131, date(2024, 1, 31)), (0, None), (19691231, date(1969, 12, 31))], "date_key int, Date date")
    got = attach_keys(facts, [Lookup(days, "date_key", "Date", "day")])
    assert values(got, "n", "date_key") == [(1, 20240131), (2, None), (3, 19691231), (4, None)]
    assert "unix_date" in plan_of(got).split("Join")[1]
    loans = frame([("a", "c", "b", date(2024, 1, 1), 6, 3)], "loan_id string, customer_id string, branch_id string, start_date date, principal_amount int, tenure_months int")
    below = plan_of(instalments(payment_plans(loans, "2024-02-10", "2024-01-01 00:00:00"))).split("Generate")[1]
    assert "concat(loan_id" in below  # once for a plan


def test_conform(frame):
    df = frame([("5", "ch", 1)], "channel_key string, channel_name string, more int")
    assert conform(df, gold_schema("dim_channel")).dtypes == [("channel_key", "bigint"), ("channel_name", "string")]
    assert undeclared(df, gold_schema("dim_channel")) == ["more"]
    with pytest.raises(ValueError):
        conform(df, gold_schema("dim_txn_type"))
    assert conform(df, gold_schema("dim_txn_type"), fill=True).count() == 1
    with pytest.raises(ValueError):
        conform(df, gold_schema("dim_card"), fill=True)  # its key must not be NULL
    assert len(GOLD) == 15


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_rank_by_value_against_brute_force(frame, buckets):
    rng = random.Random(buckets)
    rows = [(i, rng.choice(["p", "q", None]), rng.choice([None, *range(0, 40)])) for i in range(300)]
    df = frame(rows, "i int, g string, v int")
    got = {r["i"]: (r["rank"], int(r["running"])) for r in rank_by_value(df, "v", ["g"], buckets=buckets).collect()}
    for i, g, v in rows:
        mine = [w or 0 for _, h, w in rows if h == g]
        assert got[i] == (len({w for w in mine if w > (v or 0)}) + 1, sum(w for w in mine if w >= (v or 0)))


def test_top_includes_ties(frame):
    df = frame([(i, v) for i, v in enumerate([9, 8, 8, 7, 8, None])], "i int, v int")
    assert [r["v"] for r in top(df, "v", 2).collect()].count(8) == 3
    assert top(df, "v", 2).count() == 4


def test_marts(frame):
    t = frame([(1, 10, "x", Decimal(5), 1), (1, 10, "y", Decimal(5), 0)], "branch_key int, date_key int, transaction_id string, amount decimal(18,2), is_fraud_label int")
    b = frame([(1, 11, Decimal(3))], "branch_key int, date_key int, end_of_day_balance decimal(18,2)")
    loans = frame([(None, 10, Decimal(2))], "branch_key int, date_key int, principal_amount decimal(18,2)")
    p = frame([(None, 10, Decimal(1))], "branch_key int, date_key int, payment_amount decimal(18,2)")
    got = values(marts.branch_daily_wide(t, b, loans, p))
    assert [tuple(float(x) if x is not None else None for x in r) for r in got] == sorted([
        (10.0, 1.0, 2.0, 10.0, 1.0, 0.0, 0.0, 0.0, 0.0), (11.0, 1.0, 0.0, 0.0, 0.0, 3.0, 0.0, 0.0, 0.0),
        (10.0, None, 0.0, 0.0, 0.0, 0.0, 1.0, 2.0, 1.0)], key=repr)


def test_quality(frame):
    df = frame([(1, None), (1, 5), (2, 6)], "id int, fk int")
    assert values(quality.duplicate_keys(df, "id")) == [(1, 2)]
    assert values(quality.key_coverage("t", df, ["fk", "id"])) == [("t", "fk", 3, 2), ("t", "id", 3, 3)]
    out = quality.collect_results([quality.rule_result("t", "null_fk", df.where("fk is null"))], "b", "2024-01-01 00:00:00")
    assert values(out, "table_name", "rule_name", "row_count", "batch_id") == [("t", "null_fk", 1, "b")]
    assert conform(out, gold_schema("dq_results")).count() == 1


def test_top_against_brute_force(frame):
    rng = random.Random(5)
    rows = [(i, rng.choice(["p", "q", None]), rng.choice([None, *range(12)])) for i in range(200)]
    got = {r["i"] for r in top(frame(rows, "i int, g string, v int"), "v", 7, ["g"]).collect()}
    for i, g, v in rows:
        better = sum(1 for _, h, w in rows if h == g and w is not None and (v is None or w > v))
        assert (i in got) == (better < 7)


def test_group_limits_run_before_the_shuffle(frame):
    from lakemart.operators.latest import latest

    df = frame([(1, 2)], "k int, t int")
    for plan in (plan_of(latest(df, "k", ["t"])), plan_of(top(df, "t", 3, ["k"]))):
        assert "WindowGroupLimit" in plan


def test_payments_are_judged_by_todays_date(frame):
    today = date.today()
    loans = frame([("a", "c", "b", today - timedelta(days=1), Decimal("10.00"), 2)],
                  "loan_id string, customer_id string, branch_id string, start_date date, principal_amount decimal(18,2), tenure_months int")
    assert [r["status"] for r in payment_schedule(loans).orderBy("installment_no").collect()] == ["PAID", "PENDING"]
    unnamed = loans.withColumn("loan_id", F.lit(None).cast("string"))
    assert {r["payment_id"] for r in payment_schedule(unnamed).collect()} == {None}
    defaults = inspect.signature(open_lake).parameters
    assert all(defaults[n].default is None for n in ("load_ts", "as_of", "batch"))


def test_amounts_are_worked_out_before_rows_multiply(spark):
    loans = spark.range(3).selectExpr(
        "'L' || id as loan_id", "'c' as customer_id", "'b' as branch_id", "date'2024-01-31' as start_date",
        "cast(100 as decimal(18,2)) as principal_amount", "int(id + 1) as tenure_months",
    )
    schedule = payment_schedule(loans, "2024-02-10", "2024-01-01 00:00:00")
    above, below = plan_of(schedule).split("Generate explode", 1)
    assert " / " in below and " / " not in above
    assert values(schedule, "payment_id", "payment_amount") == [
        ("L0_1", Decimal("100.00")), ("L1_1", Decimal("50.00")), ("L1_2", Decimal("50.00")),
        ("L2_1", Decimal("33.33")), ("L2_2", Decimal("33.33")), ("L2_3", Decimal("33.33")),
    ]
