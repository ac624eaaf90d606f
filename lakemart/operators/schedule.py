"""Payment schedule: one row per instalment of each running loan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What an instalment's status says, and the output columns below.
PAID, PENDING = "PAID", "PENDING"
# The day that a plan's payments are judged by.
AS_OF = "as_of"


def payment_schedule(
    loans: DataFrame, as_of: date | str | None = None, load_ts: datetime | str | None = None
) -> DataFrame:
    """Equal monthly instalments from the start date on.

    The amount is principal / tenure rounded half up to cents; what rounding leaves
    over is not put on the last one. Dates past a month's end fall on its last day.
    Rows multiply inside the task that holds the loan: no shuffle.
    """
    return instalments(payment_plans(loans, as_of, load_ts))


def payment_plans(
    loans: DataFrame, as_of: date | str | None = None, load_ts: datetime | str | None = None
) -> DataFrame:
    """One row per running loan with all that its instalments follow from. A schedule has
    as many rows as the loans have months: it is stored in this form."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    loaded = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp")
    return loans.where("start_date is not null and principal_amount is not null and tenure_months > 0").select(
        "loan_id", "customer_id", "branch_id", "start_date", "principal_amount", "tenure_months",
        today.alias(AS_OF), loaded.alias("silver_load_ts"),
    )


def is_plan(df: DataFrame) -> bool:
    return AS_OF in df.columns


def instalments(plans: DataFrame, more: Sequence[str] = ("customer_id", "branch_id")) -> DataFrame:
    """The rows of the plans' schedule; ``more`` columns of a plan stand in each of its rows."""
    due = F.add_months("start_date", F.col("installment_no") - 1)
    # the amount and the part of the id that all rows share are worked out once for a plan, before its rows multiply
    return plans.withColumns({"payment_amount": _amount(), "_named": F.concat("loan_id", F.lit("_"))}).select(
        "loan_id", "_named", *more, "start_date", "payment_amount", AS_OF, "silver_load_ts",
        F.explode(F.sequence(F.lit(1), "tenure_months")).alias("installment_no"),
    ).select(
        F.concat("_named", F.col("installment_no").cast("string")).alias("payment_id"),
        "loan_id", *more, "installment_no",
        due.alias("payment_date"),
        "payment_amount",
        _status(due),
        "silver_load_ts",
    )


def _amount() -> Column:
    return F.round(F.col("principal_amount") / F.col("tenure_months"), 2).cast("decimal(19,2)")


def _status(due: Column) -> Column:
    return F.when(due <= F.col(AS_OF), PAID).otherwise(PENDING).alias("status")


def _month_number(day: str) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def plan_totals(plans: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by`` and the sum of all instalments, one row per plan."""
    return plans.select(*by, (_amount() * F.col("tenure_months")).cast("decimal(38,2)").alias("payment_amount"))


def daily_totals(plans: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The schedule summed up by ``by`` (columns of a plan), payment_date and status, without a row
    for each instalment.

    Plans that fall due on the same day of the month run side by side: an amount joins them in
    the month of its first instalment and leaves them after its last one. Both changes are summed up
    by month before the shuffle, and the amounts that run in a month are the changes up
    to it. A window holds the months of one day of the month, and no more.
    """
    first = _month_number("start_date")
    change = F.array(
        F.struct(first.alias("month"), F.col("_amount").alias("amount"), F.lit(1).alias("n")),
        F.struct((first + F.col("tenure_months")).alias("month"), (-F.col("_amount")).alias("amount"), F.lit(-1).alias("n")),
    )
    same = [*by, AS_OF, "_on"]
    changes = (
        plans.select(*by, AS_OF, "start_date", "tenure_months", _amount().alias("_amount"))
        .select(*by, AS_OF, F.day("start_date").alias("_on"), F.explode(change).alias("_c"))
        .groupBy(*same, F.col("_c.month").alias("_month")).agg(F.sum("_c.amount").alias("_amount"), F.sum("_c.n").alias("_n"))
    )
    along = Window.partitionBy(*same).orderBy("_month")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    running = changes.select(
        *same, "_month", F.lead("_month").over(along).alias("_next"),
        F.sum("_amount").over(so_far).cast("decimal(38,2)").alias("_amount"), F.sum("_n").over(so_far).alias("_n"),
    ).where("_n > 0")
    months = running.select(*same, "_amount", F.explode(F.sequence("_month", F.col("_next") - 1)).alias("_month"))
    opened = months.withColumn("_first", F.expr("make_date(_month div 12, _month % 12 + 1, 1)"))
    # dates past a month's end fall on its last day
    dated = opened.withColumn("payment_date", F.date_add("_first", F.least(F.col("_on"), F.day(F.last_day("_first"))) - 1))
    return dated.groupBy(*by, AS_OF, "payment_date").agg(F.sum("_amount").alias("payment_amount")).select(
        *by, "payment_date", "payment_amount", _status(F.col("payment_date"))
    )


def payment_bits(plans: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The schedule's payment ids as bits, 64 to a row, one or two rows for most plans: ``_bit`` n % 64 of ``_word``
    n / 64 stands for instalment n of the loan ``_name``. Ids without a loan are NULL, as one value."""
    ahead = _month_number(AS_OF) - _month_number("start_date")
    due = ahead + F.when(F.add_months("start_date", ahead) <= F.col(AS_OF), 1).otherwise(0)
    paid = F.least(F.col("tenure_months"), F.greatest(F.lit(0), F.coalesce(due, F.lit(0))))
    runs = F.array(
        F.struct(F.lit(PAID).alias("status"), F.lit(1).alias("first"), F.col("_paid").alias("last")),
        F.struct(F.lit(PENDING).alias("status"), (F.col("_paid") + 1).alias("first"), F.col("tenure_months").alias("last")),
    )
    rows = plans.withColumn("_paid", paid).select(*by, "loan_id", F.explode(runs).alias("_run")).where("_run.first <= _run.last")
    words = rows.select(*by, "loan_id", "_run", F.explode(F.expr("sequence(_run.first div 64, _run.last div 64)")).alias("_word"))
    bits = "shiftleft(-1L, int(greatest(_run.first - 64 * _word, 0))) & shiftrightunsigned(-1L, int(63 - least(_run.last - 64 * _word, 63)))"
    return words.select(
        *by, F.col("_run.status").alias("status"), F.col("loan_id").alias("_name"),
        F.expr("if(loan_id is null, null, _word)").alias("_word"), F.expr(f"if(loan_id is null, 1L, {bits})").alias("_bit"),
    )
