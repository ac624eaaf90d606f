"""Daily loads: new days through all layers, summaries by month, check results by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import marts
from ..sources.layers import Layer
from ..sources.schemas import conform, gold_schema
from . import gold, silver
from .model import MONTH, filled_days

BALANCES = "balances_daily"

#: Looks up a table of the star by name; given columns as well, it may give the table summed up by them.
Tables = Callable[..., DataFrame]


@dataclass(frozen=True)
class Summary:
    """A table of the star that is built from facts month by month: its rows of a month
    follow from the facts' rows of that month, and from whole dimensions. Facts of which it takes
    nothing but sums by some columns are listed with these in ``sums``."""

    facts: tuple[str, ...]
    dimensions: tuple[str, ...]
    build: Callable[..., DataFrame]
    sums: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


def _days(fact: DataFrame) -> DataFrame:
    return fact.select("date_key").distinct()


#: Which tables are built on which; what is built on a summary stands below it.
SUMMARIES = {
    "fact_branch_daily_summary": Summary(("fact_daily_balances",), (), marts.branch_daily),
    "fact_branch_daily_wide": Summary(
        ("fact_transactions", "fact_daily_balances", "fact_loans", "fact_loan_payments"), (), marts.branch_daily_wide,
        {"fact_loan_payments": ("date_key", "branch_key")},
    ),
    "fact_customer_daily_portfolio": Summary(("fact_loans",), (), marts.customer_daily),
    "fact_customer_daily_wide": Summary(
        ("fact_transactions", "fact_daily_balances", "fact_loans"), ("dim_card", "dim_customer"), marts.customer_daily_wide
    ),
    # the days on which a fact has rows: closing balances look here, not in the fact
    **{filled_days(fact): Summary((fact,), (), _days) for fact in ("fact_daily_balances", "fact_customer_daily_wide")},
}


def monthly(df: DataFrame) -> DataFrame:
    """With the month of the date key, by which facts and summaries are stored."""
    return df.withColumn(MONTH, F.floor(F.col("date_key") / 100).cast("int"))


def built_on(fact: str) -> list[str]:
    """The summaries of a fact, and those of these summaries, in the order in which they are built."""
    found: list[str] = []
    for name, one in SUMMARIES.items():
        if {fact, *found} & set(one.facts):
            found.append(name)
    return found


def _in_months(column: Column, months: list[int | None]) -> Column:
    """Rows of these months; None stands for rows without a day."""
    listed = column.isin([m for m in months if m is not None])
    return listed | column.isNull() if None in months else listed


def summary(name: str, star: Tables, months: list[int | None] | None = None) -> DataFrame:
    """A summary of all months, or of the named ones, for which only these months of the
    facts are read."""
    one = SUMMARIES[name]
    facts = [star(f, one.sums[f]) if f in one.sums else star(f) for f in one.facts]
    if months is not None:
        facts = [f.where(_in_months(F.col(MONTH), months)) for f in facts]
    return one.build(*facts, *(star(d) for d in one.dimensions))


def refresh_summaries(star: Layer, tables: Tables, names: Iterable[str], months: list[int | None]) -> None:
    """Computes the named summaries again for the named months, in which some fact has changed.
    Other months' files stay as they are. A month without rows any more is taken out."""
    for name in names:
        made = monthly(summary(name, tables, months))
        star.swap_days(made, name, MONTH, months)


def load_balances(
    raw: Layer, typed: Layer, star: Layer, new: DataFrame, parent: Tables, tables: Tables, load_ts: str | None = None,
    raw_table: str = BALANCES, summaries: Iterable[str] = (),
) -> list[str]:
    """Loads the days that ``new`` brings: in the raw and typed layers they replace the same
    days, and the fact's months that hold them are written again from the typed layer,
    as are these months of the named summaries. Other days and months are not touched, so a
    repeated load changes nothing. Returns the names of the tables written in the star.

    ``parent`` looks up a typed parent table, ``tables`` a table of the star. Only the list
    of the days comes to the driver.
    """
    raw.replace_days(new, raw_table, "snapshot_date")
    rows = silver.balances(new, parent("accounts"), parent("customers"), parent("branches"), load_ts)
    days = [r[0] for r in new.select(F.to_date("snapshot_date")).distinct().collect()]
    # a day may have no valid row any more
    stored = typed.swap_days(rows, BALANCES, "snapshot_date", days)
    months = sorted({None if d is None else d.year * 100 + d.month for d in days}, key=str)
    touched = stored.where(_in_months(F.year("snapshot_date") * 100 + F.month("snapshot_date"), months))
    dims = {name: tables(name) for name in ("dim_account", "dim_customer", "dim_branch", "dim_date")}
    star.swap_days(monthly(gold.fact_daily_balances(touched, dims)), "fact_daily_balances", MONTH, months)
    names = list(summaries)
    refresh_summaries(star, tables, names, months)
    return ["fact_daily_balances", *names]


def record_checks(star: Layer, results: DataFrame) -> DataFrame:
    """Adds a run's check results to those of the runs before."""
    return star.append(conform(results, gold_schema("dq_results")), "dq_results")
