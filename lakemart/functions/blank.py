"""Blank-aware arithmetic for measures.

A measure over no rows is blank (NULL), not zero. Blank counts as zero in sums
and comparisons, and a blank operand alone never turns a sum blank.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def divide(a: Column, b: Column, alternate: float | None = None) -> Column:
    """a / b as a double; ``alternate`` when b is blank or zero."""
    top, bottom = a.cast("double"), b.cast("double")
    usable = bottom.isNotNull() & (bottom != 0)
    return F.when(usable, F.try_divide(top, bottom)).otherwise(F.lit(alternate).cast("double"))


def add(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def subtract(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))


def zero(a: Column) -> Column:
    """The value a comparison sees: blank is zero."""
    return F.coalesce(a, F.lit(0))


def distinct_sql(column: str, where: str | None = None) -> str:
    """Distinct values of a column, with NULL as one value; blank over no rows.

    A struct is never NULL, so counting structs counts a NULL inside. The condition is
    a FILTER clause and not a CASE inside the count: all conditions on one column then
    share its distinct values.
    """
    kept = f" filter (where {where})" if where else ""
    return f"nullif(count(distinct struct({column})){kept}, 0)"


def rows_sql(where: str | None = None) -> str:
    return f"nullif(count_if({where}), 0)" if where else "nullif(count(*), 0)"


def sum_sql(expression: str, where: str | None = None) -> str:
    return f"sum({expression}) filter (where {where})" if where else f"sum({expression})"


def average_sql(column: str) -> str:
    return f"avg({column})"
