"""Cleaning rules: each takes a column and returns the cleaned column.

Casts use the ``try_`` forms, so unreadable input becomes NULL also when the
session runs in ANSI mode.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = Callable[[Column], Column]


def text(c: Column) -> Column:
    return F.trim(c.cast("string"))


def code(c: Column) -> Column:
    return F.upper(text(c))


def lower_text(c: Column) -> Column:
    return F.lower(text(c))


def day(c: Column) -> Column:
    return c.try_cast("date")


def moment(c: Column) -> Column:
    return c.try_cast("timestamp")


def whole(c: Column) -> Column:
    # '12.0' is a whole number too, only not to a direct cast
    return F.coalesce(c.try_cast("int"), c.try_cast("decimal(38,6)").try_cast("int"))


def amount(precision: int = 18, scale: int = 2) -> Rule:
    """Decimal of the given size; thousands separators are dropped first."""

    def rule(c: Column) -> Column:
        digits = F.replace(F.trim(c.cast("string")), F.lit(","), F.lit(""))
        return digits.try_cast(f"decimal({precision},{scale})")

    return rule


money = amount(18, 2)
rate = amount(10, 4)
