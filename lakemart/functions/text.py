"""Text expressions: row fingerprints, first word, value bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .blank import zero

# The text form's separator and its stand-in for NULL.
SEPARATOR = "||"
NULL_TEXT = "NULL"


def fingerprint(columns: Sequence[str], form: str = "json", of: str | None = None) -> Column:
    """SHA-256 of the tracked columns, or of the fields of these names in the struct ``of``.

    ``json`` tells all values apart. ``text`` is the fixed older form: values joined by a
    separator, with a word for NULL; a value equal to that word, or holding the
    separator, can collide.
    """
    values = [F.col(c) if of is None else F.col(of).getField(c) for c in columns]
    if form == "json":
        body = F.to_json(F.struct(*(v.alias(c) for v, c in zip(values, columns))), {"ignoreNullFields": "false"})
    else:
        body = F.concat_ws(SEPARATOR, *(F.coalesce(v.cast("string"), F.lit(NULL_TEXT)) for v in values))
    return F.sha2(body, 256)


def first_word(c: Column) -> Column:
    return F.substring_index(F.trim(c), " ", 1)


# Upper limits (exclusive) and names of the exposure bands.
EXPOSURE_LIMITS = (7_500_000, 9_900_000, 15_000_000)
EXPOSURE_NAMES = ("Small", "Medium", "Large", "High Value")


def band(c: Column, limits: Sequence[float] = EXPOSURE_LIMITS, names: Sequence[str] = EXPOSURE_NAMES) -> Column:
    """Name of the first band whose limit is above the value; blank counts as 0."""
    out = F.lit(names[-1])
    for limit, name in reversed(list(zip(limits, names))):
        out = F.when(zero(c) < limit, F.lit(name)).otherwise(out)
    return out
