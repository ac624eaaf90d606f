"""Slowly-changing history: one row per key and version, with validity bounds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fingerprint
from .skew import HOT_ROWS, hot_keys, mark_hot

_AFTER_ALL = 2**62  # slices of rows without an event time: they sort last
_TIE_LETTERS = 2  # rows without an event time are sliced by the beginning of the first tie column


@dataclass(frozen=True)
class Validity:
    """Names of the three columns and the distance between a version's end and
    the next one's start."""

    start: str = "effective_start_date"
    end: str = "effective_end_date"
    current: str = "is_current"
    gap: str = "1 second"


SECONDS = Validity()
MICROS = Validity("effective_from", "effective_to", "is_current", "1 microsecond")


def history(
    df: DataFrame,
    key: str,
    when: str,
    tracked: Sequence[str],
    validity: Validity = SECONDS,
    ties: Sequence[str] | None = None,
    form: str = "json",
    hot_rows: int | None = HOT_ROWS,
    slice_unit: str = "hour",
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Versions of each key: rows whose tracked columns differ from the row before.

    Rows are ordered by ``when`` (NULL last), equal times by ``ties`` (default: the
    tracked columns), so the result does not depend on the partitioning. A value
    that comes back (A, B, A) is a new version each time.

    Usual keys take one shuffle and one sort, shared by both windows. When some key
    has more than ``hot_rows`` rows, the rows of such keys are cut into time slices,
    each handled on its own; a small table of slice edges carries the last
    fingerprint and the next start across the cuts. ``slice_unit`` sets the size of a
    slice ("day" to "second"); edges per key are bounded by the time span. Rows without a
    time are cut by the first letters of the first tie column, if it is text. Keys are
    counted in ``count_in`` (any frame with the key column and at least as many rows of
    each key; default: ``df`` itself). ``hot_rows`` None: no key can be hot, and
    nothing is counted.
    """
    return split_history(df, key, when, tracked, validity, ties, form, hot_rows, slice_unit, count_in)[0]


def split_history(
    df: DataFrame,
    key: str,
    when: str,
    tracked: Sequence[str],
    validity: Validity = SECONDS,
    ties: Sequence[str] | None = None,
    form: str = "json",
    hot_rows: int | None = HOT_ROWS,
    slice_unit: str = "hour",
    count_in: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(the versions, the rows that repeat the version before them), as in ``history``."""
    order_ties = list(tracked if ties is None else ties)
    hot, n_hot = (None, 0) if hot_rows is None else hot_keys(df if count_in is None else count_in, [key], hot_rows)
    rows = df
    if n_hot:
        rows = mark_hot(rows.withColumn("_print", fingerprint(tracked, form)), hot, n_hot, [key], "_hot")
        moment = F.unix_seconds(F.date_trunc(slice_unit, F.col(when).cast("timestamp")))
        first = order_ties[0] if order_ties else None
        if first and dict(df.dtypes)[first] == "string":
            # in the order of the ties: NULL, then by the first letters
            begun = F.coalesce(F.concat(F.lit("x"), F.substring(first, 1, _TIE_LETTERS)), F.lit(""))
            begun = F.when(moment.isNull(), begun).otherwise("")
        else:
            begun = F.lit("")
        cut = F.struct(F.coalesce(moment, F.lit(_AFTER_ALL)).alias("at"), begun.alias("begun"))
        usual = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("begun"))
        rows = rows.withColumn("_slice", F.when(F.col("_hot"), cut).otherwise(usual))
        part = [key, "_slice"]
    else:
        part = [key]
    along = Window.partitionBy(*part).orderBy(F.asc_nulls_last(when), *(F.asc_nulls_first(c) for c in order_ties))

    if n_hot:
        rows = rows.withColumn("_before", F.lag("_print").over(along))
        last = F.max_by("_print", F.struct(when, *order_ties))
        rows = _carry(rows, part, last.alias("_edge"), F.lag, "_edge_before")
        rows = rows.withColumn("_before", F.coalesce("_before", "_edge_before")).drop("_edge_before")
        differs = F.col("_before") != F.col("_print")
    else:
        # the shuffle carries no fingerprints, and a key's only row, or its first, needs none
        rows = rows.withColumn("_before", F.lag(F.struct(*tracked)).over(along))
        differs = fingerprint(tracked, form, of="_before") != fingerprint(tracked, form)
    changed = F.col("_before").isNull() | differs
    versions = rows.where(changed).drop("_before", "_print")
    repeats = rows.where(~changed).select(*df.columns)

    following = F.lead(F.struct(F.col(when).alias("at"))).over(along)
    versions = versions.withColumn("_next", following)
    if n_hot:
        first = F.min(F.struct(F.col(when).alias("at")))
        versions = _carry(versions, part, first.alias("_edge"), F.lead, "_edge_next")
        versions = versions.withColumn("_next", F.coalesce("_next", "_edge_next")).drop("_edge_next", "_slice", "_hot")

    dated = versions.withColumns(
        {
            validity.start: F.col(when).cast("timestamp"),
            validity.end: F.col("_next.at").cast("timestamp") - F.expr(f"interval {validity.gap}"),
            validity.current: F.col("_next").isNull().cast("int"),
        }
    ).drop("_next")
    return dated, repeats


def _carry(rows: DataFrame, part: list[str], edge, direction, name: str) -> DataFrame:
    """Bring the neighbouring slice's edge value to each row of a hot key. The edge
    table has one row per hot key and non-empty slice."""
    key, slice_ = part
    neighbours = Window.partitionBy(key).orderBy(slice_)
    edges = rows.where("_hot").groupBy(*part).agg(edge).withColumn(name, direction("_edge").over(neighbours))
    return rows.join(edges.drop("_edge"), part, "left")


def current(df: DataFrame, flag: str = "is_current") -> DataFrame:
    return df.where(F.col(flag) == 1)
