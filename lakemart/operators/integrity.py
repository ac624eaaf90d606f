"""Referential integrity: keep children of known parents, or mark the orphans."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cleaning import split


class Parent(NamedTuple):
    table: DataFrame
    key: str


def keep_children(df: DataFrame, parents: Mapping[str, Parent]) -> DataFrame:
    """Rows whose every foreign key (column -> parent) exists; a NULL key does not.

    Semi joins: no duplicates from parents with several rows per key, so no
    distinct. Small parents are broadcast by their size; for large ones adaptive
    execution splits the partitions of a foreign key that holds too many rows.
    """
    for column, parent in parents.items():
        keys = parent.table.select(F.col(parent.key).alias(column))
        df = df.join(keys, column, "left_semi").select(*df.columns)
    return df


def mark_orphans(df: DataFrame, parents: Mapping[str, Parent]) -> DataFrame:
    """Adds ``_found_<column>`` per foreign key, in one pass over the rows."""
    for column, parent in parents.items():
        keys = parent.table.select(F.col(parent.key).alias(column)).distinct().withColumn(f"_found_{column}", F.lit(True))
        df = df.join(keys, column, "left")
    found = {f"_found_{c}": F.col(f"_found_{c}").isNotNull() for c in parents}
    return df.withColumns(found)


def split_orphans(df: DataFrame, parents: Mapping[str, Parent]) -> tuple[DataFrame, DataFrame]:
    """(valid, reject): reject has at least one foreign key without a parent."""
    marked = mark_orphans(df, parents)
    flags = [f"_found_{c}" for c in parents]
    all_found = F.lit(True)
    for flag in flags:
        all_found = all_found & F.col(flag)
    valid, reject = split(marked, all_found)
    return valid.select(*df.columns), reject.select(*df.columns)
