"""Cleaning: renames, rules, audit columns, key filters, valid / reject split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule, text


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are there; never onto a name already taken."""
    present = set(df.columns)
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in present and new not in present})


def clean(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """Apply one rule per column in a single projection; rules for absent columns
    and columns without a rule are left alone."""
    return df.select(*(rules[c](F.col(c)).alias(c) if c in rules else F.col(c) for c in df.columns))


def require_keys(df: DataFrame, keys: Sequence[str], blank_is_missing: bool = False) -> DataFrame:
    """Rows whose keys are all present. By default an empty text passes."""
    for key in (k for k in keys if k in df.columns):
        there = F.col(key).isNotNull()
        df = df.where(there & (text(F.col(key)) != "") if blank_is_missing else there)
    return df


def split(df: DataFrame, accepted: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, reject): each row lands in exactly one, an unknown verdict rejects."""
    verdict = F.ifnull(accepted, F.lit(False))
    return df.where(verdict), df.where(~verdict)


def audited(df: DataFrame, load_ts: datetime | str | None = None, default_source: str = "bronze") -> DataFrame:
    """Trimmed record source (or the default) and the load time; pass ``load_ts``
    to make a run repeatable."""
    source = text(F.col("record_source")) if "record_source" in df.columns else F.lit(default_source)
    loaded = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp")
    return df.withColumns({"record_source": source, "silver_load_ts": loaded})


def event_time(columns: Sequence[str], fallback: datetime | str | None = None) -> Column:
    """First known of the given times, then the load time."""
    last = F.current_timestamp() if fallback is None else F.lit(fallback).cast("timestamp")
    return F.coalesce(*(F.col(c) for c in columns), last)


def merge_changes(base: DataFrame, delta: DataFrame) -> DataFrame:
    """Base rows and delta rows together, columns matched by name."""
    return base.unionByName(delta)
