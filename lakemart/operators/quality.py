"""Data-quality checks, each a small aggregate over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = (
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    )
    return reduce(DataFrame.unionByName, counts)


def key_coverage(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(table_name, key_name, row_count, known) per foreign key: one scan, all keys."""
    entries = F.array(*(F.struct(F.lit(k).alias("key_name"), F.count(k).alias("known")) for k in keys))
    counted = df.agg(F.count(F.lit(1)).alias("row_count"), entries.alias("entries"))
    return counted.select(F.lit(name).alias("table_name"), "row_count", F.inline("entries")).select(
        "table_name", "key_name", "row_count", "known"
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def date_profile(df: DataFrame, column: str) -> DataFrame:
    day = F.to_date(column)
    return df.agg(
        F.min(day).alias("min_date"),
        F.max(day).alias("max_date"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(day).alias("distinct_dates"),
        F.count_if(day.isNull()).alias("null_dates"),
    )


def date_distribution(df: DataFrame, column: str, amount: str, first: int | None = None) -> DataFrame:
    """Rows and total per day, in order; ``first``: only so many days."""
    by_day = df.groupBy(F.to_date(column).alias("payment_dt")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(amount).alias("total_payment")
    )
    ordered = by_day.orderBy("payment_dt")
    return ordered if first is None else ordered.limit(first)


def rule_result(table: str, rule: str, violations: DataFrame) -> DataFrame:
    """One result row: how many rows break the rule."""
    return violations.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule_name"), "row_count"
    )


def coverage_results(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return key_coverage(name, df, keys).select(
        "table_name",
        F.concat(F.lit("unknown_"), F.col("key_name")).alias("rule_name"),
        (F.col("row_count") - F.col("known")).alias("row_count"),
    )


def collect_results(results: Sequence[DataFrame], batch_id: str, executed: datetime | str) -> DataFrame:
    """Rows for the result table: all checks stacked, with batch and time."""
    return reduce(DataFrame.unionByName, results).withColumns(
        {"batch_id": F.lit(batch_id), "execution_ts": F.lit(executed).cast("timestamp")}
    )
