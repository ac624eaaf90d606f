"""Helpers the operators share: exact column picking, stored steps, gapless numbering."""

from __future__ import annotations

import os
from collections.abc import Sequence
from pathlib import Path
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_folder

#: A word, everywhere in this package: a run without space, tab, line feed, vertical tab, form feed or return.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROOT = str(Path(__file__).resolve().parents[2])


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, matched by exact spelling and position, so columns that differ
    only in case, or bear an operator's own names, do no harm. A missing one raises."""
    columns = df.columns
    missing = [n for n in names if n not in columns]
    if missing:
        raise ValueError(f"no column {missing} in {columns}")
    plain = df.toDF(*(f"c{i}" for i in range(len(columns))))
    return plain.select(*(F.col(f"c{columns.index(n)}").alias(n) for n in names))


def store(df: DataFrame, name: str) -> DataFrame:
    """Writes a step as Parquet in the shared folder and reads it back: lineage ends
    there, so a lost executor costs no more than the step that was running. The
    folder may be removed once the query's result is stored."""
    path = f"{shared_folder(df.sparkSession)}/lakemart-llm/{uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Lets Python workers that start from now on import this package from where the
    driver has it; on a cluster that has it installed, this changes nothing."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, _ROOT)))


def whole(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def uncased(text: Column) -> Column:
    """A-Z lower-cased, every other letter as it was. Pure ASCII takes the quick way."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def numbered(df: DataFrame) -> DataFrame:
    """Adds the input partition and the place in it. Only stable once stored."""
    return df.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))


def gapless(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Numbers the rows of each key from 0 without gaps. ``rows`` is a stored table with
    ``part`` and ``row`` from ``numbered``.

    A key is numbered inside each input partition and shifted by its rows in the
    partitions before, so no task ever holds more of a key than one input
    partition did, however many rows the key has.
    """
    sizes = rows.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*keys, "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy(*keys, "part").orderBy("row")
    placed = rows.withColumn("place", F.row_number().over(inside))
    return placed.join(shifts, [*keys, "part"]).withColumn(name, F.col("shift") + F.col("place") - 1).drop("shift", "place")
