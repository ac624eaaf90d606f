"""Surrogate keys: dense, and the same on every run and partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_surrogate_key(df: DataFrame, business_key: str, name: str, hex_digits: int = 3) -> DataFrame:
    """Adds ``name`` = 0..n-1, in the order (hash prefix of the key, key).

    Rows are numbered inside 16 ** hex_digits hash buckets, evenly filled whatever
    the keys look like, and shifted by the rows in lower buckets. Only the bucket
    sizes (4,096 rows by default, whatever the data) go through one task and are
    broadcast. The business key must be unique.
    """
    if not 1 <= hex_digits <= 4:
        raise ValueError("hex_digits must be 1 to 4")
    key = F.col(business_key).cast("string")
    bucket = F.substring(F.md5(key), 1, hex_digits)
    rows = df.withColumn("_bucket", bucket)
    below = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(below), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy(key)
    return (
        rows.withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .select((F.col("_offset") + F.col("_place") - 1).cast("long").alias(name), *df.columns)
    )
