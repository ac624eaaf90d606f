"""Finding keys that hold too many rows for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is cut into pieces before a per-key window.
HOT_ROWS = 5_000_000
# A list of hot keys up to this many rows is sent to every task.
BROADCAST_KEYS = 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> tuple[DataFrame, int]:
    """(keys with more than ``hot_rows`` rows, how many there are).

    Reads the key columns only, counts before the shuffle, and brings one number
    to the driver: it decides between plans, and it is the size check for
    broadcasting the list (which has at most rows / hot_rows entries).
    """
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).drop("_n")
    return hot, hot.count()


def mark_hot(df: DataFrame, hot: DataFrame, n_hot: int, keys: Sequence[str], flag: str) -> DataFrame:
    side = hot.withColumn(flag, F.lit(True))
    if n_hot <= BROADCAST_KEYS:
        side = F.broadcast(side)
    return df.join(side, list(keys), "left").withColumn(flag, F.col(flag).isNotNull())
