"""Ranks and running totals by value, without putting all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def rank_by_value(
    df: DataFrame, value: str, within: Sequence[str] = (), rank: str = "rank", running: str = "running", buckets: int | None = None
) -> DataFrame:
    """Adds the dense rank of each row's value, greatest first, and the sum of all
    values at least as great (ties included); a blank value counts as zero.

    Equal values are merged before anything is ordered. The distinct values are cut
    into value buckets at approximate percentiles (a list of ``buckets`` numbers),
    ordered inside each bucket, and shifted by the totals of the buckets above. The
    cuts need not be exact: any cuts give the same result. By default there are as
    many buckets as shuffle partitions. ``within`` columns start a new ranking.
    """
    within = list(within)
    kind = dict(df.dtypes)[value]
    # values are compared in their own type; sums of whole numbers get room to grow
    wide = kind if kind.startswith("decimal") or kind in ("float", "double") else "decimal(38,0)"
    rows = df.withColumn("_v", F.coalesce(F.col(value), F.lit(0).cast(kind)))
    each = rows.groupBy(*within, "_v").agg(F.sum(F.col("_v").cast(wide)).alias("_sum"))

    buckets = buckets or max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / buckets for i in range(1, buckets)]
    cuts = each.agg(F.percentile_approx(F.col("_v").cast("double"), shares, 1_000).alias("cuts")).first()["cuts"]
    if cuts:
        # how many cuts lie below the value
        cut_list = F.array(*(F.lit(float(c)) for c in sorted(set(cuts))))
        bucket = F.size(F.filter(cut_list, lambda c: c < F.col("_v").cast("double")))
    else:
        bucket = F.lit(0)
    each = each.withColumn("_bucket", bucket)

    above = Window.partitionBy(*within).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        each.groupBy(*within, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_sum").alias("_s"))
        .select(
            *within, "_bucket",
            F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_ranks_above"),
            F.coalesce(F.sum("_s").over(above), F.lit(0)).alias("_sum_above"),
        )
    )
    here = Window.partitionBy(*within, "_bucket").orderBy(F.desc("_v"))
    placed = each.withColumns(
        {
            "_rank": F.row_number().over(here),
            "_run": F.sum("_sum").over(here.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    placed = placed.alias("p").join(totals.alias("t"), _same("p", "t", [*within, "_bucket"])).select(
        *(F.col(f"p.{c}") for c in (*within, "_v")),
        (F.col("_rank") + F.col("_ranks_above")).alias(rank),
        (F.col("_run") + F.col("_sum_above")).alias(running),
    )
    return rows.alias("r").join(placed.alias("p"), _same("r", "p", [*within, "_v"])).select(
        *(F.col(f"r.{c}") for c in df.columns), rank, running
    )


def top(df: DataFrame, value: str, n: int, within: Sequence[str] = ()) -> DataFrame:
    """The n greatest rows per group, ties at the last place included.

    Looks at distinct values, not rows: at most n of them per group can qualify, so
    each map task sends n per group and no amount of ties fills up a task. The rows
    are then picked by their values.
    """
    within = list(within)
    greatest = Window.partitionBy(*within).orderBy(F.desc_nulls_last(value))
    before = F.sum("_n").over(greatest.rowsBetween(Window.unboundedPreceding, -1))
    kept = (
        df.groupBy(*within, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_place", F.row_number().over(greatest))
        .where(F.col("_place") <= n)
        .withColumn("_before", F.coalesce(before, F.lit(0)))
        .where(F.col("_before") < n)
    )
    return df.alias("d").join(kept.alias("k"), _same("d", "k", [*within, value]), "left_semi")


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Equality of the columns of two aliased frames, NULL equal to NULL."""
    return reduce(lambda a, b: a & b, (F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns))
