"""Exact duplicates by a heavy-hitter split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, store, uncased, whole

#: A digest with more than this share of all rows is settled without a shuffle.
SUPPORT = 0.001


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """Every row with its group: ``doc_id, keep_id, group_size, kept, text_sha256, row``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The
    row with the largest id stays; a null id is smaller than any other, and of rows
    equal in both id and text one stays. An empty table gives no rows.

    ``freqItems`` is Misra-Gries counting: it keeps at most ``1 / support`` digests and
    misses none with a larger share. Those candidates are counted exactly, which
    weeds out false ones and finds each winner; the winners, at most ``1 / support``
    rows, are broadcast and settle their groups in the map tasks. The other groups
    have at most ``support`` of the rows and meet in an ordinary shuffle of digests.
    """
    digest = F.sha2(uncased(whole(text_col)), 256)
    rows = store(
        pick(docs, id_col, text_col).select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), digest.alias("text_sha256")
        ),
        "digests",
    )
    return _settled(rows, support)


def _settled(rows: DataFrame, support: float) -> DataFrame:
    total = rows.count()
    short = F.xxhash64("text_sha256")
    candidates = rows.select(short.alias("short")).freqItems(["short"], support).select(F.explode("short_freqItems").alias("short"))
    last = F.max(F.struct("doc_id", "row")).alias("last")
    winners = store(
        rows.withColumn("short", short)
        .join(F.broadcast(candidates), "short", "left_semi")
        .groupBy("text_sha256")
        .agg(F.count(F.lit(1)).alias("group_size"), last)
        .where(F.col("group_size") > support * total),
        "winners",
    )
    marked = rows.join(F.broadcast(winners), "text_sha256", "left")
    frequent = marked.where(F.col("group_size").isNotNull())
    group = Window.partitionBy("text_sha256")
    others = (
        marked.where(F.col("group_size").isNull())
        .select("text_sha256", "doc_id", "row")
        .withColumns({
            "group_size": F.count(F.lit(1)).over(group),
            "last": F.max(F.struct("doc_id", "row")).over(group),
        })
    )
    return frequent.unionByName(others).select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("last.row")).alias("kept"), "text_sha256", "row",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` drops, all columns kept. Rows are
    numbered in a stored copy, so equal rows stay apart and no copied text
    meets its copies in a shuffle."""
    columns = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(columns))))
    copy = store(plain.withColumn("row", F.monotonically_increasing_id()), "documents")
    text, key = (F.col(f"c{columns.index(n)}") for n in (text_col, id_col))
    rows = store(
        copy.select("row", key.alias("doc_id"), F.sha2(uncased(F.coalesce(text, F.lit(""))), 256).alias("text_sha256")), "digests"
    )
    kept = _settled(rows, support).where("kept").select("row")
    return copy.join(kept, "row", "left_semi").drop("row").toDF(*columns)
