"""Placing rows on shards by a hierarchical weighted hash tree."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import gapless, numbered, pick, store, whole


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def even_tree(regions: int, racks: int, shards: int) -> list[Leaf]:
    """Equal weights; shards are numbered in order."""
    return [
        Leaf(f"r{r}", f"r{r}/k{k}", (r * racks + k) * shards + s)
        for r in range(regions) for k in range(racks) for s in range(shards)
    ]


def grown(tree: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a region of its own. No other subtree's weight changes, so
    rows move to the new shard only. (A shard added inside a present region also
    draws rows from other regions into its neighbours: their region grew.)"""
    new = max(leaf.shard for leaf in tree) + 1
    return [*tree, Leaf(f"r+{new}", f"r+{new}/k0", new, weight)]


def _children(tree: Sequence[Leaf]) -> list[dict[str, dict[str, float]]]:
    """Per level: parent -> child -> weight, the sum of the leaves below."""
    levels: list[dict[str, dict[str, float]]] = [{}, {}, {}]
    for leaf in tree:
        if leaf.weight < 0:
            raise ValueError("weights must not be negative")
        if leaf.weight:
            path = ("", leaf.region, leaf.rack, f"s{leaf.shard}")
            for level, parent, child in zip(levels, path, path[1:], strict=False):
                below = level.setdefault(parent, {})
                below[child] = below.get(child, 0.0) + leaf.weight
    if not levels[0]:
        raise ValueError("a tree needs a shard with a weight")
    return levels


def _drawn(key: Column, parent: Column | None, level: dict[str, dict[str, float]]) -> Column:
    """The child with the smallest -ln(u) / weight, u being a hash of the row's key and
    the child: child i wins with probability weight_i / sum, and a change of one
    weight moves rows only into or out of that child."""
    def nodes(children: dict[str, float]) -> Column:
        return F.array(*(F.struct(F.lit(n).alias("node"), F.lit(w).alias("weight")) for n, w in sorted(children.items())))

    if parent is None:
        candidates = nodes(level[""])
    else:
        candidates = F.element_at(F.create_map(*(c for p, below in level.items() for c in (F.lit(p), nodes(below)))), parent)

    def draw(child: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, child["node"]), 11) + 0.5) / float(2**53)
        return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["node"].alias("node"))

    return F.array_min(F.transform(candidates, draw))["node"]


def place(df: DataFrame, tree: Sequence[Leaf], key: str, name: str = "shard") -> DataFrame:
    """Adds ``name``, the shard of each row, from the long column ``key`` alone: descends
    region, rack and shard, with one weighted draw a level. The tree is part of the
    plan, so its size is that of the configuration."""
    regions, racks, shards = _children(tree)
    return (
        df.withColumn("_region", _drawn(F.col(key), None, regions))
        .withColumn("_rack", _drawn(F.col(key), F.col("_region"), racks))
        .withColumn(name, F.substring(_drawn(F.col(key), F.col("_rack"), shards), 2, 12).cast("int"))
        .drop("_region", "_rack")
    )


def shard_documents(docs: DataFrame, tree: Sequence[Leaf], more: Sequence[Leaf], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    The id decides the shard; a row whose id is null is placed by its text. ``size``
    is the text's UTF-8 bytes plus 1, a null text counting as empty. Slots are
    gapless in each shard, also when one id or text makes up most rows. Repeated
    rows share a shard and have slots of their own.
    """
    text = whole(text_col)
    rows = pick(docs, id_col, text_col).select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col(id_col).isNotNull(), F.xxhash64(F.col(id_col).cast("string"))).otherwise(F.xxhash64(text)).alias("key"),
    )
    placed = store(numbered(place(place(rows, tree, "key"), more, "key", "grown_shard").drop("key")), "placed")
    return gapless(placed, ["shard"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
