"""Stored histories that take in change feeds without being built again."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.history import SECONDS, Validity, split_history
from ..operators.skew import HOT_ROWS
from .layers import Layer

PART = "history_part"  # no leading underscore: folders named so count as hidden
_SEEN = "_seen"
_CLOSED, _OPEN, _REPEATED, _KINDS = 0, 1, 2, 3


@dataclass(frozen=True)
class HistoryTable:
    """A history (see ``operators.history``) stored as ``table`` of a layer.

    Keys are dealt into ``buckets`` by their hash, and each bucket is stored in three parts:
    closed versions, open versions, and rows that changed nothing. A feed whose rows come after all
    that was seen of their keys meets the open versions alone: the open parts of
    the buckets it touches are written again, versions that it closes are added to the closed parts,
    and all other files stay. Only where a row comes late, that bucket is read whole
    and its history is drawn up again; the rows that changed nothing are kept for that, since
    a late row before one of them makes it a version. So any feeds, in any order, give what one
    build over all their rows gives.

    ``new`` frames must give the same rows each time they are read (stored ones do). Rows without
    a key are left out. An empty feed changes nothing, a repeated one adds rows that change
    nothing. The number of buckets is fixed by the first feed.
    """

    layer: Layer
    table: str
    key: str
    when: str
    tracked: tuple[str, ...]
    validity: Validity = SECONDS
    ties: tuple[str, ...] | None = None
    buckets: int = 64
    hot_rows: int | None = HOT_ROWS

    def rows(self) -> DataFrame:
        """The history as it is now."""
        return self._rows(self.layer.table(self.table))

    def open(self) -> DataFrame:
        """The current versions, from the files that hold them."""
        stored = self.layer.table(self.table)
        return stored.where(F.col(PART) % _KINDS == _OPEN).drop(PART, _SEEN)

    def merge(self, new: DataFrame) -> DataFrame:
        """Takes a feed in and returns the history. The driver gets bucket numbers, no rows."""
        new = new.where(F.col(self.key).isNotNull())
        if not self.layer.exists(self.table):
            rows = self._drawn_up(new.withColumn(_SEEN, self._order()))
            return self._rows(self.layer.overwrite(rows.hint("rebalance", PART), self.table, [PART]))
        touched = _numbers(new, self._bucket())
        if not touched:
            return self.rows()
        late = self._late(new, touched)
        read = [b * _KINDS + _OPEN for b in touched if b not in late]
        read += [b * _KINDS + kind for b in late for kind in range(_KINDS)]
        stored = self.layer.table(self.table).where(F.col(PART).isin(read))
        old = stored.drop(PART, self.validity.start, self.validity.end, self.validity.current)
        # a closed or repeated row of a late bucket stands for itself
        old = old.withColumn(_SEEN, F.coalesce(_SEEN, self._order()))
        both = old.unionByName(new.withColumn(_SEEN, self._order()), allowMissingColumns=True)
        return self._rows(self.layer.swap_parts(self._drawn_up(both), self.table, PART, read))

    def _rows(self, stored: DataFrame) -> DataFrame:
        return stored.where(F.col(PART) % _KINDS != _REPEATED).drop(PART, _SEEN)

    def _order(self) -> Column:
        """What rows of a key are ordered by: NULL times last, equal times by the ties."""
        ties = self.tracked if self.ties is None else self.ties
        named = [F.col(c).alias(f"tie{i}") for i, c in enumerate(ties)]
        return F.struct(F.col(self.when).isNull().alias("timeless"), F.col(self.when).alias("at"), *named)

    def _bucket(self) -> Column:
        return F.pmod(F.hash(F.col(self.key).cast("string")), F.lit(self.buckets))

    def _late(self, new: DataFrame, touched: list[int]) -> list[int]:
        """The buckets in which some row comes before the last row seen of its key."""
        first = new.groupBy(self.key).agg(F.min(self._order()).alias("_first"))
        stored = self.layer.table(self.table)
        seen = stored.where(F.col(PART).isin([b * _KINDS + _OPEN for b in touched])).select(self.key, _SEEN)
        return _numbers(first.join(seen, self.key).where(F.col("_first") < F.col(_SEEN)), self._bucket())

    def _drawn_up(self, rows: DataFrame) -> DataFrame:
        """Versions and repeats of the rows, as they are stored."""
        plain = rows.drop(_SEEN)
        versions, repeats = split_history(
            plain, self.key, self.when, self.tracked, self.validity, self.ties, hot_rows=self.hot_rows
        )
        seen = rows.groupBy(self.key).agg(F.max(_SEEN).alias(_SEEN))
        is_open = F.col(self.validity.current) == 1
        versions = versions.join(seen, self.key, "left").select(
            *versions.columns, F.when(is_open, F.col(_SEEN)).alias(_SEEN), F.when(is_open, _OPEN).otherwise(_CLOSED).alias("_kind")
        )
        every = versions.unionByName(repeats.withColumn("_kind", F.lit(_REPEATED)), allowMissingColumns=True)
        return every.withColumn(PART, (self._bucket() * _KINDS + F.col("_kind")).cast("int")).drop("_kind")


def _numbers(rows: DataFrame, bucket: Column) -> list[int]:
    """The buckets that rows fall into: at most as many as there are."""
    found: Iterable = rows.select(bucket.alias("bucket")).distinct().collect()
    return sorted(r[0] for r in found)
