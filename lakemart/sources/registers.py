"""Surrogate keys that outlive a load: a stored register of who has which number."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import with_surrogate_key
from .layers import Layer


@dataclass(frozen=True)
class KeyRegister:
    """The numbers given to the members of a dimension, stored as ``table`` of a layer.

    A member keeps its number for good, also while the dimension does not show it. New ones get
    the numbers after the greatest ever given, in the order of ``with_surrogate_key``, so
    facts that hold the numbers never need to be written again. Members are told apart by
    ``business_key``; rows without one get no number.
    """

    layer: Layer
    table: str
    business_key: str
    name: str

    def remember(self, pairs: DataFrame) -> None:
        """Takes over numbers given earlier: rows with the business key and the number. Members
        the register knows keep the number they have there."""
        given = pairs.select(self.business_key, F.col(self.name).cast("long").alias(self.name))
        self._add(given.where(f"`{self.business_key}` is not null and `{self.name}` is not null"))

    def grow(self, members: DataFrame) -> DataFrame:
        """Numbers the members that have no number yet, and returns the register. Only they are
        written; a repeated call changes nothing."""
        shown = members.select(self.business_key).where(F.col(self.business_key).isNotNull()).distinct()
        if not self.layer.exists(self.table):
            return self.layer.overwrite(with_surrogate_key(shown, self.business_key, self.name), self.table)
        known = self.layer.table(self.table)
        fresh = shown.join(known, self.business_key, "left_anti")
        last = known.agg(F.max(self.name)).first()[0]  # one number
        after = F.lit(0 if last is None else last + 1)
        numbered = with_surrogate_key(fresh, self.business_key, self.name)
        return self._add(numbered.withColumn(self.name, (F.col(self.name) + after).cast("long")))

    def attach(self, rows: DataFrame) -> DataFrame:
        """The rows with their members' numbers, first; NULL for a member without one."""
        known = self.layer.table(self.table)
        return rows.join(known, self.business_key, "left").select(self.name, *rows.columns)

    def _add(self, pairs: DataFrame) -> DataFrame:
        if not self.layer.exists(self.table):
            return self.layer.overwrite(pairs.select(self.name, self.business_key), self.table)
        known = self.layer.table(self.table)
        fresh = pairs.join(known.select(self.business_key), self.business_key, "left_anti")
        if fresh.isEmpty():
            return known
        return self.layer.append(fresh.select(*known.columns), self.table)
