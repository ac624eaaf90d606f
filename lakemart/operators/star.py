"""Star joins: business keys of a fact replaced by the dimensions' keys."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Lookup(NamedTuple):
    dimension: DataFrame
    key: str  # the surrogate key to fetch
    business_key: str  # the dimension's column
    on: str | Column  # the fact's column or expression

    def column(self) -> Column:
        return F.col(self.on) if isinstance(self.on, str) else self.on


def attach_keys(facts: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Left joins on each business key: no row is lost, an unknown or NULL key
    gives a NULL surrogate key.

    No broadcast is forced, since dimensions grow with the data: tables under the
    session's threshold are broadcast, larger ones are sort-merge joined with
    adaptive splitting of skewed partitions. Days meet as numbers, which Spark
    looks up by place where it would hash whole rows for dates.
    """
    columns = facts.columns
    for i, look in enumerate(lookups):
        side = look.dimension.select(F.col(look.business_key).alias(f"_on{i}"), F.col(look.key).alias(f"_key{i}"))
        joined = facts.withColumn(f"_from{i}", look.column())
        if dict(side.dtypes)[f"_on{i}"] == dict(joined.dtypes)[f"_from{i}"] == "date":
            side = side.withColumn(f"_on{i}", F.unix_date(f"_on{i}"))
            joined = joined.withColumn(f"_from{i}", F.unix_date(f"_from{i}"))
        facts = joined.join(side, F.col(f"_from{i}") == F.col(f"_on{i}"), "left").drop(f"_from{i}", f"_on{i}")
    fetched = {look.key: f"_key{i}" for i, look in enumerate(lookups)}
    kept = [c for c in columns if c not in fetched]
    return facts.select(*kept, *(F.col(temporary).alias(key) for key, temporary in fetched.items()))
