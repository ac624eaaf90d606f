"""Reports: any measures, by any columns, under any filters, as one DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import rank_by_value
from .catalogue import NAMES, Options, Ranked, catalogue, measures, slug
from .model import COMPUTED, Context, Filter, Operand, _label, evaluate, with_computed


class _Resolver:
    """Turns measure names into columns and collects the operands they rest on."""

    def __init__(self, options: Options):
        self.formulas = measures(options)
        self.operands: dict[str, Operand] = {}
        self.ranked: dict[str, Ranked] = {}

    def __call__(self, wanted: str | Operand) -> Column:
        if isinstance(wanted, Operand):
            for name, known in self.operands.items():
                if known == wanted:
                    return F.col(name)
            name = f"_o{len(self.operands)}"
            self.operands[name] = wanted
            return F.col(name)
        formula = self.formulas[wanted]
        if isinstance(formula, Operand):
            return self(formula)
        if isinstance(formula, Ranked):
            name = f"_r_{formula.kind}"
            self.ranked[name] = formula
            return F.col(name)
        return formula(self)

    def operand(self, name: str, clear: tuple[str, ...] = (), step: str | None = None) -> Operand:
        """The operand of a measure in a changed context."""
        base = self.formulas[name]
        if not isinstance(base, Operand):
            raise TypeError(f"{name} is not a plain aggregate")
        dates = base.dates if step is None else (step, *base.dates)
        return replace(base, clear=(*base.clear, *clear), dates=dates)


def report(
    star: Mapping[str, DataFrame],
    names: Sequence[str],
    by: Sequence[str] = (),
    where: Mapping[str, Filter] | None = None,
    closing: str = "last_data",
    options: Options = Options(),
) -> DataFrame:
    """One row per group, one column per measure (its name as a column name).

    ``by`` are "table.column" names; a group without a member is NULL. ``where`` maps
    such names to allowed values, or to a function of the column. Computed columns go by
    their own names: "Loan Bucket" (of customers), "First Word" (of branch names).
    """
    by = [COMPUTED.get(c, c) for c in by]
    where = {COMPUTED.get(c, c): wanted for c, wanted in (where or {}).items()}
    star = with_computed(star, [*by, *where], options.limits, options.bands)
    context = Context(star, tuple(by), where, closing)
    resolver = _Resolver(options)
    columns = [resolver(name).alias(slug(name)) for name in names]
    for ranked in list(resolver.ranked.values()):
        resolver(ranked.base)
    grid = evaluate(context, resolver.operands)
    if resolver.ranked:
        grid = _with_ranks(context, resolver, grid)
    plain = [c.split(".", 1)[1] for c in by]
    shown = [n if plain.count(n) == 1 else _label(c) for c, n in zip(by, plain)]
    return grid.select(*(F.col(_label(c)).alias(n) for c, n in zip(by, shown)), *columns)


def pack(star: Mapping[str, DataFrame], name: str, by: Sequence[str] = (), **rest) -> DataFrame:
    """All measures of a pack."""
    return report(star, list(catalogue(rest.get("options", Options()))[name]), by, **rest)


def _with_ranks(context: Context, resolver: _Resolver, grid: DataFrame) -> DataFrame:
    """Ranks run among all customer names, also those a filter hides. Groups that are no names
    are placed by their own value among the names' values within the group."""
    base = next(iter(resolver.ranked.values())).base
    names = {r.kind: n for n, r in resolver.ranked.items()}
    if NAMES not in context.by:
        return _placed(context, grid, resolver.formulas[base], resolver(base), names)
    among = replace(context, where={c: f for c, f in context.where.items() if c != NAMES})
    labels = [_label(c) for c in context.by]
    within = [c for c in labels if c != _label(NAMES)]
    totals = evaluate(among, {"_total": resolver.formulas[base]})
    ranks = rank_by_value(totals, "_total", within, "_r_rank", "_r_running").select(*labels, *names.values())
    same = reduce(lambda a, b: a & b, (F.col(f"g.{c}").eqNullSafe(F.col(f"r.{c}")) for c in labels))
    kept = [F.col(f"g.{c}") for c in grid.columns] + [F.col(f"r.{n}") for n in names.values()]
    return grid.alias("g").join(ranks.alias("r"), same, "left").select(*kept)


def _placed(context: Context, grid: DataFrame, base: Operand, value: Column, names: Mapping[str, str]) -> DataFrame:
    """``grid`` with the place of each group's value: one more than the different greater
    values of names in the group, and the sum of those at least as great. A blank counts as zero.
    Each name's value meets the one row of its group."""
    among = replace(context, by=(*context.by, NAMES), where={c: f for c, f in context.where.items() if c != NAMES})
    labels = [_label(c) for c in context.by]
    totals = evaluate(among, {"_total": base}).select(*labels, F.coalesce("_total", F.lit(0)).alias("_total"))
    own = grid.select(*labels, F.coalesce(value, F.lit(0)).alias("_own"))
    if labels:
        same = reduce(lambda a, b: a & b, (F.col(f"t.{c}").eqNullSafe(F.col(f"o.{c}")) for c in labels))
        met = totals.alias("t").join(own.alias("o"), same).select(*(F.col(f"o.{c}") for c in labels), "_total", "_own")
    else:
        met = totals.crossJoin(F.broadcast(own))  # one row
    made = {
        "rank": F.count_distinct(F.when(F.col("_total") > F.col("_own"), F.col("_total"))) + 1,
        "running": F.sum(F.when(F.col("_total") >= F.col("_own"), F.col("_total"))),
    }
    ranks = met.groupBy(*labels).agg(*(made[kind].alias(name) for kind, name in names.items()))
    if not labels:
        return grid.crossJoin(F.broadcast(ranks))
    same = reduce(lambda a, b: a & b, (F.col(f"g.{c}").eqNullSafe(F.col(f"r.{c}")) for c in labels))
    first = F.lit(1).cast("long")  # a group without any name
    placed = [F.coalesce(F.col(f"r.{n}"), first).alias(n) if kind == "rank" else F.col(f"r.{n}") for kind, n in names.items()]
    return grid.alias("g").join(ranks.alias("r"), same, "left").select(*(F.col(f"g.{c}") for c in grid.columns), *placed)
