"""The star model: who filters whom, and evaluating aggregates under a filter context.

A report asks for measures by some columns under some filters. Each measure rests on
operands: one aggregate over one fact. An operand sees a group column or a filter
only when its fact is related to that column's table, directly or by a virtual
relationship; otherwise it repeats the same value along that column.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blank import distinct_sql
from ..functions.text import band, first_word
from ..operators.calendar import date_key
from ..operators.marts import side_by_side
from ..operators.ranking import top

T = "fact_transactions"
L = "fact_loans"
P = "fact_loan_payments"
B = "fact_daily_balances"
S = "fact_branch_daily_summary"
C = "fact_customer_daily_wide"
DATE, CUSTOMER, BRANCH = "dim_date", "dim_customer", "dim_branch"
MONTH = "month_key"  # partition column of stored facts: date_key without the day


@dataclass(frozen=True)
class Relationship:
    dimension: str
    key: str
    fact: str
    foreign_key: str
    active: bool = True


# The model's relationships. Filters flow from dimension to fact only.
RELATIONSHIPS = (
    Relationship("dim_date", "Date_Key", "fact_transactions", "date_key"),
    Relationship("dim_date", "Date_Key", "fact_loan_payments", "date_key", active=False),
    Relationship("dim_date", "Date_Key", "fact_daily_balances", "date_key", active=False),
    Relationship("dim_customer", "customer_key", "fact_transactions", "customer_key"),
    Relationship("dim_branch", "branch_key", "fact_transactions", "branch_key"),
    Relationship("dim_account", "account_key", "fact_daily_balances", "account_key"),
    Relationship("dim_account", "account_key", "fact_transactions", "account_key"),
    Relationship("dim_channel", "channel_key", "fact_transactions", "channel_key"),
    Relationship("dim_txn_type", "txn_type_key", "fact_transactions", "txn_type_key"),
    Relationship("dim_branch", "branch_key", "fact_daily_balances", "branch_key"),
    Relationship("dim_branch", "branch_key", "fact_loans", "branch_key"),
    Relationship("dim_loan", "loan_key", "fact_loan_payments", "loan_key"),
    Relationship("dim_loan", "loan_key", "fact_loans", "loan_key"),
    Relationship("dim_date", "Date_Key", "fact_loans", "date_key"),
    Relationship("dim_branch", "branch_key", "fact_loan_payments", "branch_key"),
)
# dimension -> its key; a virtual relationship meets the fact's column of the same
# name, whatever its case
DIMENSION_KEYS = {r.dimension: r.key for r in RELATIONSHIPS}


def foreign_key(dimension: str) -> str:
    return DIMENSION_KEYS[dimension].lower()


# Computed columns, by the names reports know them by.
COMPUTED = {"Loan Bucket": "dim_customer.Loan_Bucket", "First Word": "dim_branch.First_Word"}


def with_computed(star: Mapping[str, DataFrame], used: Sequence[str], limits: Sequence[float], names: Sequence[str]) -> Mapping[str, DataFrame]:
    """The star with the computed columns that a report uses: the band of each
    customer's whole exposure, and the first word of a branch's name."""
    changed = {}
    if COMPUTED["Loan Bucket"] in used:
        exposure = star[L].groupBy("customer_key").agg(F.sum("principal_amount").alias("_exposure"))
        customers = star[CUSTOMER].join(exposure, "customer_key", "left")
        changed[CUSTOMER] = customers.withColumn("Loan_Bucket", band(F.col("_exposure"), limits, names)).drop("_exposure")
    if COMPUTED["First Word"] in used:
        changed[BRANCH] = star[BRANCH].withColumn("First_Word", first_word(F.col("branch_name")))
    return _Changed(star, changed) if changed else star


def related(fact: str) -> set[str]:
    return {r.dimension for r in RELATIONSHIPS if r.fact == fact and r.active}


class _Changed(Mapping):
    """A star with some tables in another form."""

    def __init__(self, star: Mapping[str, DataFrame], tables: Mapping[str, DataFrame]):
        self._star, self._tables = star, tables

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables[name] if name in self._tables else self._star[name]

    def summed(self, name: str, columns: Sequence[str], values: Sequence[str]) -> DataFrame | None:
        return None if name in self._tables else _offered(self._star, "summed", name, columns, values)

    def numbered(self, name: str, column: str, columns: Sequence[str]) -> DataFrame | None:
        return None if name in self._tables else _offered(self._star, "numbered", name, column, columns)

    def __iter__(self):
        return iter(self._star)

    def __len__(self) -> int:
        return len(self._star)


def _offered(star: Mapping[str, DataFrame], form: str, *asked) -> DataFrame | None:
    """A fact in a shorter form, where the star has one: ``summed`` by columns, or its ids ``numbered``."""
    offer = getattr(star, form, None)
    return offer(*asked) if offer else None


Filter = Sequence | Callable[[Column], Column]


def _table(column: str) -> str:
    return column.split(".", 1)[0]


def _name(column: str) -> str:
    return column.split(".", 1)[1]


def _label(column: str) -> str:
    return column.replace(".", "__")


@dataclass(frozen=True)
class Operand:
    """One aggregate over one fact (or over a dimension's own rows).

    through: dimensions reached by a virtual relationship, besides the active ones
    clear:   tables ("dim_branch") or columns ("dim_branch.branch_name") whose
             filters and grouping are lifted
    dates:   the date context instead of the report's own: "mtd", "ytd",
             "previous_month", then "closing" (last day) or "single" (only day)
    top:     (n, column): only the rows of the n greatest members of the column
    both:    (other fact, key): count the keys found in both facts instead
    given:   ((column, allowed values), ...): filters of the operand's own, in place
             of the report's filters on those columns
    distinct: the column whose distinct values the aggregate counts, if it does
    adds:    whether the values of the parts of a group sum up to the group's
    sums:    the column that the aggregate sums up, if it does that and no more
    serial:  of a distinct count of ids that are a name and a running number ("L1_12"; others are
             counted as well): the condition under which a row counts
    """

    fact: str
    sql: str
    through: tuple[str, ...] = ()
    clear: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    top: tuple[int, str] | None = None
    both: tuple[str, str] | None = None
    given: tuple[tuple[str, tuple], ...] = ()
    distinct: str | None = None
    adds: bool = False
    serial: str | None = None
    sums: str | None = None

    def reads(self) -> tuple[list[str], list[str]] | None:
        """The columns whose distinct combinations the aggregate needs, and those it sums up; None: it needs
        whole rows."""
        if self.sums:
            return [], [self.sums]
        return ([self.distinct], []) if self.distinct and self.sql == distinct_sql(self.distinct) else None

    def reaches(self, column: str) -> bool:
        table = _table(column)
        if table in self.clear or column in self.clear:
            return False
        known = table == self.fact or table in related(self.fact) or table in self.through
        return known or (table == DATE and bool({"closing", "single"} & set(self.dates)))

    def settled(self) -> Operand:
        """Without a date shift where dates do not reach the fact."""
        return self if not self.dates or self.reaches(f"{DATE}.Date") else replace(self, dates=())


@dataclass(frozen=True)
class Context:
    """What a report shows: the group columns ("dim_branch.region"), the filters
    (column -> allowed values, or a test on the column), and how a closing date is
    found: the last calendar day of the period ("calendar") or the last day of the
    period on which the fact has rows ("last_data")."""

    star: Mapping[str, DataFrame]
    by: tuple[str, ...] = ()
    where: Mapping[str, Filter] = field(default_factory=dict)
    closing: str = "last_data"
    spans: dict = field(default_factory=dict, compare=False)  # first and last day in reach, by date filters

    def only(self, operand: Operand) -> Context:
        """The part of the context the operand sees."""
        seen = {c: f for c, f in self.where.items() if operand.reaches(c)} | dict(operand.given)
        return replace(self, by=tuple(c for c in self.by if operand.reaches(c)), where=seen)


def _test(column: Column, wanted: Filter) -> Column:
    return wanted(column) if callable(wanted) else column.isin(*wanted)


def _members(context: Context, table: str, extra: Sequence[str] = ()) -> tuple[DataFrame, bool]:
    """A dimension's key and group columns under the context's filters, and whether
    anything was filtered."""
    rows = context.star[table]
    filtered = False
    for column, wanted in context.where.items():
        if _table(column) == table:
            rows = rows.where(_test(F.col(_name(column)), wanted))
            filtered = True
    shown = [c for c in context.by if _table(c) == table]
    return rows.select(*(F.col(_name(c)).alias(_label(c)) for c in shown), *extra), filtered


def fact_rows(context: Context, operand: Operand, reads: tuple[list[str], list[str]] | None = None, ids: bool = False) -> DataFrame:
    """The fact's rows in context, with the group columns. A dimension is joined only
    when the report groups or filters by it. Grouping alone keeps facts without a
    member, as a NULL group; a filter drops them.

    A caller that needs no more than distinct combinations of some columns and sums of others names both in
    ``reads``; one that counts the operand's ids asks for ``ids``. The rows may then stand in a shorter form."""
    seen = context.only(operand)
    tables = {_table(c) for c in (*seen.by, *seen.where)} - {operand.fact}
    rows = None
    if not operand.dates and (ids or reads is not None):
        own = [_name(c) for c in (*seen.by, *seen.where) if _table(c) == operand.fact]
        columns, values = reads or ((), ())
        used = list(dict.fromkeys([*(foreign_key(t) for t in sorted(tables)), *own, *columns]))
        asked = ("numbered", operand.fact, operand.distinct, used) if ids else ("summed", operand.fact, used, values)
        rows = _offered(context.star, *asked)
    if rows is None:
        rows = context.star[operand.fact]
    for column, wanted in seen.where.items():
        if _table(column) == operand.fact:
            rows = rows.where(_test(F.col(_name(column)), wanted))
    for column in seen.by:
        if _table(column) == operand.fact:
            rows = rows.withColumn(_label(column), F.col(_name(column)))
    if operand.dates:
        tables.discard(DATE)
    for table in sorted(tables):
        key = foreign_key(table)
        extra = [F.col(DIMENSION_KEYS[table]).alias("_member")]
        prunable = table == DATE and MONTH in rows.columns
        if prunable:
            extra.append((F.floor(F.col(DIMENSION_KEYS[table]) / 100)).cast("int").alias("_month"))
        members, filtered = _members(seen, table, extra)
        grouped = any(_table(c) == table for c in seen.by)
        how = "left_semi" if not grouped else "inner" if filtered else "left"
        same = rows[key] == members["_member"]
        if prunable and filtered:
            # true whenever the day matches; on the partition column it prunes months
            same = same & (rows[MONTH] == members["_month"])
        rows = rows.join(members, same, how).drop("_member", "_month")
    if operand.dates:
        rows = _in_periods(seen, operand, rows)
    return rows


# -- date contexts ---------------------------------------------------------------


def _in_reach(context: Context, rows: DataFrame) -> DataFrame:
    """The fact's rows that any date step can look at, when the report filters dates:
    from the start of the year a month before the first day shown, to the last one. The
    two days come from the calendar; as literals they prune the fact's months."""
    dated = tuple((c, id(wanted)) for c, wanted in context.where.items() if _table(c) == DATE)
    if not dated:
        return rows
    if dated not in context.spans:
        first = F.date_format(F.trunc(F.add_months(F.min("Date"), -1), "year"), "yyyyMMdd").cast("int")
        context.spans[dated] = periods(context).agg(first.alias("first"), date_key(F.max("Date")).alias("last")).first()
    span = context.spans[dated]
    if span["first"] is None:
        return rows.where(F.lit(False))
    inside = F.col("date_key").between(span["first"], span["last"])
    if MONTH in rows.columns:
        inside = inside & F.col(MONTH).between(span["first"] // 100, span["last"] // 100)
    return rows.where(inside)


def periods(context: Context) -> DataFrame:
    """The calendar days of each date group: the group's columns and ``Date``."""
    return _members(context, DATE, ["Date"])[0]


def _same_day(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joined by ``Date``, which meets as a number: Spark broadcasts dates in pages of many MB, however few they
    are, and numbers in an array of their size."""
    numbered = right.withColumn("_number", F.unix_date("Date")).drop("Date")
    return left.join(numbered, F.unix_date(left["Date"]) == numbered["_number"], how).drop("_number")


def _date_labels(context: Context) -> list[str]:
    return [_label(c) for c in context.by if _table(c) == DATE]


def shifted_periods(context: Context, operand: Operand) -> DataFrame:
    """The days an operand looks at for each date group. Bounded by the calendar,
    never by the facts."""
    labels = _date_labels(context)
    days = periods(context)
    running = None
    for step in operand.dates:
        if step in ("mtd", "ytd"):
            # only a closing day follows (running sums go their own way): the last day
            # stands for the period from its month's or year's start
            running = {"mtd": "month", "ytd": "year"}[step]
            days = days.groupBy(*labels).agg(F.max("Date").alias("Date"))
        elif step == "previous_month":
            days = _previous_month(days, labels)
        elif step == "closing" and context.closing == "calendar":
            days = days.groupBy(*labels).agg(F.max("Date").alias("Date"))
        elif step == "closing":
            filled = _in_reach(context, _filled(context, operand.fact))
            filled = filled.select(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("Date"))
            if running:
                days = _last_filled(context, days, filled, running, labels)
            else:
                days = _same_day(days, filled).groupBy(*labels).agg(F.max("Date").alias("Date"))
        elif step == "single":
            one = days.groupBy(*labels).agg(F.max("Date").alias("Date"), F.count(F.lit(1)).alias("_n"))
            days = one.where("_n = 1").drop("_n")
        else:
            raise ValueError(f"unknown date step {step}")
    return days


def filled_days(fact: str) -> str:
    """The table of the days on which a fact has rows."""
    return f"days_of_{fact}"


def _filled(context: Context, fact: str) -> DataFrame:
    """The days on which the fact has rows, NULL left out: as the star keeps them, or, if it
    keeps none, from the fact itself."""
    kept = filled_days(fact)
    rows = context.star[kept] if kept in set(context.star) else context.star[fact].select(*_day_columns(context.star[fact])).distinct()
    return rows.where("date_key is not null")


def _day_columns(rows: DataFrame) -> list[str]:
    return [c for c in ("date_key", MONTH) if c in rows.columns]


def _last_filled(context: Context, days: DataFrame, filled: DataFrame, unit: str, labels: list[str]) -> DataFrame:
    """For each group's day, the last day with rows since the start of its month or
    year. A window holds the days of one period of the calendar."""
    so_far = Window.partitionBy(F.trunc("Date", unit)).orderBy("Date").rangeBetween(Window.unboundedPreceding, 0)
    marked = _same_day(context.star[DATE].select("Date"), filled.withColumn("_filled", F.col("Date")), "left")
    closing = marked.select("Date", F.max("_filled").over(so_far).alias("_closing")).where("_closing is not null")
    return _same_day(days, closing).select(*labels, F.col("_closing").alias("Date"))


def _previous_month(days: DataFrame, labels: list[str]) -> DataFrame:
    """Each day one month back; a month wholly in the group gives its whole
    predecessor (April 30 days -> March 31 days)."""
    month = F.trunc("Date", "month").alias("_month")
    months = days.groupBy(*labels, month).agg(F.collect_set("Date").alias("_days"))  # at most 31 days
    whole = F.size("_days") == F.day(F.last_day("_month"))
    before = F.add_months("_month", -1)
    all_days = F.sequence(before, F.date_sub("_month", 1))
    same_days = F.array_distinct(F.transform("_days", lambda d: F.add_months(d, -1)))
    return months.select(*labels, F.explode(F.when(whole, all_days).otherwise(same_days)).alias("Date"))


def _in_periods(context: Context, operand: Operand, rows: DataFrame) -> DataFrame:
    days = shifted_periods(context, operand).withColumn("_day", date_key("Date")).drop("Date")
    days = days.withColumn("_month", F.floor(F.col("_day") / 100).cast("int"))
    same = rows["date_key"] == days["_day"]
    if MONTH in rows.columns:
        same = same & (rows[MONTH] == days["_month"])  # true whenever the day matches; it prunes months
    return _in_reach(context, rows).join(days, same).drop("_day", "_month")


def _daily(context: Context, operand: Operand) -> tuple[DataFrame, list[str]]:
    """The operand's sum per day and per group other than the date's, and the names of
    those groups. Shifted sums of one fact all start from this same aggregate, whose
    shuffle Spark runs once and reuses."""
    other = tuple(c for c in context.by if _table(c) != DATE)
    undated = replace(context, by=other, where={c: f for c, f in context.where.items() if _table(c) != DATE})
    groups = [_label(c) for c in other]
    reads = operand.reads()
    rows = fact_rows(undated, replace(operand, dates=()), reads and ([*reads[0], "date_key"], reads[1]))
    return _in_reach(context, rows).groupBy(*groups, "date_key").agg(_value(context, operand, "_total")), groups


def _value(context: Context, operand: Operand, name: str) -> Column:
    """The operand's aggregate, in the type that it has over the fact's own rows."""
    value = F.expr(operand.sql)
    if operand.sums:
        value = value.cast(context.star[operand.fact].agg(F.expr(operand.sql)).schema.fields[0].dataType)
    return value.alias(name)


def _shifted_sum(context: Context, operand: Operand, name: str) -> DataFrame:
    """The sum over the days of the shifted periods."""
    daily, groups = _daily(context, operand)
    labels = _date_labels(context)
    days = shifted_periods(context, operand).withColumn("date_key", date_key("Date")).drop("Date")
    return daily.join(days, "date_key").groupBy(*groups, *labels).agg(F.sum("_total").alias(name))


def _running(context: Context, operand: Operand, name: str) -> DataFrame:
    """Month- or year-to-date sums: daily totals, filled up to the period's end,
    summed along the days. A window holds the days of one month or year."""
    unit, months = {"mtd": ("month", 1), "ytd": ("year", 12)}[operand.dates[0]]
    daily, groups = _daily(context, operand)
    labels = _date_labels(context)
    daily = daily.where("date_key is not null").select(
        *groups, F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("Date"), "_total"
    ).withColumn("_start", F.trunc("Date", unit))
    filled = (
        daily.groupBy(*groups, "_start")
        .agg(F.min("Date").alias("_first"))
        .withColumn("_last", F.date_sub(F.add_months("_start", months), 1))
        .select(*groups, "_start", F.explode(F.sequence("_first", "_last")).alias("Date"))
    )
    # filler rows carry no amount: stacking them needs no null-safe join
    dense = filled.withColumn("_total", F.lit(None).cast(dict(daily.dtypes)["_total"])).unionByName(daily)
    along = Window.partitionBy(*groups, "_start").orderBy("Date").rangeBetween(Window.unboundedPreceding, 0)
    sums = dense.withColumn(name, F.sum("_total").over(along)).groupBy(*groups, "Date").agg(F.max(name).alias(name))
    wanted = periods(context).groupBy(*labels).agg(F.max("Date").alias("Date"))
    return _same_day(sums, wanted).drop("Date")


# -- evaluating operands ---------------------------------------------------------


def _is_shifted_sum(operand: Operand) -> bool:
    return bool(operand.dates) and operand.dates[-1] in ("mtd", "ytd", "previous_month")


def _frame_key(context: Context, operand: Operand):
    """Operands with equal keys are aggregated together, in one pass.

    Distinct counts of different columns stay apart: together they would multiply each
    row by the number of columns before the shuffle, while apart each pass reads its own
    column only. Counts of one column under several conditions share a pass.
    """
    seen = context.only(operand)
    used = {_table(c) for c in (*seen.by, *seen.where)}
    virtual = tuple(sorted((set(operand.through) - related(operand.fact)) & used))
    alone = operand.sql if operand.top or operand.both or _is_shifted_sum(operand) else None
    special = operand.dates, operand.top, operand.both, operand.given, operand.distinct, alone
    return operand.fact, virtual, seen.by, tuple(seen.where), special


def _one_frame(context: Context, operands: Mapping[str, Operand]) -> DataFrame:
    first_name, first = next(iter(operands.items()))
    seen = context.only(first)
    groups = [_label(c) for c in seen.by]
    if first.both:
        return _in_both(context, first, first_name)
    if _is_shifted_sum(first):
        shift = _shifted_sum if first.dates[-1] == "previous_month" else _running
        same_sum = [F.col(first_name).alias(name) for name in operands]
        return shift(seen, first, first_name).select(*groups, *same_sum)
    if first.top:
        n, member = first.top
        each = fact_rows(replace(context, by=(*seen.by, member)), first)
        each = each.groupBy(*groups, _label(member)).agg(F.expr(first.sql).alias("_total"))
        return top(each, "_total", n, groups).groupBy(*groups).agg(F.sum("_total").alias(first_name))
    if first.serial:
        return _serials(fact_rows(context, first, ids=True), groups, operands)
    reads = [o.reads() for o in operands.values()]
    rows = fact_rows(context, first, None if None in reads else tuple(sum(each, []) for each in zip(*reads)))
    return rows.groupBy(*groups).agg(*(_value(context, o, name) for name, o in operands.items()))


def _serials(rows: DataFrame, groups: Sequence[str], operands: Mapping[str, Operand]) -> DataFrame:
    """Exact distinct counts of ids that mostly are a name and a running number: the numbers of one
    name are bits, 64 to a row, so a map task that has the ids of a name side by side sends one row in
    place of one for each id. Other ids, NULL included, are names of their own. Rows that have their ids as
    bits already are taken as they stand."""
    column = next(iter(operands.values())).distinct
    number = f"substring_index({column}, '_', -1)"
    n = f"try_cast({number} as int)"
    has_number = F.expr(f"{n} >= 0 and cast({n} as string) = {number} and length({number}) < length({column})")
    named = rows if "_bit" in rows.columns else rows.withColumns({
        "_name": F.when(has_number, F.expr(f"left({column}, length({column}) - length({number}))")).otherwise(F.col(column)),
        "_word": F.when(has_number, F.expr(f"{n} div 64")),
        "_bit": F.when(has_number, F.expr(f"shiftleft(1L, {n} % 64)")).otherwise(F.lit(1).cast("long")),
    })
    bits = [F.expr(f"bit_or(_bit) filter (where {o.serial})").alias(name) for name, o in operands.items()]
    counts = [F.expr(f"nullif(sum(bit_count({name})), 0)").alias(name) for name in operands]
    return named.groupBy(*groups, "_name", "_word").agg(*bits).groupBy(*groups).agg(*counts)


def _finer(context: Context, operands: Mapping[str, Operand], name: str) -> str | None:
    """The operand of the report, if there is one, whose groups are parts of this one's groups:
    the same sum over the same rows, by more columns."""
    wanted = operands[name]
    if not wanted.adds or wanted.dates:
        return None
    seen, found = context.only(wanted), {}
    for other, operand in operands.items():
        parts = context.only(operand)
        if replace(operand, clear=wanted.clear) == wanted and set(parts.where) == set(seen.where) and set(parts.by) > set(seen.by):
            found[other] = len(parts.by)
    return max(found, key=found.get, default=None)


def _summed(parts: DataFrame, groups: Sequence[str], part_groups: Sequence[str], named: Mapping[str, str]) -> DataFrame:
    """Totals of ``parts`` (new name -> column) by fewer groups. Every value column is looked
    at, so that both readers of ``parts`` need the same columns and Spark runs its scan and
    shuffle once."""
    kinds = dict(parts.dtypes)
    seen = [F.count(c) for c in parts.columns if c not in part_groups]
    sums = [F.sum(column).cast(kinds[column]).alias(name) for name, column in named.items()]
    totals = parts.groupBy(*groups).agg(*sums, reduce(Column.__add__, seen).alias("_seen"))
    return totals.where("_seen >= 0").drop("_seen")


def _in_both(context: Context, operand: Operand, name: str) -> DataFrame:
    """How many keys occur in both facts, per group. Each side is first reduced to
    its distinct (group, key) pairs, so the join meets each pair once."""
    other, key = operand.both
    sides = []
    for fact in (operand.fact, other):
        one = replace(operand, fact=fact, both=None)
        labels = [_label(c) for c in context.only(one).by]
        sides.append((labels, fact_rows(context, one).select(*labels, F.col(key).alias("_key")).distinct()))
    (left_labels, left), (right_labels, right) = sides
    shared = [c for c in left_labels if c in right_labels] + ["_key"]
    match = reduce(lambda a, b: a & b, (F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in shared))
    groups = [F.col(f"l.{c}") for c in left_labels] + [F.col(f"r.{c}") for c in right_labels if c not in left_labels]
    return left.alias("l").join(right.alias("r"), match).groupBy(*groups).agg(F.count(F.lit(1)).alias(name))


def evaluate(context: Context, operands: Mapping[str, Operand]) -> DataFrame:
    """One row per group, one column per operand.

    Operands that see all group columns are stacked and grouped once. One that sees
    fewer is joined on those it sees; one that sees none is a single value.
    A sum whose parts the report has as well (a total with a filter lifted) is summed up from
    those parts and does not read its fact again.
    Where no operand sees all group columns, its groups stand beside every member of the others.
    When the groups come from one dimension, all its members in context are shown.
    """
    operands = {name: operand.settled() for name, operand in operands.items()}
    finer = {name: part for name in operands if (part := _finer(context, operands, name))}
    labels = [_label(c) for c in context.by]
    full, partial, made = [], [], {}

    def take(names: list[str]) -> None:
        frames: dict = {}
        for name in names:
            frames.setdefault(_frame_key(context, operands[name]), {})[name] = operands[name]
        for members in frames.values():
            seen = [_label(c) for c in _seen_by(context, next(iter(members.values())))]
            frame = _one_frame(context, members)
            made.update({name: (frame, seen) for name in members})
            (full if set(seen) == set(labels) else partial).append((seen, frame, list(members)))

    take([name for name in operands if name not in finer])
    # sums of doubles would differ in the last digits
    exact = {n: p for n, p in finer.items() if dict(made[p][0].dtypes)[p].startswith(("decimal", "bigint"))}
    take([name for name in finer if name not in exact])
    lifted: dict = {}
    for name, part in exact.items():
        lifted.setdefault((id(made[part][0]), context.only(operands[name]).by), {})[name] = part
    for (_, by), named in lifted.items():
        parts, part_groups = made[next(iter(named.values()))]
        groups = [_label(c) for c in by]
        partial.append((groups, _summed(parts, groups, part_groups, named), list(named)))

    if not labels:
        return side_by_side([frame for _, frame, _ in full], []).select(*operands)

    tables = {_table(c) for c in context.by}
    stacked = [frame for _, frame, _ in full]
    if len(tables) == 1:
        members, _ = _members(context, tables.pop())
        stacked.append(members.distinct())
    if not stacked:
        stacked = [_spread(context, seen, frame, names) for seen, frame, names in partial]
    grid = side_by_side(stacked, labels)
    for seen, frame, names in partial:
        if seen:
            same = reduce(lambda a, b: a & b, (F.col(f"g.{c}").eqNullSafe(F.col(f"f.{c}")) for c in seen))
            kept = [F.col(f"g.{c}") for c in grid.columns] + [F.col(f"f.{n}") for n in names]
            grid = grid.alias("g").join(frame.alias("f"), same, "left").select(*kept)
        else:
            grid = _with_values(grid, frame, names)
    return grid.select(*labels, *operands)


def _spread(context: Context, seen: Sequence[str], frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """The groups of ``frame`` that have a value, each with every member, in context, of the group
    columns that its operands do not see: there the value repeats. The result is the
    report's own rows, so it grows with groups and members and never with a fact."""
    some = reduce(Column.__or__, (F.col(n).isNotNull() for n in names))
    rows = frame.where(some).select(*seen, F.lit(None).cast("int").alias("_apart"))
    hidden = [c for c in context.by if _label(c) not in seen]
    for table in sorted({_table(c) for c in hidden}):
        shown = replace(context, by=tuple(c for c in hidden if _table(c) == table))
        rows = rows.crossJoin(_members(shown, table)[0].distinct())
    return rows.select(*(_label(c) for c in context.by))


def _seen_by(context: Context, operand: Operand) -> list[str]:
    seen = list(context.only(operand).by)
    if operand.both:
        other = replace(operand, fact=operand.both[0], both=None)
        seen += [c for c in context.only(other).by if c not in seen]
    return seen


def _with_values(grid: DataFrame, single: DataFrame, names: list[str]) -> DataFrame:
    """Attach a one-row frame's values to every row, as a scalar subquery."""
    value = single.select(F.struct(*names).alias("v")).scalar()
    return grid.withColumn("_v", value).select(*grid.columns, *(F.col(f"_v.{n}").alias(n) for n in names))
