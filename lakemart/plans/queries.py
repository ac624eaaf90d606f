"""Registered queries: each operator and measure pack over the test tables.

Results are shown in plain types (decimals and ratios as doubles, ratios to six
places, days as ISO text), so another engine's result compares value by value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import day, moment, money, whole
from ..functions.text import first_word
from ..operators import marts, quality
from ..operators.calendar import date_bounds, observed_dates
from ..operators.cleaning import clean, rename, require_keys
from ..operators.history import MICROS, SECONDS, current, history
from ..operators.latest import latest
from ..operators.ranking import rank_by_value, top
from ..operators.schedule import payment_schedule
from ..session import shared_folder
from ..sources import fixtures
from ..sources.histories import HistoryTable
from ..sources.ingest import SCHEMA_NAME, convert, copy_changes, copy_folder
from ..sources.layers import Layer
from ..sources.registers import KeyRegister
from ..sources.schemas import conform, gold_schema
from . import gold, silver
from .loads import BALANCES, built_on, load_balances, monthly, record_checks, summary
from .medallion import AS_OF, FOREIGN_KEYS, LOAD_TS, check, lake, to_warehouse
from .model import BRANCH, CUSTOMER, DATE, MONTH, L, P, T
from .report import pack, report

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIRTY_AMOUNTS = """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 13 = 0 THEN 'abc' WHEN o_orderkey % 17 = 0 THEN ''
                ELSE ' ' || cast(cast(floor(o_totalprice / 1000) AS bigint) AS string) || ','
                     || lpad(cast(cast(floor(o_totalprice) AS bigint) % 1000 AS string), 3, '0') || '.'
                     || lpad(cast(cast(round(o_totalprice * 100) AS bigint) % 100 AS string), 2, '0') END AS amount,
           CASE WHEN o_orderkey % 10 = 0 THEN '2024-02-30' ELSE cast(cast(o_orderdate AS date) AS string) END AS day,
           CASE WHEN o_orderkey % 9 = 0 THEN 'soon' ELSE cast(cast(o_orderdate AS date) AS string) || ' 10:20:30' END AS seen_at,
           CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE cast(o_orderkey % 50 AS string) END AS pieces
    FROM {orders}
"""


BLANK_KEYS = """
    SELECT CASE WHEN event_id % 7 = 0 THEN '  ' WHEN event_id % 11 <> 0 THEN cast(user_id AS string) END AS cust, event_type, event_id
    FROM {events}
"""


def plain(df: DataFrame) -> DataFrame:
    def shown(name: str, kind: str):
        c = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            return c.cast("double").alias(name)
        if kind == "double":
            return F.round(c, 6).alias(name)
        if kind == "date":
            return c.cast("string").alias(name)
        if kind == "timestamp":
            return c.cast("timestamp_ntz").alias(name)
        return c

    return df.select(*(shown(name, kind) for name, kind in df.dtypes))


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf_dir: plain(build(spark, sf_dir))
    return build


def _raw(spark, sf_dir, name):
    return fixtures.view(spark, sf_dir, name)


# -- cleaning, history, integrity --------------------------------------------------


@query
def q_clean_customers(spark, sf_dir):
    return silver.clean_customers(_raw(spark, sf_dir, "customers"), _raw(spark, sf_dir, "customers_delta"), LOAD_TS)


@query
def q_rename_known_keys(spark, sf_dir):
    """Renamed where present; blank keys count as missing."""
    changes = spark.sql(BLANK_KEYS, events=fixtures.source_table(spark, sf_dir, "events"))
    renamed = rename(changes, {"cust": "customer_id", "not_there": "x", "event_type": "event_id"})
    return require_keys(renamed, ["customer_id"], blank_is_missing=True)


@query
def q_clean_amounts(spark, sf_dir):
    dirty = spark.sql(DIRTY_AMOUNTS, orders=fixtures.source_table(spark, sf_dir, "orders"))
    return clean(dirty, {"amount": money, "day": day, "seen_at": moment, "pieces": whole})


@query
def q_convert_types(spark, sf_dir):
    lines = fixtures.source_table(spark, sf_dir, "lineitem")
    wanted = {"l_quantity": "int", "l_extendedprice": "decimal(18,2)", "l_tax": "decimal(10,4)", "l_returnflag": "int"}
    return convert(lines, wanted).select("l_orderkey", "l_linenumber", "l_partkey", *wanted)


@query
def q_dedupe_latest(spark, sf_dir):
    return silver.newest_loans(_raw(spark, sf_dir, "loans"), LOAD_TS)


def _changes(spark, sf_dir, validity, **rest):
    changes = _raw(spark, sf_dir, "customer_changes")
    return history(changes, "customer_id", "changed_at", ["event_type"], validity, ties=["event_id"], **rest)


@query
def q_scd2_seconds(spark, sf_dir):
    return _changes(spark, sf_dir, SECONDS)


@query
def q_scd2_micros(spark, sf_dir):
    # a low limit, so that the keys above it take the sliced way
    return _changes(spark, sf_dir, MICROS, hot_rows=60)


@query
def q_scd2_customers(spark, sf_dir):
    base, delta = _raw(spark, sf_dir, "customers"), _raw(spark, sf_dir, "customers_delta")
    return silver.customers(base, delta, LOAD_TS)


@query
def q_current_rows(spark, sf_dir):
    return current(_changes(spark, sf_dir, SECONDS)).drop("effective_end_date")


@query
def q_ri_semi(spark, sf_dir):
    typed = lake(spark, sf_dir).silver
    parents = [typed.table(t) for t in ("accounts", "customers", "branches", "channels", "txn_types")]
    return silver.transactions(_raw(spark, sf_dir, "transactions"), *parents, LOAD_TS)


def _cards(spark, sf_dir):
    typed = lake(spark, sf_dir).silver
    return silver.cards(_raw(spark, sf_dir, "cards"), typed.table("customers"), typed.table("accounts"), LOAD_TS)


@query
def q_ri_valid(spark, sf_dir):
    return _cards(spark, sf_dir)[0]


@query
def q_ri_reject(spark, sf_dir):
    return _cards(spark, sf_dir)[1]


@query
def q_null_key_split(spark, sf_dir):
    good, bad = silver.branches(_raw(spark, sf_dir, "branches"), LOAD_TS)
    return good.withColumn("verdict", F.lit("valid")).unionByName(bad.withColumn("verdict", F.lit("reject")))


@query
def q_ri_balances(spark, sf_dir):
    typed = lake(spark, sf_dir).silver
    parents = [typed.table(t) for t in ("accounts", "customers", "branches")]
    return silver.balances(_raw(spark, sf_dir, "balances_daily"), *parents, LOAD_TS)


def _merged_customers(spark, sf_dir, name: str, feeds: list[str]) -> DataFrame:
    """A stored history of customers that takes in its sources one by one."""
    table = HistoryTable(
        _scratch(spark, sf_dir, name), "customers", "customer_id", "_at", silver.CUSTOMER_TRACKED, SECONDS, (*silver.CUSTOMER_TRACKED, "record_source")
    )
    table.layer.drop("customers")
    rows = silver.timed_customers(_raw(spark, sf_dir, "customers"), _raw(spark, sf_dir, "customers_delta"), LOAD_TS)
    for source in feeds:
        table.merge(rows.where(F.upper("record_source") == source))
    return table.rows().drop("_at")


@query
def q_scd2_merge(spark, sf_dir):
    """The changes merged into the stored base: equal to one build over both."""
    return _merged_customers(spark, sf_dir, "history", ["CORE", "DELTA"])


@query
def q_scd2_merge_late(spark, sf_dir):
    """So is the base merged into the stored changes, whose rows come late."""
    return _merged_customers(spark, sf_dir, "history_late", ["DELTA", "CORE"])


@query
def q_scd2_accounts(spark, sf_dir):
    typed = lake(spark, sf_dir).silver
    base, delta = _raw(spark, sf_dir, "accounts"), _raw(spark, sf_dir, "accounts_delta")
    return silver.accounts(base, delta, typed.table("customers"), typed.table("branches"), LOAD_TS)


@query
def q_scd2_loans(spark, sf_dir):
    typed = lake(spark, sf_dir).silver
    return silver.loans(_raw(spark, sf_dir, "loans"), typed.table("customers"), typed.table("branches"), LOAD_TS)


@query
def q_domains(spark, sf_dir):
    raw = _raw(spark, sf_dir, "transactions")
    each = [
        silver.domain(raw, column, "name").select(F.lit(column).alias("domain"), "name")
        for column in ("channel", "txn_type")
    ]
    return reduce(DataFrame.unionByName, each)


# -- calendar, keys, dimensions, facts ----------------------------------------------


@query
def q_dates_union(spark, sf_dir):
    typed = lake(spark, sf_dir).silver
    return observed_dates(
        typed.table("transactions").select(F.to_date("transaction_ts")),
        typed.table("balances_daily").select("snapshot_date"),
        current(typed.table("loans")).select("start_date"),
        typed.table("loan_payments").select("payment_date"),
    )


@query
def q_date_bounds(spark, sf_dir):
    found = lake(spark, sf_dir).silver.present([*gold.DATED_TABLES, "not_there"])
    return date_bounds(found).orderBy("table_name", "column_name")


@query
def q_dim_date(spark, sf_dir):
    return conform(gold.dim_date(lake(spark, sf_dir).silver.present(gold.DATED_TABLES)), gold_schema("dim_date"))


@query
def q_surrogate_keys(spark, sf_dir):
    return gold.dimension("dim_customer", lake(spark, sf_dir).silver.table("customers")).select("customer_id", "customer_key")


@query
def q_keys_grow(spark, sf_dir):
    """Customers whose version comes from the base table are numbered first; the others follow, and no
    key changes."""
    register = KeyRegister(_scratch(spark, sf_dir, "keys"), "customers", "customer_id", "customer_key")
    register.layer.drop("customers")
    members = current(lake(spark, sf_dir).silver.table("customers"))
    register.grow(members.where("upper(record_source) = 'CORE'"))
    register.grow(members)
    return register.attach(members.select("customer_id")).select("customer_id", "customer_key")


def _dimension_query(name: str) -> Query:
    def build(spark, sf_dir):
        table = lake(spark, sf_dir).silver.table(gold.DIMENSION_SOURCES[name][0])
        return conform(gold.dimension(name, table), gold_schema(name), fill=True)

    build.__name__ = f"q_{name}"
    return build


for _name in gold.DIMENSION_SOURCES:
    query(_dimension_query(_name))


def _fact_query(name: str, source: str) -> Query:
    def build(spark, sf_dir):
        stored = lake(spark, sf_dir)
        return conform(getattr(gold, name)(stored.silver.kept(source), stored.star()), gold_schema(name))

    build.__name__ = f"q_{name}"
    return build


for _name, _source in (
    ("fact_transactions", "transactions"), ("fact_daily_balances", "balances_daily"),
    ("fact_loans", "loans"), ("fact_loan_payments", "loan_payments"),
):
    query(_fact_query(_name, _source))


@query
def q_payment_schedule(spark, sf_dir):
    return payment_schedule(current(lake(spark, sf_dir).silver.table("loans")), AS_OF, LOAD_TS)


@query
def q_payment_profile(spark, sf_dir):
    return quality.date_profile(lake(spark, sf_dir).silver.table("loan_payments"), "payment_date")


@query
def q_payment_distribution(spark, sf_dir):
    return quality.date_distribution(lake(spark, sf_dir).silver.table("loan_payments"), "payment_date", "payment_amount", first=100)


@query
def q_branch_daily(spark, sf_dir):
    daily = marts.branch_daily(lake(spark, sf_dir).gold.table("fact_daily_balances"))
    return conform(daily, gold_schema("fact_branch_daily_summary"))


@query
def q_customer_daily(spark, sf_dir):
    daily = marts.customer_daily(lake(spark, sf_dir).gold.table("fact_loans"))
    return conform(daily, gold_schema("fact_customer_daily_portfolio"))


@query
def q_branch_daily_wide(spark, sf_dir):
    star = lake(spark, sf_dir).gold
    return marts.branch_daily_wide(*(star.table(f) for f in (T, "fact_daily_balances", L)), star.lookup(P, ("date_key", "branch_key")))


@query
def q_customer_daily_wide(spark, sf_dir):
    star = lake(spark, sf_dir).gold
    return marts.customer_daily_wide(
        *(star.table(f) for f in (T, "fact_daily_balances", L, "dim_card", "dim_customer"))
    )


# -- quality, storage -----------------------------------------------------------------


@query
def q_key_coverage(spark, sf_dir):
    star = lake(spark, sf_dir).gold
    each = (quality.key_coverage(f, star.table(f), keys) for f, keys in FOREIGN_KEYS.items())
    return reduce(DataFrame.unionByName, each)


@query
def q_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(_raw(spark, sf_dir, "loans"), "loan_id")


@query
def q_row_counts(spark, sf_dir):
    star = lake(spark, sf_dir).gold
    return quality.row_counts({t: star.table(t) for t in ("dim_customer", "dim_account", "dim_loan", *FOREIGN_KEYS)})


@query
def q_dq_results(spark, sf_dir):
    stored = lake(spark, sf_dir)
    return check(stored.silver, stored.gold.table)


@query
def q_preview(spark, sf_dir):
    return lake(spark, sf_dir).gold.table("dim_date").orderBy("Date").limit(10)


def _scratch(spark, sf_dir, name: str) -> Layer:
    tag = lake(spark, sf_dir).raw.database.removesuffix("_raw")
    return Layer(spark, f"{tag}_{name}", f"{shared_folder(spark)}/{tag}/{name}")


@query
def q_recreate(spark, sf_dir):
    """Dropped and written again: nothing of the earlier table stays."""
    area = _scratch(spark, sf_dir, "recreate")
    area.recreate(_raw(spark, sf_dir, "branches"), "changes")
    area.recreate(_raw(spark, sf_dir, "customer_changes"), "changes")
    return area.table("changes")


@query
def q_balances_append(spark, sf_dir):
    """Two loads that share days: the second load's days replace the first's, others stay."""
    area = _scratch(spark, sf_dir, "append")
    area.drop("balances_daily")
    balances, date = _raw(spark, sf_dir, "balances_daily"), F.dayofmonth("snapshot_date")
    area.replace_days(balances.where(date <= 20).withColumn("end_of_day_balance", F.lit(0.0)), "balances_daily", "snapshot_date")
    return area.replace_days(balances.where(date >= 10), "balances_daily", "snapshot_date")


_loaded: dict[tuple[str, str], Layer] = {}


def _after_two_loads(spark, sf_dir) -> Layer:
    """A star's facts and summaries of balances after two daily loads: days 1 to 20, the last of
    them still wrong, then days 15 to 30, after which only these days' months are summed up anew."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        stored = lake(spark, sf_dir)
        areas = [_scratch(spark, sf_dir, f"load_{layer}") for layer in ("raw", "silver", "gold")]
        summaries = built_on("fact_daily_balances")
        for area, tables in zip(areas, ([BALANCES], [BALANCES], ["fact_daily_balances", *summaries]), strict=True):
            for table in tables:
                area.drop(table)
        star = areas[2]

        def tables(name: str, by: Sequence[str] = ()) -> DataFrame:
            return star.table(name) if star.exists(name) else stored.gold.lookup(name, by)

        balances, date = _raw(spark, sf_dir, "balances_daily"), F.dayofmonth("snapshot_date")
        wrong = F.when(date >= 15, -F.col("end_of_day_balance")).otherwise(F.col("end_of_day_balance"))
        first = balances.where(date <= 20).withColumn("end_of_day_balance", wrong)
        load_balances(*areas, first, stored.silver.table, tables, LOAD_TS)
        for name in summaries:
            star.overwrite(monthly(summary(name, tables)), name, [MONTH])
        load_balances(*areas, balances.where(date >= 15), stored.silver.table, tables, LOAD_TS, summaries=summaries)
        _loaded[key] = star
    return _loaded[key]


@query
def q_daily_load(spark, sf_dir):
    """The fact after two loads equals one load of all."""
    return _after_two_loads(spark, sf_dir).table("fact_daily_balances").drop(MONTH)


@query
def q_load_branch_daily(spark, sf_dir):
    """So do the summaries built on it, of which the second load wrote its months only."""
    return conform(_after_two_loads(spark, sf_dir).table("fact_branch_daily_summary"), gold_schema("fact_branch_daily_summary"))


@query
def q_load_branch_daily_wide(spark, sf_dir):
    return _after_two_loads(spark, sf_dir).table("fact_branch_daily_wide").drop(MONTH)


@query
def q_load_customer_daily_wide(spark, sf_dir):
    return _after_two_loads(spark, sf_dir).table("fact_customer_daily_wide").drop(MONTH)


@query
def q_dq_history(spark, sf_dir):
    """Two runs of the checks: the results of both stay."""
    stored, area = lake(spark, sf_dir), _scratch(spark, sf_dir, "checks")
    area.drop("dq_results")
    for batch in ("batch-1", "batch-2"):
        record_checks(area, check(stored.silver, stored.gold.table, batch))
    return area.table("dq_results")


@query
def q_balances_evolve(spark, sf_dir):
    """Appended rows bring a new column: old rows have it as NULL."""
    area = _scratch(spark, sf_dir, "evolve")
    area.drop("balances")
    balances = _raw(spark, sf_dir, "balances_daily")
    area.append(balances.drop("currency"), "balances")
    return area.append(balances, "balances")


@query
def q_ingest_all(spark, sf_dir):
    copied = copy_folder(spark, sf_dir, _scratch(spark, sf_dir, "copies"))
    by_table = {name.split(".", 1)[1]: df for name, df in copied.items()}
    return quality.row_counts(by_table).orderBy("table_name")


@query
def q_warehouse(spark, sf_dir):
    served = to_warehouse(lake(spark, sf_dir).gold, _scratch(spark, sf_dir, "warehouse"))
    return quality.row_counts(served)


def _copies(spark, sf_dir) -> Layer:
    return _scratch(spark, sf_dir, "changes")


@query
def q_copy_changes(spark, sf_dir):
    """Two copies of the same files: the second reads and writes none."""
    area = _copies(spark, sf_dir)
    for table in area.tables():
        area.drop(table)
    runs = [copy_changes(spark, sf_dir, area).withColumn("run", F.lit(run)) for run in (1, 2)]
    return runs[0].unionByName(runs[1]).select("run", "table_name", "action", "files")


def _copied_query(table: str) -> Query:
    def build(spark, sf_dir):
        area = _copies(spark, sf_dir)
        copy_changes(spark, sf_dir, area)
        rows = area.table(f"{SCHEMA_NAME}.{table}")
        if table == "embeddings":  # one row per number, so that any engine can compare them
            rows = rows.select("vec_id", "label", F.posexplode("embedding").alias("place", "x")).withColumn("x", F.col("x").cast("double"))
        return rows

    build.__name__ = f"q_copied_{table}"
    return build


for _name in (*fixtures.TABLES, "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
    query(_copied_query(_name))


_served: dict[tuple[str, str], dict[str, DataFrame]] = {}


def _served_query(name: str) -> Query:
    def build(spark, sf_dir):
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _served:
            _served[key] = to_warehouse(lake(spark, sf_dir).gold, _scratch(spark, sf_dir, "served"))
        return _served[key][name]

    build.__name__ = f"q_served_{name}"
    return build


for _name in [*gold.DIMENSION_SOURCES, "dim_date", *FOREIGN_KEYS]:
    query(_served_query(_name))


@query
def q_first_word(spark, sf_dir):
    return fixtures.source_table(spark, sf_dir, "part").select("p_partkey", "p_name", first_word(F.col("p_name")).alias("word"))


# -- ranking ----------------------------------------------------------------------------


def _spending(spark, sf_dir):
    orders = fixtures.source_table(spark, sf_dir, "orders").join(
        fixtures.source_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    spent = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spent")
    return orders.groupBy("c_mktsegment", "o_custkey").agg(spent)


@query
def q_rank_running(spark, sf_dir):
    return rank_by_value(_spending(spark, sf_dir), "spent")


@query
def q_rank_running_within(spark, sf_dir):
    return rank_by_value(_spending(spark, sf_dir), "spent", ["c_mktsegment"])


@query
def q_rank_running_double(spark, sf_dir):
    """Doubles that differ in the third place; eighths, so that any order of adding is exact."""
    eighths = (F.round(F.col("spent") * 100) / 8).cast("double")
    return rank_by_value(_spending(spark, sf_dir).select("o_custkey", eighths.alias("spent")), "spent")


@query
def q_top_with_ties(spark, sf_dir):
    return top(_spending(spark, sf_dir), "spent", 10, ["c_mktsegment"])


@query
def q_latest_order(spark, sf_dir):
    orders = fixtures.source_table(spark, sf_dir, "orders")
    return latest(orders, "o_custkey", ["o_orderdate"], ["o_orderkey"])


# -- measure packs ------------------------------------------------------------------------

BY_BRANCH = ("dim_branch.branch_name",)
BY_YEAR = ("dim_date.Year",)
BY_MONTH = ("dim_date.Year_Month",)
BY_DAY = ("dim_date.Date",)

PACKS: dict[str, tuple[str, tuple[str, ...], dict]] = {
    "m_txn": ("txn", BY_BRANCH, {}),
    "m_txn_total": ("txn", (), {}),
    "m_txn_by_direction": ("txn", (f"{T}.direction",), {}),
    "m_txn_by_channel": ("txn", ("dim_channel.channel_name",), {}),
    "m_loan": ("loan", BY_YEAR, {}),
    "m_pay": ("pay", ("dim_branch.region",), {}),
    "m_overlap": ("overlap", BY_BRANCH, {}),
    "m_branch": ("branch", BY_BRANCH, {}),
    "m_exec": ("exec", BY_YEAR, {}),
    "m_exec_day": ("exec", BY_DAY, {}),
    "m_segment": ("segment", ("dim_customer.segment",), {}),
    "m_share": ("share", ("dim_branch.region", "dim_branch.branch_name"), {}),
    "m_deposit": ("deposit", BY_MONTH, {}),
    "m_deposit_calendar": ("deposit", BY_MONTH, {"closing": "calendar"}),
    "m_portfolio": ("portfolio", BY_MONTH, {}),
    "m_portfolio_calendar": ("portfolio", BY_MONTH, {"closing": "calendar"}),
    "m_time_month": ("time", BY_MONTH, {}),
    "m_time_day": ("time", BY_DAY, {}),
    # one year: only the months within its reach are read
    "m_time_filtered": ("time", BY_MONTH, {"where": {"dim_date.Year": [1998]}}),
    "m_deposit_filtered": ("deposit", BY_MONTH, {"where": {"dim_date.Year": [2024]}}),
    "m_pareto": ("pareto", ("dim_customer.full_name",), {}),
    # groups that are no names take their place among the names of the branch
    "m_pareto_branch": ("pareto", BY_BRANCH, {"where": {"dim_customer.full_name": lambda c: c.endswith("7")}}),
    # filters: the segment reaches transactions, and loans only virtually
    "m_txn_filtered": (
        "txn", ("dim_branch.region",),
        {"where": {"dim_customer.segment": ["BUILDING", "PREMIUM"], "dim_date.Year": lambda c: c.between(1996, 1998)}},
    ),
    "m_segment_filtered": (
        "segment", ("dim_customer.risk_rating",),
        {"where": {"dim_customer.segment": ["BUILDING"], "dim_date.Year": lambda c: c >= 1998}},
    ),
}


def _pack_query(name: str) -> Query:
    which, by, rest = PACKS[name]

    def build(spark, sf_dir):
        return pack(lake(spark, sf_dir).star(), which, by, **rest)

    build.__name__ = name
    return build


for _name in PACKS:
    query(_pack_query(_name))


@query
def m_bucket(spark, sf_dir):
    names = ["Customers per Bucket", "Distinct Borrowers by Bucket", "Exposure %"]
    return report(lake(spark, sf_dir).star(), names, ["Loan Bucket"])


@query
def m_apart(spark, sf_dir):
    """No measure sees both columns: loans and payments repeat for each channel."""
    names = ["Total Loans", "Total Principal Disbursed", "Total Payment Amount"]
    return report(lake(spark, sf_dir).star(), names, ("dim_branch.region", "dim_channel.channel_name"))


@query
def m_txn_region_month(spark, sf_dir):
    names = ["Total Transactions", "Total Transaction Amount", "Transaction Amount MTD", "Transaction Amount YTD",
             "Previous Month Transaction Amount", "MoM Transaction Growth %"]
    return report(lake(spark, sf_dir).star(), names, ("dim_branch.region", "dim_date.Year_Month"))
