"""The layer runner: raw -> silver -> gold. Each table is stored once and read back by
whatever builds on it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from hashlib import sha1
from threading import Lock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.history import current
from ..operators.schedule import instalments, is_plan, payment_plans
from ..session import shared_folder
from ..sources import fixtures
from ..sources.ingest import SCHEMA_NAME
from ..sources.layers import Layer, run_together
from ..sources.registers import KeyRegister
from ..sources.schemas import conform, gold_schema
from . import gold, loads, silver
from .model import MONTH

# The test lake's load time, "today" and batch: its runs are repeatable.
LOAD_TS = "2024-02-01 00:00:00"
AS_OF = "2000-01-01"
BATCH = "batch-1"

FOREIGN_KEYS = {
    "fact_transactions": ("date_key", "customer_key", "account_key", "branch_key", "channel_key", "txn_type_key"),
    "fact_daily_balances": ("date_key", "customer_key", "account_key", "branch_key"),
    "fact_loans": ("date_key", "customer_key", "branch_key", "loan_key"),
    "fact_loan_payments": ("date_key", "customer_key", "branch_key", "loan_key"),
}


@dataclass(frozen=True)
class Shorter:
    """What a table of plans gives in place of its rows, where it can."""

    values: tuple[str, ...]  # the columns that it sums up
    summed: Callable[[DataFrame, Sequence[str]], DataFrame | None]
    id: str  # the column whose values are a name and a running number
    numbered: Callable[[DataFrame, Sequence[str]], DataFrame | None]


class BuiltLayer(Layer):
    """A layer whose tables are built and stored when first asked for. Tables that are
    stored already, by this session or an earlier one, are read; ``refresh`` makes them
    be built anew.

    ``unfolded`` lists tables whose recipe gives payment plans: they are stored as plans, and the
    given function makes the table's rows of them whenever it is read. Rows that are
    added later, or taken out, make it a table of whole rows first. ``shorter`` gives, for such
    tables, the functions that sum plans up by columns, and that give their ids as bits."""

    def __init__(
        self, spark: SparkSession, database: str, folder: str, recipes: Mapping[str, Callable[[], DataFrame]],
        unfolded: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
        shorter: Mapping[str, Shorter] | None = None,
    ):
        super().__init__(spark, database, folder)
        self._recipes = recipes
        self._unfolded = unfolded or {}
        self._shorter = shorter or {}
        self._rows: dict[str, tuple[DataFrame, DataFrame]] = {}
        self._locks = {name: Lock() for name in recipes}
        self._ready: set[str] = set()
        self._stale: set[str] = set()

    def refresh(self, *tables: str) -> None:
        """The named tables, or all, are built again when next asked for."""
        chosen = set(tables or self._recipes)
        self._ready -= chosen
        self._stale |= chosen

    def table(self, table: str) -> DataFrame:
        kept = self.kept(table)
        if table not in self._unfolded or not is_plan(kept):
            return kept
        known = self._rows.get(table)
        if known is None or known[0] is not kept:
            known = self._rows[table] = kept, self._unfolded[table](kept)
        return known[1]

    def kept(self, table: str) -> DataFrame:
        """The table in the form in which it is stored."""
        if table in self._recipes and table not in self._ready:
            with self._locks[table]:
                if table not in self._ready:
                    if table in self._stale or not Layer.exists(self, table):
                        self._store(table, self._recipes[table]())
                    self._ready.add(table)
                    self._stale.discard(table)
        return super().table(table)

    def summed(self, table: str, columns: Sequence[str], values: Sequence[str]) -> DataFrame | None:
        if table not in self._shorter or not set(values) <= set(self._shorter[table].values) or not is_plan(kept := self.kept(table)):
            return None
        return self._shorter[table].summed(kept, columns)

    def numbered(self, table: str, column: str, columns: Sequence[str]) -> DataFrame | None:
        if table not in self._shorter or column != self._shorter[table].id or not is_plan(kept := self.kept(table)):
            return None
        return self._shorter[table].numbered(kept, columns)

    def lookup(self, table: str, by: Sequence[str] = ()) -> DataFrame:
        """The table; where ``by`` is given, it may stand summed up by these columns."""
        summed = self.summed(table, by, ()) if by else None
        return self.table(table) if summed is None else summed

    def query(self, table: str, columns: str = "*") -> DataFrame:
        self.table(table)
        return super().query(table, columns)

    def append(self, df: DataFrame, table: str) -> DataFrame:
        self._make_whole(table)
        return super().append(df, table)

    def drop_days(self, table: str, day: str, days: Iterable) -> None:
        self._make_whole(table)
        super().drop_days(table, day, days)

    def _exchange(self, df: DataFrame, table: str, day: str, gone: Iterable, replaced: bool) -> DataFrame:
        self._make_whole(table)
        return super()._exchange(df, table, day, gone, replaced)

    def _make_whole(self, table: str) -> None:
        if table in self._unfolded and Layer.exists(self, table) and is_plan(Layer.table(self, table)):
            self._store(table, self._unfolded[table](Layer.table(self, table)))

    def exists(self, table: str) -> bool:
        return table in self._recipes or super().exists(table)

    def tables(self) -> list[str]:
        return sorted(self._recipes)

    def _store(self, table: str, df: DataFrame) -> None:
        if table in self._unfolded and is_plan(df):
            self.overwrite(df, table)
        elif table.removeprefix(f"{SCHEMA_NAME}.") == loads.BALANCES:
            by_day = df.hint("rebalance", "snapshot_date")
            self.overwrite(by_day, table, ["snapshot_date"])
        elif table in FOREIGN_KEYS or table in loads.SUMMARIES:
            # Facts and summaries are stored by month, so date filters skip whole partitions.
            # Rebalancing gives each month few files and cuts one too big for a task.
            dated = df if MONTH in df.columns else loads.monthly(df)
            self.overwrite(dated.hint("rebalance", MONTH), table, [MONTH])
        else:
            self.overwrite(df, table)


@dataclass(frozen=True)
class Lake:
    raw: BuiltLayer
    silver: BuiltLayer
    gold: BuiltLayer

    def star(self) -> Mapping[str, DataFrame]:
        return self.gold.all()

    def load_balances(self, new: DataFrame, load_ts: str | None = None) -> list[str]:
        """A daily load of balances, up to the summaries built on them; see
        ``loads.load_balances``. Returns the tables of the star that were written."""
        raw_table = f"{SCHEMA_NAME}.{loads.BALANCES}"
        for layer, table in ((self.raw, raw_table), (self.silver, loads.BALANCES), (self.gold, "fact_daily_balances")):
            layer.table(table)  # what there was before
        kept = [t for t in loads.built_on("fact_daily_balances") if Layer.exists(self.gold, t)]
        return loads.load_balances(
            self.raw, self.silver, self.gold, new, self.silver.table, self.gold.lookup, load_ts, raw_table=raw_table, summaries=kept
        )

    def record_checks(self, batch: str | None = None, executed: str | None = None) -> DataFrame:
        """Runs every check again and adds its results to the stored ones."""
        self.gold.table("dq_results")
        now = executed or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        return loads.record_checks(self.gold, check(self.silver, self.gold.table, batch or uuid4().hex, now))

    def build(self, at_once: int = 8) -> Lake:
        """Store every table. Tables that do not wait for each other are written at
        the same time."""
        every = [(layer, name) for layer in (self.raw, self.silver, self.gold) for name in layer.tables()]
        run_together({f"{layer.database}.{name}": lambda la=layer, n=name: la.table(n) for layer, name in every}, at_once)
        return self


def silver_recipes(raw: Layer, typed: Callable[[str], DataFrame], load_ts: str | None, as_of: str | None) -> dict[str, Callable[[], DataFrame]]:
    def source(name: str) -> DataFrame:
        return raw.query(f"{SCHEMA_NAME}.{name}")

    def accounts() -> DataFrame:
        return silver.accounts(source("accounts"), source("accounts_delta"), typed("customers"), typed("branches"), load_ts)

    def checked(name: str, accepted: bool) -> DataFrame:
        verdict = F.col(silver.ACCEPTED)
        return typed(f"checked_{name}").where(verdict if accepted else ~verdict).drop(silver.ACCEPTED)

    def transactions() -> DataFrame:
        parents = (typed(t) for t in ("accounts", "customers", "branches", "channels", "txn_types"))
        return silver.transactions(source("transactions"), *parents, load_ts)

    def balances() -> DataFrame:
        parents = (typed(t) for t in ("accounts", "customers", "branches"))
        return silver.balances(source("balances_daily"), *parents, load_ts)

    return {
        "checked_branches": lambda: silver.checked_branches(source("branches"), load_ts),
        "branches": lambda: checked("branches", True),
        "reject_branches": lambda: checked("branches", False),
        "customers": lambda: silver.customers(source("customers"), source("customers_delta"), load_ts),
        "channels": lambda: silver.domain(source("transactions"), "channel", "channel_name"),
        "txn_types": lambda: silver.domain(source("transactions"), "txn_type", "txn_type_name"),
        "accounts": accounts,
        "loans": lambda: silver.loans(source("loans"), typed("customers"), typed("branches"), load_ts),
        "checked_cards": lambda: silver.checked_cards(source("cards"), typed("customers"), typed("accounts"), load_ts),
        "cards": lambda: checked("cards", True),
        "reject_cards": lambda: checked("cards", False),
        "transactions": transactions,
        "balances_daily": balances,
        "loan_payments": lambda: payment_plans(current(typed("loans")), as_of, load_ts),
    }


def known_keys(keys: Layer, star: Layer, name: str) -> KeyRegister | None:
    """The register of a dimension's keys, brought up to date from the stored dimension; None
    before there is either. A dimension that is built once needs no register."""
    _, key, _ = gold.DIMENSION_SOURCES[name]
    register = KeyRegister(keys, name, gold.DIMENSION_COLUMNS[name][0], key)
    if Layer.exists(star, name):
        register.remember(Layer.table(star, name))
    return register if keys.exists(name) else None


def gold_recipes(
    typed: BuiltLayer, star: loads.Tables, load_ts: str, batch: str, keys: Layer, stored: Callable[[], Layer]
) -> dict[str, Callable[[], DataFrame]]:
    """``stored`` gives the layer that the recipes' tables belong to, ``keys`` holds the registers."""

    def dims() -> Mapping[str, DataFrame]:
        return stored().all()  # a fact waits for the dimensions that it looks up, no others

    def results() -> DataFrame:
        return conform(check(typed, star, batch, load_ts), gold_schema("dq_results"))

    recipes: dict[str, Callable[[], DataFrame]] = {
        name: lambda n=name, t=table: gold.dimension(n, typed.table(t), known_keys(keys, stored(), n))
        for name, (table, _, _) in gold.DIMENSION_SOURCES.items()
    }
    recipes |= {
        "dim_date": lambda: gold.dim_date(typed.present(gold.DATED_TABLES)),
        "fact_transactions": lambda: gold.fact_transactions(typed.table("transactions"), dims()),
        "fact_daily_balances": lambda: gold.fact_daily_balances(typed.table("balances_daily"), dims()),
        "fact_loans": lambda: gold.fact_loans(typed.table("loans"), dims()),
        "fact_loan_payments": lambda: gold.keyed_plans(typed.kept("loan_payments"), dims()),
        **{name: lambda n=name: loads.summary(n, star) for name in loads.SUMMARIES},
        "dq_results": results,
    }
    return recipes


def check(typed: Layer, star: loads.Tables, batch: str = BATCH, executed: str = LOAD_TS) -> DataFrame:
    """Every check of the run in one long table."""
    results = [
        quality.rule_result("branches", "null_branch_id", typed.table("reject_branches")),
        quality.rule_result("cards", "orphan_parent", typed.table("reject_cards")),
        quality.rule_result("dim_loan", "duplicate_loan_id", quality.duplicate_keys(star("dim_loan"), "loan_id")),
        quality.rule_result("loan_payments", "null_payment_date", typed.table("loan_payments").where("payment_date is null")),
    ]
    results += [quality.coverage_results(f, star(f), keys) for f, keys in FOREIGN_KEYS.items()]
    return quality.collect_results(results, batch, executed)


def to_warehouse(star: Layer, warehouse: Layer) -> dict[str, DataFrame]:
    """The twelve served tables, in their declared form."""
    served = [t for t in gold.DIMENSION_SOURCES] + ["dim_date"] + list(FOREIGN_KEYS)
    return warehouse.store_all({t: conform(star.table(t), gold_schema(t), fill=True) for t in served})


def open_lake(
    spark: SparkSession, tables: Mapping[str, DataFrame], root: str, name: str,
    load_ts: str | None = None, as_of: str | None = None, batch: str | None = None,
) -> Lake:
    """A lake over the given source tables, stored under ``root`` in databases whose
    names start with ``name``. Tables are built on demand, or all by ``build()``; those
    that an earlier session stored under ``root`` are read and not built again (see
    ``BuiltLayer.refresh``). By default rows carry the time of this call, payments are
    judged by today's date, and the batch is a new one.
    """
    load_ts = load_ts or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    batch = batch or uuid4().hex
    raw = BuiltLayer(
        spark, f"{name}_raw", f"{root}/raw", {f"{SCHEMA_NAME}.{t}": lambda df=df: df for t, df in tables.items()}
    )
    # recipes look their inputs up in the layer they belong to, once it exists
    typed = BuiltLayer(
        spark, f"{name}_silver", f"{root}/silver", silver_recipes(raw, lambda t: typed.table(t), load_ts, as_of),
        {"loan_payments": instalments},
    )
    def summed(plans: DataFrame, columns: Sequence[str]) -> DataFrame | None:
        found = gold.summed_payments(plans, star.all(), columns)
        return found if found is None or "date_key" not in columns else loads.monthly(found)

    star = BuiltLayer(
        spark, f"{name}_gold", f"{root}/gold",
        gold_recipes(typed, lambda *a: star.lookup(*a), load_ts, batch, Layer(spark, f"{name}_keys", f"{root}/keys"), lambda: star),
        {"fact_loan_payments": lambda plans: loads.monthly(gold.payments_of(plans, star.all()))},
        {"fact_loan_payments": Shorter(("payment_amount",), summed, "payment_id", gold.numbered_payments)},
    )
    return Lake(raw, typed, star)


_lakes: dict[tuple[str, str], Lake] = {}
_lock = Lock()


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake over a folder of test tables, under the shared folder: one for each
    application, so that tests of changed code never read what older code stored."""
    app = spark.sparkContext.applicationId
    with _lock:
        if (app, sf_dir) not in _lakes:
            tag = sha1(f"{app}|{sf_dir}".encode()).hexdigest()[:10]
            root = f"{shared_folder(spark)}/lakemart_{tag}"
            tables = fixtures.raw_tables(spark, sf_dir)
            _lakes[app, sf_dir] = open_lake(spark, tables, root, f"lakemart_{tag}", LOAD_TS, AS_OF, BATCH)
        return _lakes[app, sf_dir]
