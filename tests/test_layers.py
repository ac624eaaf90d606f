import os
import subprocess
import sys
import uuid
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import values
from lakemart.plans.medallion import AS_OF, BATCH, LOAD_TS, BuiltLayer, open_lake
from lakemart.session import shared_folder
from lakemart.sources import fixtures
from lakemart.sources.ingest import MANIFEST, copy_changes, copy_folder, discover_files
from lakemart.sources.layers import Layer


@pytest.fixture
def layer(spark, tmp_path):
    return Layer(spark, f"t_{uuid.uuid4().hex[:8]}", str(tmp_path / "db"))


def test_overwrite_replaces_schema_and_drop(layer, frame):
    layer.overwrite(frame([(1,)], "a int"), "dbo.x")
    again = layer.overwrite(frame([("s", 2)], "b string, c int"), "dbo.x")
    assert again.columns == ["b", "c"] and layer.tables() == ["dbo__x"]
    assert values(layer.recreate(frame([(1,), (2,)], "a int"), "dbo.x")) == [(2,)]
    assert list(layer.present(["dbo.x", "missing"])) == ["dbo.x"]
    layer.drop("dbo.x")
    assert not layer.exists("dbo.x")


def test_append_evolves_the_schema(layer, frame):
    layer.append(frame([(1, "x")], "a int, b string"), "t")
    got = layer.append(frame([(5, 2)], "n int, a int"), "t")
    assert values(got) == [(1, "x", None), (2, None, 5)]


def test_days_are_replaced_not_doubled(layer, frame):
    first = frame([(date(2024, 1, 1), 1), (date(2024, 1, 2), 2)], "d date, v int")
    layer.replace_days(first, "t", "d")
    got = layer.replace_days(frame([(date(2024, 1, 2), 9), (date(2024, 1, 3), 3)], "d date, v int"), "t", "d")
    assert values(got, "d", "v") == [(date(2024, 1, 1), 1), (date(2024, 1, 2), 9), (date(2024, 1, 3), 3)]
    wider = layer.replace_days(frame([(date(2024, 1, 3), 4, "n")], "d date, v int, w string"), "t", "d")
    assert values(wider, "d", "v", "w")[-1] == (date(2024, 1, 3), 4, "n")


def test_discover_and_copy(spark, layer, frame, tmp_path):
    source = tmp_path / "src"
    frame([(1,), (2,)], "a int").write.parquet(str(source / "beta.parquet"))
    frame([("x",)], "b string").write.parquet(str(source / "alpha.parquet"))
    frame([(7,)], "c int").write.parquet(str(source / "plain"))
    frame([(8, 1)], "d int, day int").write.partitionBy("day").parquet(str(source / "daily"))
    frame([(1,)], "a int").write.parquet(str(source / "sales" / "b_c.parquet"))
    frame([(2,)], "a int").write.parquet(str(source / "sales_b" / "c"))
    listed = [("dbo", "alpha"), ("dbo", "beta"), ("dbo", "daily"), ("dbo", "plain"), ("sales", "b_c"), ("sales_b", "c")]
    assert values(discover_files(spark, str(source)), "SchemaName", "TableName") == listed
    copied = copy_folder(spark, str(source), layer)
    assert values(copied["dbo.beta"]) == [(1,), (2,)] and values(copied["dbo.plain"]) == [(7,)]
    assert values(copied["dbo.daily"]) == [(8, 1)]
    assert values(copied["sales.b_c"]) == [(1,)] and values(copied["sales_b.c"]) == [(2,)]
    assert layer.tables() == sorted(f"{s}__{t}" for s, t in listed)


def test_stored_tables_are_read_and_not_built_again(spark, frame, tmp_path):
    built = []

    def recipe(rows, schema):
        def build():
            built.append(schema)
            return frame(rows, schema)
        return build

    recipes = {"a": recipe([(1,)], "v int"), "fact_loans": recipe([(20240105, 2), (20240201, 3)], "date_key int, w int")}
    database, folder = f"t_{uuid.uuid4().hex[:8]}", str(tmp_path / "lake")
    first = BuiltLayer(spark, database, folder, recipes)
    wanted = {t: values(first.table(t)) for t in recipes}
    assert len(built) == 2
    again = BuiltLayer(spark, database, folder, recipes)
    assert {t: values(again.table(t)) for t in recipes} == wanted and len(built) == 2
    # so does a session that knows nothing but the folder
    elsewhere = BuiltLayer(spark, database + "x", folder, recipes)
    assert values(elsewhere.table("a")) == wanted["a"]
    assert values(elsewhere.table("fact_loans").select("date_key", "w")) == [(20240105, 2), (20240201, 3)] and len(built) == 2
    again.refresh("a")
    again.table("a")
    assert len(built) == 3


def days(frame, *rows):
    return frame([(date(2024, 1, d), v) for d, v in rows], "d date, v int")


def test_a_reader_keeps_its_version(layer, frame):
    first = layer.replace_days(days(frame, (1, 1), (2, 2)), "t", "d")
    second = layer.replace_days(days(frame, (2, 9)), "t", "d")
    assert values(first, "v") == [(1,), (2,)] and values(second, "v") == [(1,), (9,)]
    third = layer.overwrite(second.withColumn("v", second.v + 1), "t", ["d"])  # from itself
    assert values(third, "v") == [(10,), (2,)] and values(second, "v") == [(1,), (9,)]


def test_a_failed_write_changes_nothing(layer, frame):
    layer.overwrite(frame([(1,)], "a int"), "t")
    with pytest.raises(Exception, match="boom"):
        layer.overwrite(frame([(1,)], "a int").selectExpr("raise_error('boom') as a"), "t")
    assert values(layer.table("t")) == [(1,)]
    kept = layer.live("t").loads[0].id
    assert len(layer.vacuum("t")) >= 0 and layer.live("t").loads[0].id == kept and values(layer.table("t")) == [(1,)]


def test_days_taken_out_null_days_and_compaction(layer, frame):
    rows = [(date(2024, 1, 1), 1), (date(2024, 1, 2), 2), (None, 3)]
    layer.replace_days(frame(rows, "d date, v int"), "t", "d")
    got = layer.swap_days(frame([(None, 4), (date(2024, 1, 3), 5)], "d date, v int"), "t", "d", [date(2024, 1, 1), date(2023, 1, 1)])
    want = sorted([(date(2024, 1, 2), 2), (date(2024, 1, 3), 5), (None, 4)], key=repr)
    assert values(got, "d", "v") == want
    more = layer.append(frame([(date(2024, 1, 2), 6, "new")], "d date, v int, w string"), "t")
    assert values(more, "d", "v", "w") == sorted([(*r, None) for r in want] + [(date(2024, 1, 2), 6, "new")], key=repr)
    packed = layer.compact("t")
    assert values(packed, "d", "v", "w") == values(more, "d", "v", "w") and len(layer.live("t").loads) == 1
    layer.drop_days("t", "d", [date(2024, 1, 2), None])
    assert values(layer.table("t"), "d", "v") == [(date(2024, 1, 3), 5)]
    layer.drop_days("t", "d", [date(2024, 1, 3)])
    assert layer.table("t").count() == 0 and layer.table("t").columns == ["v", "w", "d"]
    with pytest.raises(ValueError, match="stored by d"):
        layer.replace_days(frame([(1, 1)], "v int, x int"), "t", "x")


def test_dead_days_are_not_read(layer, frame):
    layer.replace_days(days(frame, (1, 1), (2, 2)), "t", "d")
    layer.replace_days(days(frame, (2, 3)), "t", "d")
    files = {f.split("_load=")[1].split("/")[0] + f.split("/d=")[1].split("/")[0] for f in layer.table("t").select("v", F.col("_metadata.file_path")).rdd.map(lambda r: r[1]).collect()}
    first, second = (one.id for one in layer.live("t").loads)
    assert files == {first + "2024-01-01", second + "2024-01-02"}


def test_a_write_from_an_old_version_is_refused(layer, frame):
    layer.overwrite(frame([(1,)], "a int"), "t")
    was, load = layer.live("t"), layer._write(frame([(3,)], "a int"), "t", None)
    layer.overwrite(frame([(2,)], "a int"), "t")
    with pytest.raises(RuntimeError, match="another session"):
        layer._commit("t", was, replace(was, loads=(load,)))
    assert values(layer.table("t")) == [(2,)]


def test_sql_by_name(spark, layer, frame):
    layer.overwrite(frame([(1, "x")], "a int, b string"), "dbo.t")
    (name,) = layer.expose()
    assert values(spark.sql(f"select b from {name}")) == [("x",)] and values(layer.query("dbo.t", "a + 1")) == [(2,)]


OTHER_SESSION = """
import sys
from datetime import date
from lakemart.plans.medallion import BuiltLayer
from lakemart.session import local_session
spark = local_session("1", 1, "other")
step, folder = sys.argv[1:]
def rows(*days):
    return spark.createDataFrame([(date(2024, 1, d), v) for d, v in days], "d date, v int")
layer = BuiltLayer(spark, "elsewhere", folder, {"a": lambda: spark.range(int(step)).toDF("n")})
if step == "1":
    layer.replace_days(rows(*((d, d) for d in range(1, 6))), "t", "d")
    layer.table("a")
else:
    layer.replace_days(rows((3, 30)), "t", "d")
    layer.table("a")
    assert layer.table("a").count() == 1
    layer.refresh("a")
    assert layer.table("a").count() == 2
print(sorted(tuple(r) for r in layer.table("t").select("v").collect()))
"""


def test_other_processes_load_and_rebuild(layer, tmp_path):
    """Five days stored by one process, one of them loaded by the next: five days, in both and here."""
    root = str(Path(__file__).resolve().parent.parent)
    for step in ("1", "2"):
        subprocess.run([sys.executable, "-c", OTHER_SESSION, step, layer.folder], check=True, cwd=root, capture_output=True, timeout=300)
    assert values(layer.table("t"), "v") == [(1,), (2,), (30,), (4,), (5,)]
    assert layer.table("a").count() == 2
    layer.drop("t")
    assert not layer.exists("t") and not (Path(layer.folder) / "t").exists()


def test_daily_load_through_the_lake(spark, tmp_path):
    """Raw, typed, fact and summaries have the new day; a rebuilt typed table keeps it; other
    months' files of the summaries stay."""
    tables = fixtures.raw_tables(spark, "/root/testdata/sf0.001")
    balances = tables["balances_daily"]
    months = balances.withColumn("snapshot_date", F.expr("add_months(snapshot_date, -1)")).where("snapshot_date < '2023-12-06'")
    old = balances.where("snapshot_date < '2024-01-06'").unionByName(months)
    lake = open_lake(spark, {**tables, "balances_daily": old}, str(tmp_path / "lake"), f"t{uuid.uuid4().hex[:6]}", LOAD_TS, AS_OF, BATCH)
    names = ("fact_branch_daily_summary", "fact_branch_daily_wide", "fact_customer_daily_wide")
    for name in names:
        lake.gold.table(name)
    december = {n: {f for f in files_of(lake.gold.table(n)) if "month_key=202312" in f} for n in names}
    assert all(december.values())
    new = balances.where("snapshot_date >= '2024-01-05' and snapshot_date < '2024-01-09'")
    assert lake.load_balances(new, LOAD_TS) == ["fact_daily_balances", *names]
    assert "balances_daily" not in lake.raw.tables() and lake.raw.table("dbo.balances_daily").agg(F.max("snapshot_date")).first()[0] == date(2024, 1, 8)
    whole = balances.where("snapshot_date < '2024-01-09'").unionByName(months)
    lake.silver.refresh("balances_daily")
    assert lake.silver.table("balances_daily").agg(F.max("snapshot_date")).first()[0] == date(2024, 1, 8)
    fresh = open_lake(spark, {**tables, "balances_daily": whole}, str(tmp_path / "fresh"), f"t{uuid.uuid4().hex[:6]}", LOAD_TS, AS_OF, BATCH)
    for name in ("fact_daily_balances", *names):
        one, other = lake.gold.table(name), fresh.gold.table(name)
        assert one.columns == other.columns and one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty(), name
    assert december == {n: {f for f in files_of(lake.gold.table(n)) if "month_key=202312" in f} for n in names}


def files_of(df):
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


class FakeSession:
    """Just the settings ``shared_folder`` asks for."""

    def __init__(self, **settings):
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}
        self.sparkContext = self
        self.applicationId = "app"

    def getConf(self):
        return self.settings


def test_shared_folder_is_the_clusters():
    assert shared_folder(FakeSession(spark_checkpoint_dir="/shared/place/", spark_master="yarn")) == "/shared/place"
    with pytest.raises(ValueError):
        shared_folder(FakeSession(spark_master="yarn"))
    local = FakeSession(spark_master="local[2]")
    assert shared_folder(local) == shared_folder(local)


def test_only_what_differs_is_copied(spark, tmp_path, monkeypatch):
    source, layer = tmp_path / "source", Layer(spark, "raw", f"{tmp_path}/raw")

    def part(name, rows, schema="id long, day string"):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/one")
        (made,) = [p for p in os.listdir(tmp_path / "one") if p.endswith(".parquet")]
        os.makedirs((source / name).parent, exist_ok=True)
        os.replace(tmp_path / "one" / made, source / name)

    def copied():
        return {r["table_name"]: (r["action"], r["files"]) for r in copy_changes(spark, str(source), layer).collect()}

    part("days/day=1/part-0.parquet", [(1,)], "id long")
    part("days/day=2/part-0.parquet", [(2,)], "id long")
    part("single.parquet", [(7, "x")])
    assert copied() == {"dbo.days": ("copied", 2), "dbo.single": ("copied", 1)}
    notes = {t: layer.live(t) for t in ("dbo.days", "dbo.single", MANIFEST)}
    assert copied() == {"dbo.days": ("kept", 0), "dbo.single": ("kept", 0)}
    assert notes == {t: layer.live(t) for t in notes}  # nothing was written
    # a further file, with a column more
    part("days/day=3/part-0.parquet", [(3, "n")], "id long, note string")
    assert copied() == {"dbo.days": ("extended", 1), "dbo.single": ("kept", 0)}
    assert values(layer.table("dbo.days"), "id", "day", "note") == [(1, 1, None), (2, 2, None), (3, 3, "n")]
    # a changed file, then a missing one
    part("days/day=2/part-0.parquet", [(2,), (22,)], "id long")
    assert copied()["dbo.days"] == ("copied", 3)
    assert values(layer.table("dbo.days"), "id") == [(1,), (2,), (22,), (3,)]
    os.remove(source / "days/day=1/part-0.parquet")
    assert copied()["dbo.days"] == ("copied", 2)
    # a run that is lost before the manifest is written: no file is added twice
    part("days/day=4/part-0.parquet", [(4,)], "id long")
    with monkeypatch.context() as lost:
        lost.setattr(Layer, "swap_days", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            copied()
    assert copied()["dbo.days"] == ("copied", 3)
    assert values(layer.table("dbo.days"), "id") == [(2,), (22,), (3,), (4,)]
    # a copy that something else has written is made anew
    layer.overwrite(layer.table("dbo.single").limit(0), "dbo.single")
    assert copied() == {"dbo.days": ("kept", 0), "dbo.single": ("copied", 1)}
    assert values(layer.table("dbo.single")) == [(7, "x")]
    assert layer.tables() == [MANIFEST, "dbo__days", "dbo__single"]


def test_changes_of_an_empty_source(spark, tmp_path):
    os.makedirs(tmp_path / "source")
    assert copy_changes(spark, str(tmp_path / "source"), Layer(spark, "raw", f"{tmp_path}/raw")).count() == 0


def test_payments_are_stored_as_plans_and_read_as_rows(spark, frame, tmp_path):
    from lakemart.operators.schedule import instalments, payment_plans, payment_schedule
    from lakemart.plans import gold, loads

    loans = frame(
        [("a", "c", "b", date(2024, 1, 31), 100, 3), ("a", "c", "b", date(2024, 1, 31), 100, 3), (None, "c", None, date(2024, 2, 1), 7, 2),
         ("x", None, "?", date(2024, 2, 1), 9, 1), ("none", "c", "b", date(2024, 1, 1), 1, 0), ("undated", "c", "b", None, 1, 3)],
        "loan_id string, customer_id string, branch_id string, start_date date, principal_amount int, tenure_months int",
    ).withColumn("principal_amount", F.col("principal_amount").cast("decimal(18,2)"))
    dims = {
        "dim_branch": frame([(1, "b"), (2, None)], "branch_key long, branch_id string"),
        "dim_customer": frame([(1, "c"), (2, "c")], "customer_key long, customer_id string"),
        "dim_loan": frame([(7, "a"), (8, "x")], "loan_key long, loan_id string"),
        "dim_date": frame([(20240131, date(2024, 1, 31)), (20240201, date(2024, 2, 1))], "Date_Key int, Date date"),
    }
    whole = payment_schedule(loans, "2024-02-10", LOAD_TS)
    wanted = gold.fact_loan_payments(whole, dims)
    typed = BuiltLayer(spark, "p", str(tmp_path / "p"), {"loan_payments": lambda: payment_plans(loans, "2024-02-10", LOAD_TS)}, {"loan_payments": instalments})
    assert values(typed.table("loan_payments")) == values(whole) and typed.table("loan_payments").columns == whole.columns
    assert spark.read.parquet(str(tmp_path / "p" / "loan_payments" / "_load=*")).count() == 4  # one row per running loan
    assert values(gold.fact_loan_payments(typed.kept("loan_payments"), dims)) == values(wanted) != []

    star = BuiltLayer(
        spark, "q", str(tmp_path / "q"), {"fact_loan_payments": lambda: gold.keyed_plans(typed.kept("loan_payments"), dims)},
        {"fact_loan_payments": lambda plans: loads.monthly(gold.payments_of(plans, dims))},
    )
    assert values(star.table("fact_loan_payments")) == values(loads.monthly(wanted))
    assert values(star.query("fact_loan_payments", "payment_id")) == values(wanted, "payment_id")
    # rows that come from elsewhere join them
    star.compact("fact_loan_payments")
    more = star.append(loads.monthly(wanted), "fact_loan_payments")
    assert values(more) == values(loads.monthly(wanted.unionByName(wanted))) == values(star.table("fact_loan_payments"))


def test_a_fact_waits_for_its_own_dimensions_only(spark, frame, tmp_path):
    from lakemart.plans import medallion

    class Typed:
        def table(self, name):
            return frame([("a", "c", "b", date(2024, 1, 1), 1.0, "inr")], "account_id string, customer_id string, branch_id string, snapshot_date date, end_of_day_balance double, currency string")

    made = {
        "dim_account": "account_key long, account_id string", "dim_customer": "customer_key long, customer_id string",
        "dim_branch": "branch_key long, branch_id string", "dim_date": "Date_Key int, Date date",
    }
    recipes = {name: lambda schema=schema: frame([], schema) for name, schema in made.items()}
    star = BuiltLayer(spark, "d", str(tmp_path / "d"), recipes)
    found = medallion.gold_recipes(Typed(), star.table, LOAD_TS, BATCH, star, lambda: star)
    assert found["fact_daily_balances"]().count() == 1  # no dim_loan, no dim_card


def test_layers_are_stored_with_zstd(layer, frame, tmp_path):
    layer.overwrite(frame([(1,)], "a int"), "t")
    assert [f for f in (tmp_path / "db" / "t").rglob("*.parquet") if ".zstd." not in f.name] == []


def test_loan_histories_sort_by_no_ties(frame):
    from conftest import plan_of
    from lakemart.plans import silver

    raw = frame([("a", "c", "b", "x", date(2024, 1, 1), 1.0, 2.0, 3)], "loan_id string, customer_id string, branch_id string, status string, "
                "start_date date, interest_rate_apr double, principal_amount double, tenure_months int")
    ids = frame([("c", "b")], "customer_id string, branch_id string")
    made = silver.loans(raw, ids, ids, LOAD_TS)
    assert [r["is_current"] for r in made.collect()] == [1]
    over = [line for line in plan_of(made).splitlines() if "lag(" in line]
    assert over and not any("tenure_months" in line.split("windowspecdefinition(")[1].split("specifiedwindowframe")[0] for line in over)


def test_loans_are_shuffled_by_loan_once_and_looked_up_last(spark, frame):
    from conftest import plan_of
    from lakemart.plans import gold, silver

    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [("a", "c", "b", "x", date(2024, 1, 1), 1.0, 2.0, 3), ("a", "c", "b", "y", date(2024, 1, 2), 1.0, 2.0, 3),
                ("d", "c", "b", "x", date(2024, 1, 1), 1.0, 2.0, 3), ("d", "other", "b", "x", date(2024, 1, 2), 1.0, 2.0, 3)]
        raw = frame(rows, "loan_id string, customer_id string, branch_id string, status string, "
                    "start_date date, interest_rate_apr double, principal_amount double, tenure_months int")
        ids = frame([("c", "b")], "customer_id string, branch_id string")
        made = silver.loans(raw, ids, ids, LOAD_TS)
        # the newest row of d is an orphan: no older row takes its place
        assert values(made, "loan_id", "status", "is_current", "effective_to") == [("a", "Y", 1, None)]
        assert plan_of(made).count("Exchange hashpartitioning(loan_id") == 1

        dims = {
            "dim_loan": frame([("a", 7)], "loan_id string, loan_key long"), "dim_customer": frame([("c", 8)], "customer_id string, customer_key long"),
            "dim_branch": frame([("b", 9)], "branch_id string, branch_key long"), "dim_date": frame([(20240102, date(2024, 1, 2))], "Date_Key int, Date date"),
        }
        fact = gold.fact_loans(made, dims)
        assert values(fact, "loan_key", "date_key", "customer_key", "branch_key") == [(7, 20240102, 8, 9)]
        last = plan_of(fact).split("Join ")[1]
        assert "branch_id#" not in last and "customer_id#" not in last
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
