"""Change feeds merged into stored histories, and keys that outlive a load."""

import random
import re
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, values
from lakemart.operators.history import MICROS, history
from lakemart.plans.medallion import BuiltLayer, known_keys
from lakemart.sources.histories import PART, HistoryTable
from lakemart.sources.layers import LOAD, Folder, Layer
from lakemart.sources.registers import KeyRegister

START = datetime(2024, 1, 1)
SHAPE = "k string, t timestamp, v string, n int"


@pytest.fixture
def layer(spark, tmp_path):
    return Layer(spark, f"t_{uuid.uuid4().hex[:8]}", str(tmp_path / "db"))


def table_of(layer, **rest):
    return HistoryTable(layer, "h", "k", "t", ("v",), MICROS, ("n",), **{"buckets": 8, **rest})


def random_rows(seed, n=300):
    rng, rows = random.Random(seed), []
    for i in range(n):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(15)}"
        when = None if rng.random() < 0.04 else START + timedelta(minutes=rng.randrange(500))
        rows.append((key, when, rng.choice(["a", "b", None]), i))
    return rows


def whole(frame, rows, **rest):
    return values(history(frame(rows, SHAPE), "k", "t", ["v"], MICROS, ties=["n"], **rest))


@pytest.mark.parametrize("in_order", [True, False])
@pytest.mark.parametrize("hot_rows", [None, 20])
def test_feeds_in_any_order_equal_one_build(layer, frame, in_order, hot_rows):
    rows = random_rows(3 if in_order else 4)
    if in_order:
        rows.sort(key=lambda r: (r[1] is None, r[1] or START, r[3]))
    table = table_of(layer, hot_rows=hot_rows)
    for i in range(0, 300, 100):
        got = table.merge(frame(rows[i : i + 100], SHAPE))
        assert values(got) == whole(frame, rows[: i + 100])
    assert values(table.open(), "k") == sorted((k,) for k in {r[0] for r in rows})


def test_a_late_row_makes_a_repeat_a_version(layer, frame):
    def at(h):
        return START + timedelta(hours=h)

    rows = [("k", at(1), "a", 1), ("k", at(3), "a", 2), ("k", at(4), "b", 3)]
    table = table_of(layer)
    assert table.merge(frame(rows, SHAPE)).count() == 2
    late = [("k", at(2), "c", 4)]
    assert values(table.merge(frame(late, SHAPE)), "v") == [("a",), ("a",), ("b",), ("c",)]
    assert values(table.rows()) == whole(frame, rows + late)


def test_missing_keys_empty_feeds_and_repeated_feeds(layer, frame):
    rows = [("k", START, "a", 1), ("k", None, "b", 2), (None, START, "x", 3)]
    table = table_of(layer)
    first = values(table.merge(frame([], SHAPE)))
    assert first == []
    kept = values(table.merge(frame(rows, SHAPE)))
    assert kept == whole(frame, rows[:2])
    assert values(table.merge(frame([], SHAPE))) == kept
    assert values(table.merge(frame(rows, SHAPE))) == kept


def test_only_touched_buckets_are_read_and_written(layer, frame):
    rows = [(f"k{i}", START, "a", i) for i in range(60)]
    table = table_of(layer)
    table.merge(frame(rows, SHAPE))
    before = {p for one in layer.live("h").loads for p in Folder(layer.spark, layer.place("h")).list(f"{LOAD}={one.id}") if "=" in p}
    assert len(before) == 8  # open versions only
    table.merge(frame([("k7", START + timedelta(days=1), "b", 99)], SHAPE))
    first, second = layer.live("h").loads
    assert len(first.parts) == 7 and len(second.parts) == 2
    stored = layer.table("h")
    pruned = r"PartitionFilters: \[[^\]]*history_part"
    assert re.search(pruned, plan_of(table.open())) and re.search(pruned, plan_of(stored.where(F.col(PART).isin(1, 4))))
    assert table.rows().count() == 61 and table.open().count() == 60


def test_a_new_column_is_null_for_older_rows(layer, frame):
    table = table_of(layer)
    table.merge(frame([("k", START, "a", 1)], SHAPE))
    table.merge(frame([("k", START + timedelta(days=1), "b", 2, "new")], SHAPE + ", extra string"))
    assert values(table.rows(), "v", "extra") == [("a", None), ("b", "new")]


def test_keys_stay_when_members_come_and_go(layer, frame):
    def members(*names):
        return frame([(n, "x") for n in names], "id string, other string")

    register = KeyRegister(layer, "keys", "id", "id_key")
    first = dict((r[1], r[0]) for r in values(register.grow(members("a", "b", "c", "a"))))
    assert sorted(first.values()) == [0, 1, 2]
    register.grow(members("d", "b", None))
    later = dict((r[1], r[0]) for r in values(register.grow(members("e"))))
    assert {k: later[k] for k in first} == first
    assert later["d"] == 3 and later["e"] == 4
    version = layer.live("keys").version
    register.grow(members("a", "e"))
    assert layer.live("keys").version == version  # nothing new: nothing written
    shown = register.attach(members("a", "zz", None))
    assert shown.columns == ["id_key", "id", "other"]
    assert values(shown, "id_key", "id") == sorted([(first["a"], "a"), (None, "zz"), (None, None)], key=repr)


def test_an_empty_register_numbers_from_zero(layer, frame):
    register = KeyRegister(layer, "keys", "id", "id_key")
    assert register.grow(frame([], "id string")).count() == 0
    assert values(register.grow(frame([("a",)], "id string"))) == [(0, "a")]


def test_a_dimension_built_again_keeps_its_keys(spark, frame, tmp_path):
    """Also the key of a member that was away for one build is never given to another."""
    names = ["WEB", "ATM", "APP"]
    keys = Layer(spark, "keys", str(tmp_path / "keys"))

    def recipe():
        from lakemart.plans import gold

        shown = frame([(n,) for n in names], "channel_name string")
        return gold.dimension("dim_channel", shown, known_keys(keys, star, "dim_channel"))

    star = BuiltLayer(spark, "star", str(tmp_path / "star"), {"dim_channel": recipe})

    def numbers():
        return {r["channel_name"]: r["channel_key"] for r in star.table("dim_channel").collect()}

    first = numbers()
    gone = next(n for n in names if first[n] == 2)
    names.remove(gone)
    star.refresh("dim_channel")
    assert numbers() == {n: first[n] for n in names}
    names += [f"NEW{i}" for i in range(10)]
    star.refresh("dim_channel")
    second = numbers()
    assert {n: second[n] for n in first if n != gone} == {n: first[n] for n in first if n != gone}
    assert sorted(second[n] for n in names if n not in first) == list(range(3, 13))
    names.append(gone)
    star.refresh("dim_channel")
    assert numbers()[gone] == 2
