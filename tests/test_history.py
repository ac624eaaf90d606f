import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, values
from lakemart.operators.history import MICROS, SECONDS, current, history

START = datetime(2024, 1, 1)


def hours(n):
    return START + timedelta(hours=n)


def brute_force(rows, gap):
    """(key, value, start, end, current) by walking each key's rows in order."""
    out = []
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is None, r[1] or START, r[3]))
        kept = [r for i, r in enumerate(mine) if i == 0 or (r[2] or "NULL") != (mine[i - 1][2] or "NULL")]
        for i, r in enumerate(kept):
            last = i + 1 == len(kept)
            following = None if last else kept[i + 1][1]
            out.append((key, r[2], r[1], None if following is None else following - gap, int(last)))
    return sorted(out, key=repr)


def test_value_that_returns_is_a_new_version(frame):
    df = frame([("k", hours(0), "A"), ("k", hours(1), "A"), ("k", hours(2), "B"), ("k", hours(3), "A")], "k string, t timestamp, v string")
    got = history(df, "k", "t", ["v"])
    assert values(got, "v", "effective_start_date", "effective_end_date", "is_current") == sorted([
        ("A", hours(0), hours(2) - timedelta(seconds=1), 0),
        ("B", hours(2), hours(3) - timedelta(seconds=1), 0),
        ("A", hours(3), None, 1),
    ], key=repr)
    assert values(current(got), "v") == [("A",)]
    assert got.columns == ["k", "t", "v", "effective_start_date", "effective_end_date", "is_current"]


def test_null_word_is_told_apart_only_in_json_form(frame):
    df = frame([("k", hours(0), None), ("k", hours(1), "NULL")], "k string, t timestamp, v string")
    assert history(df, "k", "t", ["v"], form="text").count() == 1
    assert history(df, "k", "t", ["v"], form="json").count() == history(df, "k", "t", ["v"]).count() == 2


def test_equal_times_do_not_depend_on_partitions(frame):
    rows = [("k", hours(0), v) for v in "DACB"] + [("one", None, "x")]
    df = frame(rows, "k string, t timestamp, v string")
    results = {repr(values(history(df.repartition(n), "k", "t", ["v"]))) for n in (1, 2, 5)}
    assert len(results) == 1


def random_rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(20)}"
        when = None if rng.random() < 0.03 else START + timedelta(minutes=rng.randrange(4000))
        rows.append((key, when, rng.choice(["a", "b", None, "c"]), i))
    return rows


@pytest.mark.parametrize("seed,hot_rows,unit", [(1, 10**9, "day"), (2, 50, "day"), (3, 15, "hour"), (4, 0, "month"), (5, 50, "minute")])
def test_same_versions_plain_or_sliced(frame, seed, hot_rows, unit):
    rows = random_rows(seed)
    df = frame(rows, "k string, t timestamp, v string, i int")
    got = history(df, "k", "t", ["v"], MICROS, ties=["i"], hot_rows=hot_rows, slice_unit=unit)
    assert values(got, "k", "v", "effective_from", "effective_to", "is_current") == brute_force(rows, timedelta(microseconds=1))
    ones = got.groupBy("k").agg({"is_current": "sum"}).collect()
    assert all(r[1] == 1 for r in ones)


def test_usual_keys_take_one_shuffle(frame):
    df = frame(random_rows(7), "k string, t timestamp, v string, i int")
    plan = plan_of(history(df, "k", "t", ["v"], SECONDS, ties=["i"]))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_hot_keys_are_windowed_by_slice(frame):
    df = frame(random_rows(8), "k string, t timestamp, v string, i int")
    plan = plan_of(history(df, "k", "t", ["v"], SECONDS, ties=["i"], hot_rows=50))
    assert "hashpartitioning(k" in plan and "_slice" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_untimed_rows_of_a_hot_key_are_cut_too(frame):
    rng = random.Random(12)
    rows = [("", None, f"{rng.choice('abcdefgh')}{rng.randint(0, 40)}") for _ in range(400)] + [("", None, None)] * 3 + [("k", datetime(2024, 1, 1), "x")]
    df = frame(rows, "k string, t timestamp, v string")
    plain = history(df, "k", "t", ["v"], MICROS)
    cut = history(df, "k", "t", ["v"], MICROS, hot_rows=50)
    assert values(cut) == values(plain)
    assert "begun" in plan_of(cut)


def test_nothing_is_counted_for_unique_keys(frame, monkeypatch):
    import lakemart.operators.history as module

    monkeypatch.setattr(module, "hot_keys", lambda *a: pytest.fail("counted"))
    df = frame([("a", datetime(2024, 1, 1), "x")], "k string, t timestamp, v string")
    assert history(df, "k", "t", ["v"], MICROS, hot_rows=None).count() == 1


@pytest.mark.parametrize("form", ["json", "text"])
def test_fingerprints_are_worked_out_after_the_shuffle(frame, form):
    rows = [("a", 1, None, 1.0), ("a", 2, "x", 1.0), ("a", 3, "x", 1.0), ("a", 4, "x", None), ("a", 5, "x", None), ("b", 1, None, None), (None, 1, "y", 2.0), (None, 2, "y", 2.0)]
    df = frame(rows, "k string, t int, v string, w double").withColumn("t", F.timestamp_seconds("t"))
    made = history(df, "k", "t", ["v", "w"], form=form, hot_rows=None)
    assert values(made.select("k", F.unix_seconds("t").alias("t")), "k", "t") == [("a", 1), ("a", 2), ("a", 4), ("b", 1), (None, 1)]
    below = plan_of(made).split("Exchange", 1)[1]
    assert "sha2" not in below
    sliced = history(df, "k", "t", ["v", "w"], form=form, hot_rows=1)
    assert values(sliced) == values(made)
