from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import values
from lakemart.functions.rules import code, text
from lakemart.operators.cleaning import audited, clean, event_time, merge_changes, rename, require_keys, split
from lakemart.operators.integrity import Parent, keep_children, split_orphans
from lakemart.operators.latest import latest
from lakemart.sources.ingest import convert


def test_rename_only_when_free(frame):
    df = frame([(1, 2)], "a int, b int")
    assert rename(df, {"a": "c", "x": "y"}).columns == ["c", "b"]
    assert rename(df, {"a": "b"}).columns == ["a", "b"]


def test_clean_leaves_other_columns(frame):
    df = frame([(" x ", " Y ", 1)], "a string, b string, c int")
    assert values(clean(df, {"a": code, "b": text, "zzz": code})) == [("X", "Y", 1)]


def test_keys_null_and_blank(frame):
    df = frame([(None,), ("",), ("  ",), (" k ",)], "k string")
    assert require_keys(df, ["k", "absent"]).count() == 3
    assert values(require_keys(df, ["k"], blank_is_missing=True)) == [(" k ",)]


def test_split_loses_nothing(frame):
    df = frame([(1,), (2,), (None,)], "a int")
    good, bad = split(df, F.col("a") > 1)
    assert values(good) == [(2,)] and values(bad) == [(1,), (None,)]


def test_audit_columns(frame):
    with_source = audited(frame([(" s ",)], "record_source string"), "2024-01-01 00:00:00").first()
    assert tuple(with_source) == ("s", datetime(2024, 1, 1))
    assert audited(frame([(1,)], "a int"), "2024-01-01 00:00:00").first()["record_source"] == "bronze"


def test_event_time_falls_back(frame):
    df = frame([(datetime(2020, 1, 1), None), (None, datetime(2021, 1, 1)), (None, None)], "u timestamp, c timestamp")
    got = df.select(event_time(["u", "c"], "2030-01-01 00:00:00")).collect()
    assert [r[0].year for r in got] == [2020, 2021, 2030]


def test_merge_matches_names(frame):
    assert values(merge_changes(frame([(1, "x")], "a int, b string"), frame([("y", 2)], "b string, a int"))) == [(1, "x"), (2, "y")]


def test_convert(frame):
    df = frame([("12", "x", True)], "a string, b string, c boolean")
    assert values(convert(df, {"a": "int", "b": "int", "c": "string"})) == [(12, None, "true")]
    with pytest.raises(TypeError):
        convert(df, {"c": "int"})


def test_latest_puts_null_last_and_breaks_ties(frame):
    df = frame([("a", 1, 1), ("a", 2, 1), ("a", 2, 5), ("b", None, 9), ("b", 0, 1)], "k string, t int, x int")
    assert values(latest(df, "k", ["t", "absent"], ["x"])) == [("a", 2, 5), ("b", 0, 1)]
    assert latest(df, "absent", ["t"]) is df


def test_orphans(frame):
    child = frame([(1, "a", "x"), (2, "b", "x"), (3, "a", None), (4, "a", "z")], "i int, p string, q string")
    parents = {
        "p": Parent(frame([("a",), ("a",), ("c",)], "id string"), "id"),
        "q": Parent(frame([("x",), ("y",)], "key string"), "key"),
    }
    good, bad = split_orphans(child, parents)
    assert values(good) == [(1, "a", "x")]
    assert [r[0] for r in values(bad, "i")] == [2, 3, 4]
    assert values(keep_children(child, parents)) == values(good)
    assert keep_children(child, parents).columns == child.columns
