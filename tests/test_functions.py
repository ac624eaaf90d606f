from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import values
from lakemart.functions import blank, rules
from lakemart.functions.text import band, fingerprint, first_word


def test_rules_read_what_they_can_and_blank_the_rest(frame):
    df = frame(
        [("1,200.50", "2024-02-29", " Ab ", "12.0"), ("abc", "2024-02-30", None, "x"),
         ("99999999999999999999", "2024-13-01", "", "3000000000"), (" 7 ", "2024-01-05 10:00:00", "c", "-4")],
        "a string, d string, t string, n string",
    )
    got = df.select(
        rules.money(F.col("a")), rules.day(F.col("d")), rules.code(F.col("t")), rules.lower_text(F.col("t")),
        rules.whole(F.col("n")), rules.moment(F.col("d")),
    ).collect()
    assert [tuple(r) for r in got] == [
        (Decimal("1200.50"), date(2024, 2, 29), "AB", "ab", 12, datetime(2024, 2, 29)),
        (None, None, None, None, None, None),
        (None, None, "", "", None, None),
        (Decimal("7.00"), date(2024, 1, 5), "C", "c", -4, datetime(2024, 1, 5, 10)),
    ]


def test_blank_arithmetic(frame):
    df = frame([(1, 4.0, 2.0), (2, 4.0, 0.0), (3, 4.0, None), (4, None, 2.0), (5, None, None), (6, None, 0.0)], "i int, a double, b double")
    got = df.orderBy("i").select(
        blank.divide(F.col("a"), F.col("b"), 0), blank.divide(F.col("a"), F.col("b")),
        blank.add(F.col("a"), F.col("b")), blank.subtract(F.col("a"), F.col("b")),
    ).collect()
    assert [tuple(r) for r in got] == [
        (2.0, 2.0, 6.0, 2.0), (0.0, None, 4.0, 4.0), (0.0, None, 4.0, 4.0),
        (None, None, 2.0, -2.0), (0.0, None, None, None), (0.0, None, 0.0, 0.0),
    ]


def test_distinct_counts_null_as_one_value(frame):
    df = frame([("x", 1), ("x", 2), (None, 1), ("y", 3)], "c string, n int")
    row = df.agg(
        F.expr(blank.distinct_sql("c")).alias("a"), F.expr(blank.distinct_sql("c", "n = 1")).alias("b"),
        F.expr(blank.distinct_sql("c", "n > 9")).alias("none"), F.expr(blank.rows_sql("n > 9")).alias("no_rows"),
    ).first()
    assert tuple(row) == (3, 2, None, None)
    empty = df.where("n > 9").agg(F.expr(blank.distinct_sql("c")).alias("a"), F.expr(blank.sum_sql("n")).alias("s")).first()
    assert tuple(empty) == (None, None)


def test_fingerprint_forms(frame):
    df = frame([(1, None, "b"), (2, "NULL", "b"), (3, "x||y", "z"), (4, "x", "y||z")], "i int, p string, q string")
    text = dict(values(df.select("i", fingerprint(["p", "q"], "text"))))
    exact = dict(values(df.select("i", fingerprint(["p", "q"], "json"))))
    assert text[1] == text[2] and text[3] == text[4]
    assert len(set(exact.values())) == 4


def test_bands_and_first_word(frame):
    df = frame([(None,), (7_499_999,), (7_500_000,), (9_900_000,), (15_000_000,)], "x long")
    assert [r[0] for r in df.select(band(F.col("x"))).collect()] == ["Small", "Small", "Medium", "Large", "High Value"]
    words = frame([("  Main  Street ",), ("One",), ("",), (None,)], "w string")
    assert [r[0] for r in words.select(first_word(F.col("w"))).collect()] == ["Main", "One", "", None]
