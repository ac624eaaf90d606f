import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lakemart.llm import spelling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def brute(rows):
    n = Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    words = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    others = {w: [v for v in words if near(w, v)] for w in words}
    best = {w: min(o, key=lambda v: (-words[v], v)) for w, o in others.items() if o}
    form = {w: best[w] for w in best if words[best[w]] >= 2 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), k, len(others[w]), words.get(form.get(w))) for w, k in words.items()) if words else []


def check(df, rows):
    got = spelling.variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == brute(rows)


def corpus(seed, n):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcdeéÿ", k=rng.randint(4, 7))) for _ in range(25)]
    vocabulary = list(stems)
    for s in stems * 3:
        i = rng.randrange(len(s))
        vocabulary.append(rng.choice([s[:i] + s[i + 1 :], s[:i] + rng.choice("abcé") + s[i:], s[:i] + rng.choice("abcé") + s[i + 1 :]]))
    weights = [1 / (1 + i) for i in range(len(vocabulary))]
    return [(i, rng.choice([" ", "-", "1", "\n"]).join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(vocabulary, weights, k=60))) for i in range(n)]


@pytest.mark.parametrize("block", [2048, 3])
def test_against_all_pairs(stored, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    rows = corpus(7, 40)
    check(stored(rows), rows)


def test_odd_rows(stored, documents):
    rows = [
        (1, None), (2, ""), (3, "  .,1"), (None, "Hallo hallo HALLO hallx hallx hallx"), (None, "Hallo hallo hallo hallo"), (4, "Éclair éclair éclair Éclair Éclair"),
        (5, "eclairÿ " * 4), (5, "eclairÿ " * 4), (6, "漢字abcde字abcde abcde"), (7, "x" * 5000 + " " + "x" * 5000 + " " + "x" * 5000 + " " + ("x" * 4999 + " ") * 7), (8, "abcd abcd abcd abcd"),
    ]
    check(stored(rows), rows)
    assert spelling.variants(documents([])).count() == 0


def test_extra_columns_that_clash(spark):
    rows = [(i, "great grear great great grear great", "w", 5, "r") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n long, root string")
    check(df, rows)


def test_ties_chains_and_doubling(spark, stored):
    words = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "caaaa": 6, "zzzzz": 5, "zzzzy": 9}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: (r.n_near, r.best_n, r.best) for r in spelling.near_words(df).collect()}
    assert got["aaaaa"] == (2, 6, "aaaab") and got["zzzzz"] == (1, 9, "zzzzy") and got["bbbbb"] == (1, 48, "abbbb")
    rows = [(None, " ".join(w for w, n in words.items() for _ in range(n)))]
    check(stored(rows), rows)
    assert {r.word: r.root for r in spelling.variants(stored(rows)).collect()}["aaaaa"] == "bbbbb"


def test_pairs_of_blocks():
    rng = random.Random(1)
    for length in (1, 2, 5, 9):
        a = sorted({"".join(rng.choices("abÿ", k=length)) for _ in range(30)})
        for more in (0, 1):
            b = sorted({"".join(rng.choices("abÿ", k=length + more)) for _ in range(30)})
            first, second = spelling.near_pairs(a, b)
            got = sorted((a[i], b[j]) for i, j in zip(first, second, strict=True))
            assert got == sorted((x, y) for x in a for y in b if near(x, y))
    assert np.array_equal(spelling._letters(["abba"])[1][0, [97, 98, 99]], [2, 2, 0])
