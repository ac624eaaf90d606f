import math
import re
from collections import Counter

import pytest

from lakemart.llm import quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORDS.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def js(p, q):
    p, q = ([x / sum(v) for x in v] for v in (p, q))
    return math.sqrt(max(0, sum((a and a * math.log2(a / ((a + b) / 2))) / 2 + (b and b * math.log2(b / ((a + b) / 2))) / 2 for a, b in zip(p, q, strict=True))))


def histograms(text, lang):
    words = WORDS.findall(text)
    upper, digits = len(re.findall("[A-Z]", text)), len(re.findall("[0-9]", text))
    points, symbols = len(re.findall(r"""[.,;:!?'"()-]""", text)), len(re.findall(r"[#*$%&|<>]", text))
    wide, spaces = sum(ord(c) > 127 for c in text), len(text) - sum(map(len, words))
    classes = [upper, digits, points, symbols, wide, spaces, len(text) - upper - digits - points - symbols - wide - spaces]
    clean = [w.rstrip(".,;:!?").lower() for w in words]
    own = [clean.count(w) for w in quality.COMMON_WORDS[lang]]
    return classes, own + [len(words) - sum(own)]


FILLER = [f"the cat{i} of a dog{i} and it was in the wood{i}" for i in range(40)]
PLAIN = "\n".join(FILLER[:10]) + "."
ROWS = [
    (1, PLAIN, "en"), (2, "\n".join(FILLER[10:20]), "en"), (3, PLAIN.upper() + "!!", "en"), (4, " ".join(w + "***" for w in PLAIN.split()), "en"),
    (5, "a b c " * 40, "en"), (6, "same line\nsame line\n\n\nsame line\r\n \n \n", "en"), (7, None, "en"), (8, "", None), (9, "short", "xx"),
    (10, "\n".join(FILLER[20:30]), None), (10, "\n".join(FILLER[20:30]), None), (None, "\n".join(FILLER[30:]), "en"), (11, "x1 y2 z3 " * 20_000, "en"), (12, "a a a a", "fr"),
    (13, "\n".join(FILLER[5:16]) + " É é", "en"),
]


def test_base_counts_and_verdicts(stored):
    got = quality.judged(stored(ROWS)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(((r.doc_id, *(r[n] for n in names)) for r in got), key=repr) == sorted(((i, *base(t)) for i, t, _ in ROWS), key=repr)
    texts = [t for i, t, _ in ROWS if not base(t)[-1]]  # all of these are spoken in English

    def summed(some):
        return [[sum(x) for x in zip(*column, strict=True)] for column in zip(*(histograms(t, "en") for t in some), strict=True)]

    def distances(text, sums):
        return [js(h, s) if n >= least else 0.0 for h, s, n, least in zip(
            histograms(text, "en"), sums, (len(text), base(text)[0]), (quality.MIN_CHARS, quality.MIN_WORDS), strict=True)]

    def usual(text, sums):
        c, w = distances(text, sums)
        return c <= quality.MAX_CLASS_DISTANCE and w <= quality.MAX_WORD_DISTANCE

    first = summed(texts)
    sums = summed([t for t in texts if usual(t, first)])
    for r in got:
        text = next(t for i, t, _ in ROWS if i == r.doc_id)
        if r.base_failed:
            assert not r.kept
            continue
        assert [r.class_distance, r.word_distance] == pytest.approx(distances(text, sums), abs=1e-9)
        assert r.kept == usual(text, sums)
    assert {r.doc_id for r in got if not r.kept and not r.base_failed} >= {3, 4}


def test_empty_and_clashing(documents, spark):
    assert quality.judged(documents([])).count() == 0
    df = spark.createDataFrame([(1, PLAIN, "en", True, 3)], "doc_id long, text string, lang string, kept boolean, words int")
    assert [r.kept for r in quality.judged(df).collect()] == [True]
