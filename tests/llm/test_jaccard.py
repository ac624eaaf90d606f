import random
import re

import numpy as np
import pytest

from lakemart.llm import jaccard


def brute(rows, width=5, percent=75):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                group[root(i)] = root(j)
    least = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, *_) in enumerate(rows)), key=repr)


def check(df, rows):
    got = jaccard.near_duplicates(df).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows)


def words(rng, n):
    return [f"w{rng.randint(0, 5000)}" for _ in range(n)]


def edited(rng, base, changes):
    out = list(base)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"z{rng.randint(0, 10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("entries,rounds", [(10**9, 1), (0, 1), (0, 12), (5000, 12)])
def test_near_copies_passages_and_copies(stored, monkeypatch, entries, rounds):
    """In blocks, by pivots, and some clusters each way."""
    monkeypatch.setattr(jaccard, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    rng = random.Random(11)
    base, passage = words(rng, 120), " ".join(words(rng, 60))
    texts = [" ".join(base)] * 40 + [edited(rng, base, rng.randint(1, 9)) for _ in range(80)]
    texts += [" ".join(words(rng, 90)) + " " + passage for _ in range(40)] + [passage, passage.upper(), passage + " tail"]
    chain = words(rng, 200)
    texts += [" ".join(chain[i : i + 150]) for i in range(0, 50, 10)]
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    check(stored(rows, 4), rows)


def test_blocks_against_all_pairs():
    rng = np.random.default_rng(5)
    for _ in range(80):
        base = [set(rng.integers(0, 60, size=rng.integers(1, 30)).tolist()) for _ in range(6)]
        sets = [set(b) for b in base]
        for b in base:
            for _ in range(rng.integers(0, 6)):
                sets.append({x if rng.random() < 0.93 else int(rng.integers(0, 60)) for x in b})
        extra = rng.integers(0, 3, size=len(sets))  # shingles of no other row
        n = np.array([len(s) for s in sets]) + extra
        got = jaccard.block_groups(n, [np.array(sorted(s)) for s in sets], 75)
        want = list(range(len(sets)))
        for _ in sets:
            for i in range(len(sets)):
                for j in range(len(sets)):
                    both = len(sets[i] & sets[j])
                    if 100 * both >= 75 * (n[i] + n[j] - both):
                        want[i] = want[j] = min(want[i], want[j])
        assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(len(sets)) for j in range(len(sets)))


def test_odd_rows(stored, documents):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "a b c d"), (8, "a  b\nc d"), (9, "a b c d e"),
        (9, "a b c d e"), (None, "A b c d e"), (None, "alone in the whole world now"), (None, ""), (10, "x " * 3000), (11, "x " * 4000), (12, "É b c d e"),
        (13, "é b c d e"),
    ]
    check(stored(rows), rows)
    assert jaccard.near_duplicates(documents([])).count() == 0


def test_small_sets_at_the_bound(stored):
    texts = [" ".join("abcdefghijklmnop"[:n]) for n in range(4, 17)] + [" ".join("abcdefgxyz"), " ".join("qbcdefghijklm")]
    rows = list(enumerate(texts))
    check(stored(rows), rows)


def test_drop_keeps_one_of_each(spark, tmp_path):
    rows = [(1, "a b c d e f", 5, "x"), (2, "A b c d e f", 6, "y"), (3, None, 7, "z"), (4, "", 8, "q"), (2, "a b c d e f", 9, "r"), (None, "a b c d e f", 0, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row long, component_id string")
    df.write.parquet(str(tmp_path / "d"))
    got = jaccard.drop_near_duplicates(spark.read.parquet(str(tmp_path / "d")))
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a b c d e f", 5, "x"), (3, None, 7, "z"), (4, "", 8, "q")]


def test_scan_split_anew_between_steps(stored, replanned):
    words = [f"w{i}" for i in range(60)]
    rng = random.Random(5)
    texts = [" ".join(rng.choices(words, k=20 + i % 9)) for i in range(60)]
    rows = list(enumerate(texts + [t + " more" for t in texts[:25]] + texts[30:40]))
    docs = stored(rows, parts=6)
    replanned(jaccard)
    check(docs, rows)


@pytest.mark.parametrize("part,share", [(16, 0.01), (1, 0), (1, 0.4)])
def test_entries_are_shuffled_once_for_the_count_of_their_column(stored, spark, monkeypatch, part, share):
    """Whichever columns count as those of many rows: none, all, or some."""
    monkeypatch.setattr(jaccard, "PART", part)
    monkeypatch.setattr(jaccard, "HOT_COLUMN", share)
    put, plans = jaccard.store, {}

    def store(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return put(df, name)

    monkeypatch.setattr(jaccard, "store", store)
    rng = random.Random(2)
    base = words(rng, 60)
    rows = list(enumerate([edited(rng, base, i % 3) for i in range(12)] + [" ".join(words(rng, 30)) for _ in range(6)]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check(stored(rows), rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [plans[name].count("Exchange hashpartitioning(gram") for name in ("able", "ranked")] == [1, 1]
