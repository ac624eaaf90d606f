import hashlib
from collections import defaultdict

from lakemart.llm import dedup

ROWS = [(1, "Ab c"), (2, "aB C"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "ab c"), (7, "ab c"), (None, "ab c"), (None, "only"), (9, "x" * 50_000)]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[lower(t)].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        for i in ids:
            out.append((i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(frame, rows, support):
    got = dedup.exact_groups(frame, support=support).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_groups_by_both_ways(stored):
    check(stored(ROWS), ROWS, 0.3)   # one group is frequent
    check(stored(ROWS), ROWS, 0.99)  # none is
    check(stored(ROWS), ROWS, 0.01)  # all are


def test_hot_group(stored):
    rows = [(i, "Hot text" if i % 3 == 0 else f"t{i // 2}") for i in range(3000)]
    check(stored(rows, 5), rows, 0.001)


def test_empty_table(documents):
    assert dedup.exact_groups(documents([])).count() == 0
    assert dedup.drop_copies(documents([])).count() == 0


def test_drop_copies_keeps_columns(spark):
    rows = [(1, "a", 10, True), (2, "A", 20, False), (2, "A", 20, False), (3, None, 30, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row long, kept boolean")
    got = dedup.drop_copies(df)
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == [(2, "A", 20, False), (3, None, 30, None)]
