import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from lakemart.llm import prefixes


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own[c].append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(r, t) for *_, r, _, t in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        made[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in sorted(made.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for key in members:
        if key:
            children[key[:-1]] += 1
    for key, m in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += children[key] == 0
            saved[key[:d]] += (len(m) - 1) * len(key[-1][1]) if key else 0
    return sorted(
        (
            m[0], len(key), members[key[:-1]][0] if key else None, len(m), children[key], leaves[key], saved[key],
            hashlib.sha256(",".join(str(c) for c in m if len(made[c]) == len(key)).encode()).hexdigest(),
        )
        for key, m in members.items()
    )


def check(spark, rows, parts=4):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
    got = prefixes.trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def talk(seed, convs, words=2, longest=8):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice("ua"), rng.choice(["hi", "héllo", "", "x"][: words + 1])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("columns,run,chunk,support", [(8, 4096, 1000, 0.001), (2, 2, 3, 0.02), (1, 1, 1, 1.0)])
def test_against_plain_python(spark, monkeypatch, columns, run, chunk, support):
    """In one block of columns, and in many whose runs and lists are cut."""
    for name, value in (("COLUMNS", columns), ("RUN", run), ("CHUNK", chunk), ("SUPPORT", support), ("_TURNS", [f"t{k}" for k in range(1, columns + 1)])):
        monkeypatch.setattr(prefixes, name, value)
    check(spark, talk(3, [*range(0, 40), *range(95, 130), 305], longest=11))


def test_odd_rows(spark):
    rows = [
        (7, None, None, None), (7, None, "u", "b"), (7, 1, "u", "b"), (7, 1, "u", "b"), (7, 1, "a", "c"), (None, 0, "u", "lost"), (8, 5, "", ""),
        (100, 0, "u", "b"), (-3, 0, "u", "neg"), (-3, 1, "u", "neg"), (-100, 2, "u", "base"), (12345, 0, "u", "x" * 30000),
        *((230, t, "u", f"turn {t % 3}") for t in range(60)), *((231, t, "u", f"turn {t % 3}") for t in range(61)),
    ]
    check(spark, rows)
    for c in range(50):  # conversations of which nothing is left, alone and beside others
        if zlib.crc32(str(c + 1).encode()) % 6 > 1:
            check(spark, [(c + 1, 0, "u", "gone")])
            break


def test_empty_table_and_clashing_columns(spark):
    schema = "conv_id long, turn long, role string, text string, pos long, id string, block int, depth string"
    assert prefixes.trie(spark.createDataFrame([], schema)).count() == 0
    rows = talk(5, range(6))
    wide = spark.createDataFrame([(*r, 1, "i", 2, "d") for r in rows], schema)
    assert sorted(map(tuple, prefixes.trie(wide).collect())) == brute(rows)


def test_scan_split_anew_between_steps(spark, replanned, tmp_path):
    rows = talk(9, range(30))
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).write.parquet(str(tmp_path / "c"))
    replanned(prefixes)
    assert sorted(map(tuple, prefixes.trie(spark.read.parquet(str(tmp_path / "c"))).collect())) == brute(rows)
