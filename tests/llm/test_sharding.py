import zlib
from collections import defaultdict

import xxhash

from lakemart.llm import sharding


def long_hash(n, seed=42):
    value = xxhash.xxh64(n.to_bytes(8, "little", signed=True), seed=seed).intdigest()
    return value


def text_hash(text, seed=42):
    return xxhash.xxh64(text.encode(), seed=seed).intdigest()


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def brute(doc_id, tree):
    """Descends with the same draws, in plain Python."""
    import math

    key = signed(text_hash(str(doc_id)))
    leaves, depth = list(tree), 0
    for level in (lambda x: x.region, lambda x: x.rack, lambda x: f"s{x.shard}"):
        weights = defaultdict(float)
        for leaf in leaves:
            weights[level(leaf)] += leaf.weight
        def draw(node):
            u = ((text_hash(node, long_hash(key)) >> 11) + 0.5) / 2.0**53
            return -math.log(u) / weights[node], node
        chosen = min(draw(n) for n in weights if weights[n])[1]
        leaves, depth = [x for x in leaves if level(x) == chosen], depth + 1
    return leaves[0].shard


def test_against_brute_force(stored):
    rows = [(i, f"text {i % 7} é") for i in range(400)] + [(-5, None), (2**62, "")]
    tree = sharding.even_tree(2, 2, 4)
    more = sharding.grown(tree)
    got = sharding.shard_documents(stored(rows), tree, more).collect()
    texts = dict(rows)
    for r in got:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.shard == brute(r.doc_id, tree) and r.grown_shard == brute(r.doc_id, more)
        assert r.grown_shard in (r.shard, 16)
    assert len({r.shard for r in got}) == 16 and any(r.grown_shard == 16 for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weights_move_only_into_changed_subtrees(spark):
    tree = sharding.even_tree(2, 2, 2)
    heavier = [x if x.shard != 5 else sharding.Leaf(x.region, x.rack, 5, 3.0) for x in tree]
    df = spark.range(4000).withColumnRenamed("id", "key")
    both = sharding.place(sharding.place(df, tree, "key"), heavier, "key", "after").collect()
    region = {x.shard: x.region for x in tree}
    rack = {x.shard: x.rack for x in tree}
    for r in both:
        if r.after != r.shard:  # into the grown region, or the grown rack of it, or the shard
            same_region, same_rack = region[r.after] == region[r.shard], rack[r.after] == rack[r.shard]
            assert region[r.after] == "r1"
            assert not same_region or rack[r.after] == "r1/k0"
            assert not same_rack or r.after == 5
    assert sum(r.after == 5 for r in both) > 1.5 * sum(r.shard == 5 for r in both)


def test_hot_and_odd_rows(stored, documents):
    tree = sharding.even_tree(1, 1, 2)
    rows = [(7, "same")] * 300 + [(None, "a"), (None, None), (1, "")]
    got = sharding.shard_documents(stored(rows, 4), tree, sharding.grown(tree)).collect()
    assert len(got) == 303
    for s in (0, 1):
        mine = sorted(r.slot for r in got if r.shard == s)
        assert mine == list(range(len(mine)))
    assert len({r.shard for r in got if r.doc_id == 7}) == 1
    assert sharding.shard_documents(documents([]), tree, tree).count() == 0
