"""The prefix trie of conversations, by ROLLUP over positional turn-id columns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import gapless, numbered, pick, ship, store, whole

#: Turns in one block of columns.
COLUMNS = 8
#: Blocks of a conversation that one window task orders; longer ones are cut into runs of so many.
RUN = 4_096
#: Conversation ids handed to the hash in one row.
CHUNK = 1_000
#: Parents with a larger share of the nodes hand their id down by broadcast.
SUPPORT = 0.001
#: Turns of another conversation that a rebuilt one can begin with.
HEAD = 6
#: Conversations that begin with the same one.
FAMILY = 100

_TURNS = [f"t{k}" for k in range(1, COLUMNS + 1)]
_KEY = ["depth", "key_a", "key_b"]


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, id, chars``: turns numbered from 0 in their conversation, by turn (null
    first), then role, then the text's digest. ``id`` stands for role and text.

    The table is sorted as a whole, and numbered inside its partitions, so that a
    conversation of any length is spread over tasks. Texts do not leave the map tasks.
    """
    said = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null")
    role, text = whole("role"), whole("text")
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    ids = said.select(
        "conv_id", "turn", role.alias("role"), F.substring(F.unhex(digest), 1, 16).alias("id"), F.length(text).cast("long").alias("chars")
    )
    ordered = ids.orderBy("conv_id", F.asc_nulls_first("turn"), "role", "id").select("conv_id", "id", "chars")
    return gapless(store(numbered(ordered), "turns"), ["conv_id"], "pos").select("conv_id", "pos", "id", "chars")


def head_size(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEAD


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, pos, id, chars`` of the rebuilt conversations, and the list of all
    ``conv_id``, which may have no turns left.

    A conversation c begins with the first h turns of conversation c - c % 100 and goes on
    with its own after its first h; h = crc32(c) % 6.
    """
    rows = store(turns(conversations), "numbered")
    base = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")
    firsts = rows.where(F.col("pos") < HEAD - 1)
    heads = firsts.where(F.col("conv_id") == base).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "id", "chars"))).alias("head")  # five turns at most
    )
    every = firsts.where("pos = 0").select("conv_id", head_size(F.col("conv_id")).alias("h"), base)
    led = store(
        every.join(heads, "base", "left").select(
            "conv_id", "h", F.when(F.col("h") > 0, F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h"))).otherwise(F.array()).alias("head")
        ),
        "led",
    )
    begun = led.select("conv_id", F.explode("head").alias("turn")).select("conv_id", "turn.*")
    # the shift of a conversation's own turns is looked up by runs, so that a long one is not one key
    run = F.floor(F.col("pos") / RUN).alias("run")
    own = rows.select("*", run)
    shifts = own.groupBy("conv_id", "run").agg(F.max("pos").alias("last"))
    shifts = shifts.join(led, "conv_id").where(F.col("last") >= F.col("h")).select("conv_id", "run", "h", (F.size("head") - F.col("h")).alias("shift"))
    kept = own.join(shifts, ["conv_id", "run"]).where(F.col("pos") >= F.col("h"))
    kept = kept.select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "id", "chars")
    return begun.unionByName(kept), led.select("conv_id")


def _mixed(seed: int, depth: Column, turn: str = "id") -> Column:
    return F.xxhash64(depth, turn, F.lit(seed))


def _blocks(spoken: DataFrame, every: DataFrame) -> DataFrame:
    """One row for each ``COLUMNS`` turns of a conversation: ``conv_id, block, prior_a, prior_b,
    before, t1 .. tn, ends``. A turn column holds the turn's id and length, or null.

    The prior node's key is made of two exclusive ors over the hashes of (depth, turn) up
    to it, and ``before`` is the text length up to it: sums that any split of a conversation
    can take in parts. First per block, then over runs of blocks, then inside each run.
    """
    depth = F.col("pos") + 1
    place = F.col("pos") % COLUMNS
    columns = [F.max(F.when(place == k, F.struct("id", "chars"))).alias(t) for k, t in enumerate(_TURNS)]
    blocks = spoken.withColumn("block", F.floor(F.col("pos") / COLUMNS)).groupBy("conv_id", "block").agg(
        F.bit_xor(_mixed(1, depth)).alias("a"), F.bit_xor(_mixed(2, depth)).alias("b"), F.sum("chars").alias("chars"), *columns
    )
    blocks = store(blocks.withColumn("run", F.floor(F.col("block") / RUN)), "blocks")
    runs = blocks.groupBy("conv_id", "run").agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("chars").alias("chars")
    )
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("conv_id").orderBy(F.desc("run"))
    runs = runs.select(
        "conv_id", "run", *(f(c).over(earlier).alias(f"run_{c}") for f, c in ((F.bit_xor, "a"), (F.bit_xor, "b"), (F.sum, "chars"))),
        (F.row_number().over(later) == 1).alias("last_run"),
    )
    inside = Window.partitionBy("conv_id", "run").orderBy("block")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    joined = blocks.join(runs, ["conv_id", "run"])
    linked = joined.select(
        "conv_id", "block", "run",
        *(F.coalesce(f"run_{c}", zero).bitwiseXOR(F.coalesce(F.bit_xor(c).over(before), zero)).alias(f"prior_{c}") for c in "ab"),
        (F.coalesce("run_chars", zero) + F.coalesce(F.sum("chars").over(before), zero)).alias("before"),
        *_TURNS, (F.col("last_run") & F.lead("block").over(inside).isNull()).alias("ends"),
    )
    silent = every.join(blocks.where("block = 0").select("conv_id"), "conv_id", "left_anti")
    filler = {"block": zero, "run": zero, "prior_a": zero, "prior_b": zero, "before": zero, "ends": F.lit(True)}
    kinds = dict(linked.dtypes)
    empty = silent.select("conv_id", *(filler.get(c, F.lit(None).cast(kinds[c])).alias(c) for c in linked.columns[1:]))
    return store(linked.unionByName(empty), "linked")


def _rolled(blocks: DataFrame, measures: str) -> DataFrame:
    """One row for each node: all prefixes of a block's turns are grouped by one ROLLUP below
    the prior node. ``level`` is how many turns of its block a node has; ``conv_id`` is its
    smallest member."""
    columns = ", ".join(_TURNS)
    rolled = blocks.sparkSession.sql(
        f"""select block, prior_a, prior_b, {columns}, min(conv_id) as conv_id, {measures},
                   {COLUMNS} - bit_count(grouping_id(block, prior_a, prior_b, {columns})) as level
            from {{blocks}} group by block, prior_a, prior_b, rollup({columns})""",
        blocks=blocks,
    )
    # a conversation that ends before a level makes no node there; level 0 is the prior node itself
    own_turn = F.when(F.col("level") == 0, F.col("block") == 0)
    for k, t in enumerate(_TURNS, 1):
        own_turn = own_turn.when(F.col("level") == k, F.col(t).isNotNull())
    return rolled.where(own_turn)


def _depth(level: Column) -> Column:
    return (F.col("block") * COLUMNS + level).cast("long")


def _key(upto: Column, name: str = "key") -> list[Column]:
    """A node's key after ``upto`` turns of its block."""
    made = {c: F.col(f"prior_{c}") for c in "ab"}
    for k, t in enumerate(_TURNS, 1):
        there = (F.lit(k) <= upto) & F.col(t).isNotNull()
        for seed, c in enumerate("ab", 1):
            mixed = _mixed(seed, F.col("block") * COLUMNS + k, f"{t}.id")
            made[c] = made[c].bitwiseXOR(F.when(there, mixed).otherwise(F.lit(0).cast("long")))
    return [made[c].alias(f"{name}_{c}") for c in "ab"]


def _spoken(upto: Column) -> Column:
    """Length of the texts up to there."""
    return F.col("before") + sum((F.when(F.lit(k) <= upto, F.coalesce(f"{t}.chars", F.lit(0))).otherwise(0) for k, t in enumerate(_TURNS, 1)), F.lit(0))


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie over all rebuilt conversations (see ``rebuilt``): ``conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    A node is a distinct sequence of first turns, the root the empty one; ``conv_id`` is its
    smallest member. ``saved_tokens`` are the code points that need not be processed again
    if each node of its subtree is processed once.

    Sums over subtrees need no walk: each node belongs to its smallest member, the nodes of one
    conversation are then the tail of its path, and so a subtree's sum is a sum over
    members of what lies before their own tails. A second ROLLUP takes these.

    Null roles and texts are empty. Turns with equal numbers are ordered by role, then by the
    text's digest; repeated rows are turns like any others. Rows without a ``conv_id`` are in no
    conversation. An empty table gives no rows. Keys are 128-bit hashes.
    """
    spoken, every = rebuilt(conversations)
    blocks = _blocks(spoken, every)
    level = F.col("level")
    nodes = store(
        _rolled(blocks, "count(1) as n_convs, max(before) as before").select(
            "conv_id", "n_convs", _depth(level).alias("depth"), *_key(level), *_key(level - 1, "parent"), _spoken(level - 1).alias("before")
        ),
        "nodes",
    )
    above = [(F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("key_a"), F.col("parent_b").alias("key_b")]
    children = nodes.where("depth > 0").groupBy(*above).agg(F.count(F.lit(1)).alias("n_children"))
    counted = store(
        nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "counted"
    )
    own = store(
        counted.groupBy("conv_id").agg(
            F.min_by("before", "depth").alias("own_from"),
            (F.max_by("n_children", "depth") == 0).cast("long").alias("leaf"),
            F.min_by(F.struct("depth", "parent_a", "parent_b"), "depth").alias("top"),
        ),
        "own",
    )
    place = ["conv_id", "depth"]
    found = counted.join(_subtrees(blocks, own), place).join(_parents(counted, own), place, "left").join(_ends(blocks), _KEY, "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select(
        "conv_id", "depth", parent, "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")
    )


def _subtrees(blocks: DataFrame, own: DataFrame) -> DataFrame:
    """``conv_id, depth, n_leaves, saved_tokens``. A conversation adds to each node on its path the
    length of its texts from there to where its own nodes begin, or all if it has none,
    and a leaf if its path ends in one of its own."""
    whole_length = blocks.where("ends").select("conv_id", _spoken(F.lit(COLUMNS)).alias("length"))
    tails = whole_length.join(own, "conv_id", "left").select("conv_id", F.coalesce("own_from", "length").alias("own_from"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    tails = blocks.select("conv_id", "run").distinct().join(tails, "conv_id")  # a long conversation is not one key
    adds = [F.greatest(F.lit(0), F.col("own_from") - _spoken(F.lit(k - 1))).alias(f"s{k}") for k in range(COLUMNS + 1)]
    rows = blocks.join(tails, ["conv_id", "run"]).select("conv_id", "block", "prior_a", "prior_b", *_TURNS, "leaf", *adds)
    rolled = _rolled(rows, "sum(leaf) as n_leaves, " + ", ".join(f"sum(s{k}) as s{k}" for k in range(COLUMNS + 1)))
    saved = F.get(F.array(*(f"s{k}" for k in range(COLUMNS + 1))), F.col("level"))
    return rolled.select("conv_id", _depth(F.col("level")).alias("depth"), "n_leaves", saved.alias("saved_tokens"))


def _parents(counted: DataFrame, own: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id`` of the nodes whose parent has a smaller member than
    they have. Parents with very many children are broadcast, 1 / ``SUPPORT`` at most."""
    tops = own.where("top.depth > 0").select(
        "conv_id", (F.col("top.depth") - 1).alias("depth"), F.col("top.parent_a").alias("key_a"), F.col("top.parent_b").alias("key_b")
    )
    named = counted.select(*_KEY, F.col("conv_id").alias("parent_conv_id"), (F.col("n_children") > SUPPORT * counted.count()).alias("hot"))
    few = store(named.where("hot").drop("hot"), "hot")
    near = tops.join(F.broadcast(few), _KEY)
    far = tops.join(F.broadcast(few.select(*_KEY)), _KEY, "left_anti").join(named.where("not hot").drop("hot"), _KEY)
    found = near.unionByName(far).select("conv_id", (F.col("depth") + 1).alias("depth"), "parent_conv_id")
    return found.repartition("conv_id", "depth")  # dealt evenly, whatever the scans of the two were


def _ends(blocks: DataFrame) -> DataFrame:
    """``depth, key_a, key_b, ends_sha256``: the hash of the ids that end at a node, in order.

    Ids come in rows of ``CHUNK`` at most, sorted inside by Spark. One hash has to see all ids
    of its node in turn, so these rows go through one task, which holds one at a time."""
    ship(blocks.sparkSession)
    turns_there = sum((F.col(t).isNotNull().cast("long") for t in _TURNS), F.lit(0).cast("long"))
    ended = blocks.where("ends").select("conv_id", _depth(turns_there).alias("depth"), *_key(F.lit(COLUMNS)))
    chunk = F.floor(F.col("conv_id") / CHUNK).alias("chunk")
    lists = ended.groupBy(*_KEY, chunk).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    joined = lists.select(*_KEY, "chunk", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    ordered = joined.repartition(*_KEY).sortWithinPartitions(*_KEY, "chunk").drop("chunk")

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for frame in frames:
            done = []
            for *key, ids in frame.itertuples(index=False):
                if key == now:
                    state.update(b"," + ids.encode())
                    continue
                if now:
                    done.append((*now, state.hexdigest()))
                now, state = key, hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=[*_KEY, "ends_sha256"])
        if now:
            yield pd.DataFrame([(*now, state.hexdigest())], columns=[*_KEY, "ends_sha256"])

    return ordered.mapInPandas(hashed, "depth long, key_a long, key_b long, ends_sha256 string")
