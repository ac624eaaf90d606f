"""Near duplicates: an exact Jaccard join of word shingles as a blocked sparse product.

Documents are the rows and shingles the columns of a 0/1 matrix A; the overlaps of all
pairs are the entries of A times its transpose. The product is taken block by block, and
what cannot reach the similarity is discarded by bounds that follow from the sizes:

1. Texts of one word sequence are one row. A large group's copies leave in the map tasks.
2. A block of columns (a fixed part of the hash range) is counted first. A row of size n
   that links with anything shares at least ``need(n)`` = ceil(t * n) shingles, hence at
   least ``in block - (n - need(n))`` of those in the block. Most rows end here.
3. The other rows are multiplied over all columns. Those with fewer than ``need(n)`` shared
   columns end here. Two linked rows meet in the ``n - need(n) + 1`` rarest columns of
   each, so only these make candidates.
4. Rows that meet in such a column, directly or through others, are a cluster: a block of the
   matrix that one task multiplies. It walks along links and multiplies each row it reaches
   with the rows not reached so far, so that a group of near copies costs little more
   than one product of a row with all.
5. A cluster with too many entries for a task is taken by pivots: each column sends its rows to
   one row, overlaps are counted exactly, and rows linked with the same pivot need no
   product with each other. After some rounds, all pairs that are left are taken.

No candidate is dropped but by a bound, so every link of two groups is found.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, pick, ship, store, uncased, whole

#: Part of the hash range that the first block of columns covers.
FIRST_BLOCK = 0.35
#: Word sequences with a larger share of the rows lose their copies before any shuffle.
SUPPORT = 0.001
#: A list of rows up to this size (8 bytes each) is broadcast; a longer one is shuffled.
BROADCAST_ROWS = 1_000_000
#: Columns that a larger share of the rows has are dealt by row; one of so many rows is looked at to find them.
HOT_COLUMN = 0.01
PART = 16
#: Entries of the matrix in one block (8 bytes each); larger clusters are taken by pivots.
BLOCK_ENTRIES = 8_000_000
#: Rows of one pivot in a block of the product.
PIVOT_ROWS = 1_000
#: Rounds of pivots, at most, before all pairs that are left are taken.
ROUNDS = 12


def words_of(text: str) -> Column:
    return F.regexp_extract_all(uncased(whole(text)), F.lit(WORD), 0)


def _with_shingles(rows: DataFrame, width: int) -> DataFrame:
    """Adds ``sequence`` (a digest of the word sequence) and ``grams``, the hashes of the
    distinct shingles; fewer words than ``width`` make one shingle, no words none."""
    hashed = rows.withColumn("words", words_of("text")).withColumn(
        "hashes", F.transform("words", lambda w: F.xxhash64(w))
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.size("hashes") - width),
        lambda i: F.xxhash64(*(F.get(F.col("hashes"), i + k) for k in range(width))),
    )
    grams = (
        F.when(F.size("hashes") >= width, F.array_distinct(windows))
        .when(F.size("hashes") > 0, F.array(F.xxhash64(F.lit("short"), F.array_join("words", " "))))
        .otherwise(F.array().cast("array<long>"))
    )
    return hashed.select("row", "doc_id", F.sha2(F.array_join("words", " "), 256).alias("sequence"), grams.alias("grams"))


def _need(n: Column, percent: int) -> Column:
    """ceil(t * n)"""
    return F.floor((n * percent + 99) / 100)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id, row`` for every row.

    Words are cut at white space after lower-casing A-Z; a set holds a text's distinct
    runs of ``width`` words, or its whole sequence if it has fewer. Two rows link when
    100 * intersection >= ``percent`` * union, and a component is what links
    reach; ``component_id`` is its smallest id. Null and empty texts have an empty set,
    link with nothing and are their own component. Repeated rows are exact
    copies of each other; a null id takes part but is never the smallest. Shingles are
    64-bit hashes. ``docs`` is read once; later steps read its numbered rows as stored,
    since a scan can be split in another way, and so numbered anew, each time.
    """
    source = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    return _components(store(source, "documents"), width, percent).drop("component")


def _components(source: DataFrame, width: int, percent: int) -> DataFrame:
    """For ``row, doc_id, text``, whose row numbers are the same at each read. Each text is hashed
    once, and the hashes of the first block of columns are stored, as they are read twice.
    Those of the other columns, twice as many, are made again for the few rows that need them."""
    limit = int(FIRST_BLOCK * 2**64) - 2**63
    hashed = store(
        _with_shingles(source, width).select(
            "row", "doc_id", "sequence", F.size("grams").alias("n"),
            F.filter("grams", lambda g: g < limit).alias("first"),
        ),
        "shingles",
    )
    sized = hashed.select("row", "doc_id", "sequence", "n")
    classes = store(
        hashed.where("n > 0").groupBy("sequence").agg(
            F.min("row").alias("node"), F.min("doc_id").alias("least"), F.first("n").alias("n"),
            F.first(F.size("first")).alias("n_block"), F.count(F.lit(1)).alias("copies"),
        ),
        "classes",
    )
    large = classes.where(F.col("copies") > SUPPORT * hashed.count()).select("sequence", "node")  # 1 / SUPPORT rows at most
    ranked = _ranked(_survivors(source, hashed, classes, large, width, percent), percent)
    return _labelled(sized, classes, large, _groups(ranked, percent))


def _common(entries: DataFrame, row: str) -> DataFrame:
    """The entries whose column other rows have too, with that number of rows (``df``; where many
    rows have it, about, and the same for all of its entries).

    Entries are counted along a window, so they are shuffled once; counts that are joined to them
    would send each entry a second time. Columns that many rows have are found in a part of
    the rows. They need no count, so their entries are dealt by row and no task gets all of one.
    """
    part = entries.where(F.pmod(F.xxhash64(row), F.lit(PART)) == 0)
    least = max(1, HOT_COLUMN * part.select(row).distinct().count())
    seen = part.groupBy("gram").agg(F.count(F.lit(1)).alias("seen"))
    # entries of a row / HOT_COLUMN, on average at most
    wide = store(seen.where(F.col("seen") > least).select("gram", (F.col("seen") * PART).alias("about")), "wide")
    dealt = Window.partitionBy("gram", F.when(F.col("about").isNotNull(), F.col(row)))
    df = F.coalesce("about", F.count(F.lit(1)).over(dealt))
    return entries.join(F.broadcast(wide), "gram", "left").withColumn("df", df).where("df > 1").drop("about")


def _survivors(source: DataFrame, hashed: DataFrame, classes: DataFrame, large: DataFrame, width: int, percent: int) -> DataFrame:
    """``node, n, grams`` of the rows that the first block of columns cannot rule out."""
    made = hashed.select("row", "sequence", "first").join(F.broadcast(large), "sequence", "left")
    block = made.where(F.col("node").isNull() | (F.col("node") == F.col("row"))).select("row", F.explode("first").alias("gram"))
    shared = _common(block, "row").groupBy("row").agg(F.count(F.lit(1)).alias("shared"))
    able = store(
        classes.join(shared.withColumnRenamed("row", "node"), "node", "left")
        .where(F.coalesce("shared", F.lit(0)) >= F.col("n_block") - (F.col("n") - _need(F.col("n"), percent)))
        .select("node"),
        "able",
    )
    few = able.count() <= BROADCAST_ROWS
    able = able.withColumnRenamed("node", "row")
    again = _with_shingles(source.join(F.broadcast(able) if few else able, "row"), width)
    return store(again.select(F.col("row").alias("node"), F.size("grams").alias("n"), "grams"), "survivors")


def _ranked(rows: DataFrame, percent: int) -> DataFrame:
    """``node, n, shared, prefix``: the shingles that other rows have too, the rarest first, and
    how many of them make candidates. Rows with too few of them are ruled out."""
    entries = rows.select("node", "n", F.explode("grams").alias("gram"))
    common = _common(entries, "node")
    rarest = F.sort_array(F.collect_list(F.struct("df", "gram")))  # a document's own shingles
    need = _need(F.col("n"), percent)
    return store(
        common.groupBy("node", "n").agg(rarest.alias("ranked"))
        .where(F.size("ranked") >= need)
        # shingles of no other row are rarer still, and take their part of the prefix
        .select("node", "n", F.transform("ranked", lambda r: r["gram"]).alias("shared"), (F.size("ranked") - need + 1).cast("int").alias("prefix")),
        "ranked",
    )


def _groups(ranked: DataFrame, percent: int) -> DataFrame:
    """``node, label``: rows that links hold together have one label.

    Rows that meet in a column of their prefixes are one cluster; linked rows are in one
    cluster. A cluster is one block of the product, unless it is too large for a task.
    """
    ship(ranked.sparkSession)
    index = ranked.select("node", "n", F.explode(F.slice("shared", F.lit(1), F.col("prefix"))).alias("gram"))
    firsts = index.groupBy("gram").agg(F.min("node").alias("b"))
    stars = index.join(firsts, "gram").where("node != b").select(F.col("node").alias("a"), "b").distinct()
    clusters = components(store(stars, "stars")).toDF("node", "cluster")
    members = store(ranked.join(clusters, "node"), "members")
    weight = members.groupBy("cluster").agg(F.sum(F.size("shared")).alias("entries"))
    over = store(weight.where(F.col("entries") > BLOCK_ENTRIES).select("cluster"), "over")  # all entries / BLOCK_ENTRIES rows at most
    small = members.join(F.broadcast(over), "cluster", "left_anti")

    def product(frame: pd.DataFrame) -> pd.DataFrame:
        labels = block_groups(frame["n"].to_numpy(np.int64), frame["shared"].tolist(), percent)
        nodes = frame["node"].to_numpy(np.int64)
        return pd.DataFrame({"node": nodes, "label": nodes[labels]})

    groups = small.groupBy("cluster").applyInPandas(product, "node long, label long")
    if over.isEmpty():
        return store(groups, "groups")
    large = members.join(F.broadcast(over), "cluster", "left_semi")
    pieces = index.join(large.select("node"), "node", "left_semi")
    links = _links(store(pieces, "index"), large.select("node", "n", F.col("shared").alias("grams")), percent)
    return store(groups.unionByName(components(links)), "groups")


def block_groups(n: np.ndarray, columns: list[np.ndarray], percent: int) -> np.ndarray:
    """For each row of a block, the number of a row that stands for its group.

    Walks along links: a row is multiplied with the rows that no link has reached yet, and
    those it links with are next. Only sizes that allow the similarity are multiplied,
    and in a group of near copies the first few rows reach nearly all others.
    """
    order = np.argsort(n, kind="stable")
    n, columns = n[order], [columns[i] for i in order]
    lengths = np.array([len(c) for c in columns])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    entries = np.unique(np.concatenate(columns), return_inverse=True)[1]
    mark = np.zeros(entries.max() + 1, dtype=np.int32)
    label = np.full(len(n), -1)
    # what is not reached, by size: rows, their sizes, where their entries start, entries
    free, free_n, free_starts, free_entries = np.arange(len(n)), n, starts[:-1], entries
    reached = 0
    for seed in range(len(n)):
        if label[seed] >= 0:
            continue
        label[seed] = seed
        reached += 1
        queue = [seed]
        while queue:
            row = queue.pop()
            low, high = np.searchsorted(free_n, -(-n[row] * percent // 100)), np.searchsorted(free_n, n[row] * 100 // percent, side="right")
            if low < high:
                begin = free_starts[low]
                end = free_starts[high] if high < len(free) else len(free_entries)
                own = entries[starts[row] : starts[row + 1]]
                mark[own] = 1
                overlap = np.add.reduceat(mark[free_entries[begin:end]], free_starts[low:high] - begin)
                mark[own] = 0
                linked = 100 * overlap >= percent * (n[row] + free_n[low:high] - overlap)
                found = free[low:high][linked]
                found = found[label[found] < 0]
                label[found] = seed
                reached += len(found)
                queue += found.tolist()
            if 2 * (len(n) - reached) < len(free):
                keep = label[free] < 0
                free_entries = free_entries[np.repeat(keep, lengths[free])]
                free = free[keep]
                free_n = n[free]
                free_starts = np.cumsum(lengths[free]) - lengths[free]
    out = np.empty(len(n), dtype=np.int64)
    out[order] = order[label]
    return out


def _links(index: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """``a, b``: enough links between the rows of large clusters for every group to hold together."""
    labels = store(grams.select("node").withColumn("label", F.col("node")), "labels")
    found, left = [], float("inf")
    nodes = labels.count()
    for turn in range(ROUNDS):
        current = index.join(labels, "node")
        pivot = F.min(F.struct((F.xxhash64("node", F.lit(turn)) if turn else F.col("node")).alias("order"), "node", "n", "label"))
        pivots = current.groupBy("gram").agg(pivot.alias("pivot"))
        pairs = (
            current.join(pivots, "gram")
            .where((F.col("label") != F.col("pivot.label")) & _alike(F.col("n"), F.col("pivot.n"), percent))
            .select(F.col("node").alias("a"), F.col("pivot.node").alias("b")).distinct()
        )
        found.append(store(_linked(pairs, grams, percent), f"links-{turn}"))
        labels = store(_joined(labels, found[-1]), "labels")
        before, left = left, _pairs_left(index.join(labels, "node"))
        if left <= nodes or left > 0.9 * before:
            break
    found.append(store(_linked(_all_left(index.join(labels, "node"), percent), grams, percent), "links-last"))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def _alike(n: Column, m: Column, percent: int) -> Column:
    """Sizes that allow the similarity."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _linked(pairs: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """The pairs that link, by their exact overlap. Many rows can have one pivot, which is
    handed out in slices so that its rows spread over tasks."""
    pairs = store(pairs, "pairs")
    per_pivot = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PIVOT_ROWS).alias("slices"))
    sliced = pairs.join(per_pivot, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("slices")).alias("slice"))
    left = sliced.join(grams.toDF("a", "n_a", "grams_a"), "a")
    right = per_pivot.join(grams.toDF("b", "n_b", "grams_b"), "b").withColumn(
        "slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))
    )
    overlap = F.size(F.array_intersect("grams_a", "grams_b"))
    counted = left.join(right, ["b", "slice"]).select("a", "b", "n_a", "n_b", overlap.alias("overlap"))
    return counted.where(F.col("overlap") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * percent).select("a", "b")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after links: each row takes the smallest label next to it, which is then
    looked up once more. Equal labels mean connected; not always the other way round."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("next")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("next"))
    )
    near = both.join(labels.toDF("next", "other"), "next").groupBy("node").agg(F.min("other").alias("other"))
    stepped = labels.join(near, "node", "left").select("node", "label", F.least("label", "other").alias("step"))
    known = stepped.select(F.col("node").alias("step"), F.col("step").alias("far"))
    return stepped.join(known, "step").select("node", F.least("step", "far").alias("label"))


def _pairs_left(current: DataFrame) -> int:
    """Pairs of rows in one column whose labels differ, over all columns."""
    sizes = current.groupBy("gram", "label").agg(F.count(F.lit(1)).cast("double").alias("k"))
    per_gram = sizes.groupBy("gram").agg(((F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))) / 2).alias("pairs"))
    return int(per_gram.agg(F.sum("pairs")).first()[0] or 0)


def _all_left(current: DataFrame, percent: int) -> DataFrame:
    """Those pairs. Rows of a column's largest group meet the others, not each other."""
    sizes = current.groupBy("gram", "label").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("gram").agg(F.max_by("label", F.struct("k", "label")).alias("main"), F.count(F.lit(1)).alias("labels"))
    open_ = current.join(largest.where("labels > 1"), "gram")
    others = open_.where("label != main").select("gram", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("label").alias("label_a"))
    ahead = (F.col("label") == F.col("main")) | (F.col("a") < F.col("node"))
    return (
        others.join(open_, "gram")
        .where((F.col("label_a") != F.col("label")) & ahead & _alike(F.col("n_a"), F.col("n"), percent))
        .select("a", F.col("node").alias("b")).distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that links reach, for every linked node. Labels
    move along links and jump to their label's label, until nothing changes."""
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = store(nodes.withColumn("label", F.col("node")), "labels")
    while True:
        after = store(_joined(labels, links), "labels")
        changed = after.join(labels.toDF("node", "before"), "node").where("label != before")
        if changed.isEmpty():
            return after
        labels = after


def _labelled(sized: DataFrame, classes: DataFrame, large: DataFrame, groups: DataFrame) -> DataFrame:
    """Every row with its component (null for an empty set) and that one's smallest id."""
    named = classes.join(groups, "node", "left").select("sequence", "least", F.coalesce("label", "node").alias("component"))
    linked = groups.select(F.col("label").alias("component")).distinct()
    smallest = named.join(linked, "component", "left_semi").groupBy("component").agg(F.min("least").alias("smallest"))
    ids = store(
        named.join(smallest, "component", "left").select("sequence", "component", F.coalesce("smallest", "least").alias("component_id")),
        "components",
    )
    hot = store(ids.join(F.broadcast(large.select("sequence")), "sequence", "left_semi"), "large")  # 1 / SUPPORT rows at most
    marked = sized.join(F.broadcast(hot), "sequence", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    columns = ["doc_id", F.col("n").cast("long").alias("n_shingles"), own, "component", "row"]
    settled = marked.where("component is not null or n = 0").select(*columns)
    others = marked.where("component is null and n > 0").drop("component", "component_id").join(ids, "sequence")
    return settled.unionByName(others.select(*columns))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (of several such
    rows the first); rows with an empty set stay. All columns are kept."""
    columns = docs.columns
    copy = store(docs.toDF(*(f"c{i}" for i in range(len(columns)))).withColumn("row", F.monotonically_increasing_id()), "documents")
    text, key = (F.col(f"c{columns.index(n)}") for n in (text_col, id_col))
    found = _components(copy.select("row", key.alias("doc_id"), text.alias("text")), width, percent)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = found.where("component is not null").groupBy("component").agg(F.min_by("row", order).alias("row")).select("row")
    gone = store(found.where("component is not null").join(first, "row", "left_anti").select("row"), "gone")
    few = gone.count() <= BROADCAST_ROWS  # then no text is shuffled
    return copy.join(F.broadcast(gone) if few else gone, "row", "left_anti").drop("row").toDF(*columns)
