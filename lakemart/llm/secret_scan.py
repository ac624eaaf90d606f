"""Secrets in text, judged by who else has them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, store, whole

# Fixed patterns. ``assign`` keeps short values here, since they use up text; they are dropped after matching. In
# the others a match below the least length can be left to the pattern, because it takes the whole run.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
#: What the method adds: a long run of key characters that stands alone.
BARE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
#: Kinds in the order in which equal starts are listed: pattern, group of the secret value.
KINDS = {"assign": (ASSIGN, 1), "access": (ACCESS, 0), "hex": (HEX, 0), "bare": (BARE, 0)}
BASE = ("assign", "access", "hex")
#: Length of an assigned value; different characters of a bare run.
LEAST_VALUE, LEAST_CHARACTERS = 8, 10
#: A value that so many owners have is a copied example.
EXAMPLE_OWNERS = 3
#: Rows to cut secrets out of, and cuts in them, are broadcast up to this number (some 100 bytes each).
BROADCAST_ROWS = 100_000


def _found(text: Column, kind: str) -> Column:
    """``gap, length, value`` of each match: the characters since the last one, and its own.
    Splitting by a pattern gives what lies between its matches, in the same order."""
    pattern, group = KINDS[kind]
    gaps = F.split(text, pattern, -1)
    every = F.arrays_zip(
        F.transform(gaps, lambda g: F.length(g)).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.length(m)).alias("length"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    kind_of = "array<struct<gap:int,length:int,value:string>>"
    matches = F.filter(every, lambda m: m["length"].isNotNull()).cast(kind_of)  # the last gap has no match
    return F.when(text.rlike(pattern), matches).otherwise(F.array().cast(kind_of))


def _looks_random(value: Column) -> Column:
    different = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (different >= LEAST_CHARACTERS)


def candidates(rows: DataFrame) -> DataFrame:
    """``row, owner, repository, kind, start, end, digest`` of every span that passes its kind's
    test, from ``row, owner, text``. A repository is a text: copies are one. Starts count
    code points; ends are exclusive."""
    text = F.col("text")
    found = rows.select("row", "owner", F.md5(text).alias("repository"), *(_found(text, k).alias(k) for k in KINDS))
    parts = []
    for kind in KINDS:
        at = Window.partitionBy("row").orderBy("place")
        each = found.where(F.size(kind) > 0).select("row", "owner", "repository", F.posexplode(kind).alias("place", "m"))
        end = F.sum(F.col("m.gap") + F.col("m.length")).over(at)
        passed = {"assign": F.length("m.value") >= LEAST_VALUE, "bare": _looks_random(F.col("m.value"))}.get(kind, F.lit(True))
        parts.append(
            each.withColumn("end", end).where(passed).select(
                "row", "owner", "repository", F.lit(kind).alias("kind"), (F.col("end") - F.col("m.length")).alias("start"), "end",
                F.sha2(F.col("m.value"), 256).alias("digest"),
            )
        )
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


def scan(rows: DataFrame) -> DataFrame:
    """``candidates`` with ``owners`` and ``repositories`` that have the same value in the whole
    corpus, and ``live``: whether it is still to be taken for a credential.

    A repository is a different text; copies of a text are one repository, which belongs to the
    first of their owners by name. So copying a text makes no owner and no example. Bare
    runs stay only while they are live and lie outside all spans of the base kinds.

    Copies are counted in three steps (value and text, value and owner, value), each summed before
    its shuffle, and only values of several repositories are joined back (the others have one owner
    and one repository), handed out in 16 slices: a value that a third of the rows hold does not meet in one task.
    """
    every = store(candidates(rows), "candidates")
    per_text = every.groupBy("digest", "repository").agg(F.min("owner").alias("owner"))
    per_owner = per_text.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("texts"))
    shared = per_owner.groupBy("digest").agg(F.count(F.lit(1)).alias("owners"), F.sum("texts").alias("repositories"))
    spread = shared.where("repositories > 1").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(15).cast("long"))))
    known = (
        every.withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(16)))
        .join(spread, ["digest", "slice"], "left").drop("slice")
        .withColumns({c: F.coalesce(c, F.lit(1)) for c in ("owners", "repositories")})
        .withColumn("live", F.col("owners") < EXAMPLE_OWNERS)
    )
    base = F.col("kind") != "bare"
    up_to = Window.partitionBy("row").orderBy("start", base.desc())
    ends = F.max(F.when(base, F.col("end"))).over(up_to.rowsBetween(Window.unboundedPreceding, 0))
    starts = F.min(F.when(base, F.col("start"))).over(up_to.rowsBetween(0, Window.unboundedFollowing))
    apart = (F.coalesce(ends, F.lit(0)) <= F.col("start")) & (F.coalesce(starts, F.col("end")) >= F.col("end"))
    return known.withColumn("apart", apart).where(base | (F.col("apart") & F.col("live"))).drop("apart")


def _rows(docs: DataFrame, id_col: str, text_col: str, owner_col: str) -> DataFrame:
    return pick(docs, id_col, text_col, owner_col).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        whole(text_col).alias("text"), F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
    )


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans,
    n_live, n_examples, n_repositories``: the last is the number of different texts that hold the
    most widespread of the row's values (0: no span).

    Null and empty texts have no spans; a null owner counts as one owner. Repeated rows are
    reported each; a null id is reported as null. ``docs`` is read once, and its
    numbered rows are stored, since another scan could number them anew.
    """
    rows = store(_rows(docs, id_col, text_col, owner_col), "documents")
    order = F.element_at(F.create_map(*(x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i)))), F.col("kind"))
    written = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    span = F.struct("start", order.alias("order"), written.alias("written"))
    base = F.col("kind") != "bare"

    def joined(spans: Column) -> Column:  # spans of one document
        return F.array_join(F.transform(F.sort_array(spans), lambda s: s["written"]), ",")

    counts = {f"n_{k}": F.count(F.when(F.col("kind") == k, 1)) for k in BASE}
    per_row = scan(rows).groupBy("row").agg(
        *(c.alias(n) for n, c in counts.items()),
        joined(F.collect_list(F.when(base, span))).alias("base"), joined(F.collect_list(span)).alias("spans"),
        F.count(F.when(F.col("live"), 1)).alias("n_live"), F.count(F.when(~F.col("live"), 1)).alias("n_examples"),
        F.max("repositories").alias("n_repositories"),
    )
    numbers = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in counts]
    return rows.select("row", "doc_id").join(per_row, "row", "left").select(
        "doc_id", *numbers, F.sha2(whole("base"), 256).alias("base_sha256"), whole("spans").alias("spans"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_live", "n_examples", "n_repositories")),
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", mark: str = "[SECRET]", length_col: str | None = None) -> DataFrame:
    """``docs`` with ``mark`` in place of every live span (those that overlap become one);
    widely copied examples stay. Null texts stay null. All rows and columns are kept;
    ``length_col``, if given, gets the new text's length where a text is cut."""
    columns = docs.columns
    copy = store(docs.toDF(*(f"c{i}" for i in range(len(columns)))).withColumn("row", F.monotonically_increasing_id()), "documents")
    text, owner = f"c{columns.index(text_col)}", f"c{columns.index(owner_col)}"
    rows = copy.select("row", whole(text).alias("text"), F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"))
    at = Window.partitionBy("row").orderBy("start", "end")
    before = F.max("end").over(at.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col("start") >= before).cast("int"), F.lit(1))
    merged = (
        scan(rows).where("live").withColumn("new", new).withColumn("n", F.sum("new").over(at))
        .groupBy("row", "n").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    cuts = store(merged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts")), "cuts")
    size = cuts.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size("cuts")), F.lit(0))).first()[0]
    side = F.broadcast(cuts) if size <= BROADCAST_ROWS else cuts
    marked = copy.join(side, "row", "left")
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform("cuts", lambda c: c["end"]))
    ends = F.concat(F.transform("cuts", lambda c: c["start"]), F.array(F.length(text).cast("long")))
    kept = F.transform(
        F.arrays_zip(begins.alias("begin"), ends.alias("end")),
        lambda k: F.col(text).substr((k["begin"] + 1).cast("int"), (k["end"] - k["begin"]).cast("int")),
    )
    clean = F.when(F.col("cuts").isNull(), F.col(text)).otherwise(F.array_join(kept, mark))
    made = marked.withColumn(text, clean)
    if length_col is not None:
        length = f"c{columns.index(length_col)}"
        new = F.length(text).cast(copy.schema[length].dataType)
        made = made.withColumn(length, F.when(F.col("cuts").isNull(), F.col(length)).otherwise(new))
    return made.drop("row", "cuts").toDF(*columns)
