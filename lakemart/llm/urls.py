"""Allow and block rules for URLs, matched by a trie."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, ship

#: Rules up to this many are broadcast as a trie (about 1 kB each at most); more are joined.
MAX_TRIE_RULES = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _stems(path: str) -> tuple[list[str], str]:
    """Whole segments, and the begun one after the last slash."""
    *whole, begun = path.split("/")
    return whole, begun


class Trie:
    """Host labels from the last to the first, then path segments. A rule ends at a node
    with the beginning of one more segment (empty for a path that ends in a slash)."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node.setdefault(("host", label), {})
            whole, begun = _stems(rule.path)
            for segment in whole:
                node = node.setdefault(("path", segment), {})
            ends = node.setdefault("ends", {})
            present = ends.get(begun)
            if present is None or rule.verdict == "block":  # the stricter of two equal rules
                ends[begun] = (len(rule.name), rule.name, rule.verdict)

    def longest(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits; of two equally long ones, the one
        that names more of the host."""
        best = None
        segments = path.split("/")
        node = self.root
        for label in reversed(host.split(".")):
            node = node.get(("host", label))
            if node is None:
                break
            at = node
            for segment in segments:
                for begun, end in at.get("ends", {}).items():
                    if segment.startswith(begun) and (best is None or end[0] >= best[0]):
                        best = end
                at = at.get(("path", segment))
                if at is None:
                    break
        return best and best[1:]


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    path: then up to ``?`` or ``#``. Null or without ``://``: both empty."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def judge(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", default: str = "allow", max_trie: int = MAX_TRIE_RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row, repeated rows and null ids
    included. Without a rule that fits, ``rule`` is null and the verdict ``default``.

    Up to ``max_trie`` rules, the trie is broadcast and each URL costs a walk down it.
    With more, host suffixes and path stems are joined to the rules.
    """
    host, path = host_and_path(url_col)
    parsed = pick(pages, id_col, url_col).select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    found = _by_trie(parsed, rules) if len(rules) <= max_trie else _by_join(parsed, rules)
    return found.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _by_trie(parsed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    spark = parsed.sparkSession
    ship(spark)
    trie = spark.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def longest(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        walk = trie.value.longest
        found = [walk(h, p) or (None, None) for h, p in zip(host, path, strict=True)]
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype="object")

    return parsed.withColumn("found", longest("host", "path")).select("page_id", "host", "path", "found.rule", "found.verdict")


def _by_join(parsed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Each distinct host and path is spread into (host suffix, whole segments) and joined
    to rules under the same pair; the begun segment is compared after the join."""
    spark = parsed.sparkSession
    split = [(r.host, "/".join(_stems(r.path)[0]), r.path, r.name, r.verdict) for r in rules]
    table = spark.createDataFrame(split, "suffix string, stem string, start string, rule string, verdict string")
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(F.split("host", r"\."), i, F.size(F.split("host", r"\."))), "."))
    stems = F.transform(F.sequence(F.lit(0), F.size(segments) - 1), lambda i: F.array_join(F.slice(F.split("path", "/"), F.lit(1), i), "/"))
    urls = parsed.select("host", "path").distinct()
    spread = urls.withColumn("suffix", F.explode(suffixes)).withColumn("stem", F.explode(stems))
    order = F.struct(F.length("rule").alias("n"), F.size(F.split("suffix", r"\.")).alias("labels"), (F.col("verdict") == "block").alias("strict"), "rule", "verdict")
    best = (
        spread.join(table, ["suffix", "stem"])
        .where(F.col("path").startswith(F.col("start")))
        .groupBy("host", "path").agg(F.max(order).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    return parsed.join(best, ["host", "path"], "left")
