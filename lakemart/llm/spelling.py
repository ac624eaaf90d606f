"""Spelling variants: near words by blocked Gram matrices of letter counts."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, ship, store

#: Shortest word, in code points, and fewest occurrences.
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: Of 97 (document, word) hashes one loses a letter.
ONE_IN = 97
#: Words, and letters, in one block; a cell with more words is cut into several blocks.
BLOCK_WORDS, BLOCK_LETTERS = 2_048, 4_000_000
#: Classes of letters whose counts make the cells.
CLASSES = 4
#: Different words a task counts before it hands its counts on.
COUNTED = 300_000
#: A list of split cells up to this length is broadcast; a longer one is shuffled.
BROADCAST_ROWS = 1_000_000

# Latin-1 is one byte a letter: A-Z lower-cased, other letters as they are, all else a space.
_RUNS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)


def runs(text: str) -> list[bytes]:
    """Maximal runs of Latin letters as Latin-1 bytes, A-Z lower-cased."""
    return text.encode("latin-1", "replace").translate(_RUNS).split()


def worn(run: bytes, start: int) -> bytes:
    """The run, or without one letter where its hash says so; ``start`` is the hash of what
    stands before it, the document's id and a colon."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % ONE_IN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of all documents. Each text is counted whole; a task adds its counts up
    before they are shuffled."""
    ship(docs.sparkSession)
    rows = pick(docs, id_col, text_col).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[bytes] = Counter()
        for frame in frames:
            for key, text in zip(frame["id"], frame["text"], strict=True):
                if text:
                    found = Counter(runs(text))
                    if isinstance(key, str):
                        start = zlib.crc32(f"{key}:".encode())
                        for run, n in found.items():
                            total[worn(run, start)] += n
                    else:
                        total.update(found)
                if len(total) >= COUNTED:
                    yield _counts(total)
                    total.clear()
        if total:
            yield _counts(total)

    return rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counts(total: Counter[bytes]) -> pd.DataFrame:
    kept = {w: n for w, n in total.items() if len(w) >= LEAST_LETTERS}
    return pd.DataFrame({"word": [w.decode("latin-1") for w in kept], "n": list(kept.values())})


def _class_count(k: int) -> Column:
    letters = "".join(chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)] if c % CLASSES == k)
    return F.length(F.regexp_replace("word", f"[^{letters}]+", ""))


_CELL = [f"k{k}" for k in range(CLASSES)]


def _moves() -> list[tuple[int, ...]]:
    """How the class counts of two near words can differ, each pair of cells once: not at
    all, one letter moved to a later class, or one letter more in the second word."""
    unit = [tuple(int(i == k) for i in range(CLASSES)) for k in range(CLASSES)]
    moved = [tuple(b - a for a, b in zip(unit[i], unit[j], strict=True)) for i in range(CLASSES) for j in range(i + 1, CLASSES)]
    return [(0,) * CLASSES, *moved, *unit]


def _blocks(words: DataFrame) -> DataFrame:
    """``k0.., sub, subs, words, ns``: the words of a cell, in blocks of bounded size.

    A cell holds the words with the same number of letters of each class, hence of one
    length. The list of cells that are split has at most words / ``BLOCK_WORDS`` entries,
    but for words of thousands of letters.
    """
    celled = store(words.select("word", "n", *(_class_count(k).alias(c) for k, c in enumerate(_CELL))), "celled")
    letters = sum((F.col(c) for c in _CELL), F.lit(0))
    room = F.least(F.lit(BLOCK_WORDS), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_LETTERS) / letters)))
    split = store(
        celled.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("size")).select(*_CELL, F.ceil(F.col("size") / room).alias("subs")).where("subs > 1"),
        "split",
    )
    few = split.count() <= BROADCAST_ROWS
    placed = celled.join(F.broadcast(split) if few else split, _CELL, "left").withColumn("subs", F.coalesce("subs", F.lit(1)))
    placed = placed.withColumn("sub", F.pmod(F.xxhash64("word"), F.col("subs")))
    return store(
        placed.groupBy(*_CELL, "sub", "subs").agg(F.collect_list("word").alias("words"), F.collect_list("n").alias("ns")),
        "blocks",
    )


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of the words that have a near word: one code point
    inserted, deleted or replaced. ``best`` is the near word of largest ``n``, of several the
    smallest.

    The letter counts of near words differ by one letter, or by one taken and one given:
    their squared distance is at most two, and so is that of the coarser counts that
    make cells. So each block is multiplied with the blocks of its own and of the
    adjacent cells only; NumPy gives all squared distances of two blocks in one
    product, and the few pairs within two are compared letter by letter. A task hands on
    one row for each word that found any, however many it found.
    """
    ship(words.sparkSession)
    blocks = _blocks(words)
    moves = F.explode(F.array(*(F.array(*map(F.lit, m)) for m in _moves()))).alias("move")
    left = blocks.select(*(F.col(c).alias(f"l_{c}") for c in _CELL), F.col("sub").alias("l_sub"), F.col("words").alias("l_words"), F.col("ns").alias("l_ns"), moves)
    left = left.select("*", *((F.col(f"l_{c}") + F.col("move")[k]).alias(c) for k, c in enumerate(_CELL)))
    same = F.array_max("move") == 0
    pairs = left.join(blocks, _CELL).where(~same | (F.col("l_sub") <= F.col("sub")))
    own = (same & (F.col("l_sub") == F.col("sub"))).alias("own")
    pairs = pairs.repartition(*_CELL, *(f"l_{c}" for c in _CELL), "l_sub", "sub").select("l_words", "l_ns", "words", "ns", own)

    def multiply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.concat([best_of(list(a), an, list(b), bn, own) for a, an, b, bn, own in frame.itertuples(index=False)])

    found = pairs.mapInPandas(multiply, "word string, n_near long, best_n long, best string")
    order = F.struct(-F.col("best_n"), F.col("best"))
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.max("best_n").alias("best_n"), F.min_by("best", order).alias("best")
    )


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters by position, and letter counts. All words have one length."""
    codes = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)
    entries = 256 * np.arange(len(words))[:, None] + codes
    return codes, np.bincount(entries.ravel(), minlength=256 * len(words)).reshape(-1, 256).astype(np.float32)


def near_pairs(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``a`` and ``b`` of near words; those of ``b`` are as long, or one longer."""
    (codes_a, counts_a), (codes_b, counts_b) = _letters(a), _letters(b)
    used = np.flatnonzero(counts_a.any(axis=0) | counts_b.any(axis=0))
    counts_a, counts_b = counts_a[:, used], counts_b[:, used]
    squared = (counts_a**2).sum(axis=1)[:, None] + (counts_b**2).sum(axis=1) - 2 * counts_a @ counts_b.T
    first, second = np.nonzero(squared < 2.5)
    length = codes_a.shape[1]
    step = max(1, BLOCK_LETTERS // length)
    kept = [_one_edit(codes_a[first[i : i + step]], codes_b[second[i : i + step]]) for i in range(0, len(first), step)]
    ok = np.concatenate(kept) if kept else np.zeros(0, dtype=bool)
    return first[ok], second[ok]


def _one_edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    length = x.shape[1]
    if y.shape[1] == length:
        return (x != y).sum(axis=1) == 1
    ahead, behind = x != y[:, :-1], (x != y[:, 1:])[:, ::-1]
    lead = np.where(ahead.any(axis=1), ahead.argmax(axis=1), length)
    trail = np.where(behind.any(axis=1), behind.argmax(axis=1), length)
    return lead + trail >= length


def best_of(a: list[str], an: np.ndarray, b: list[str], bn: np.ndarray, own: bool) -> pd.DataFrame:
    """For each word of two blocks, or of one with itself: near words and the best of them."""
    first, second = near_pairs(a, b)
    words, ns = np.array(a + b, dtype=object), np.concatenate([an, bn])
    if own:  # each pair is found from both sides
        word, near = first, second
    else:
        word, near = np.concatenate([first, second + len(a)]), np.concatenate([second + len(a), first])
    place = np.empty(len(words), dtype=np.int64)
    place[np.argsort(words, kind="stable")] = np.arange(len(words))
    order = np.lexsort((place[near], -ns[near], word))
    word, near = word[order], near[order]
    each, starts, sizes = np.unique(word, return_index=True, return_counts=True)
    best = near[starts]
    return pd.DataFrame({"word": words[each], "n_near": sizes, "best_n": ns[best], "best": words[best]})


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the corpus with at least
    ``LEAST_LETTERS`` code points and ``LEAST_COUNT`` occurrences.

    ``form`` is the best near word if it occurs twice as often at least, ``root`` what
    following forms comes to; a word without a form is its own root. Null and empty texts
    have no words, and an empty table gives no rows. Repeated rows count again. In a row
    without an id no letter is taken out. Of equally frequent near words the smallest by
    code points is the form.
    """
    words = store(count_words(docs, id_col, text_col).where((F.col("n") >= LEAST_COUNT) & (F.length("word") >= LEAST_LETTERS)), "words")
    known = words.join(near_words(words), "word", "left")
    formed = F.col("best_n") >= 2 * F.col("n")
    forms = store(
        known.select(
            "word", F.when(formed, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    return forms.join(_roots(forms), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words with a form. Each round takes a step as long as all
    before; a form occurs twice as often as its word, so paths are short and six or
    seven rounds are the most."""
    roots = forms.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = roots.toDF("root", "next")
        stepped = store(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = stepped.drop("moved")
        if stepped.where("moved").isEmpty():
            return roots
