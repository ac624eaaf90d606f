"""Packing token sequences: best-fit decreasing over a segment tree."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gapless, numbered, pick, ship, store

#: Tokens in a sequence.
CAPACITY = 2048
#: Words, and pieces of words, a worker remembers (some 200 bytes each).
REMEMBERED = 700_000


class Tightest:
    """Which remaining capacities have open bins: a segment tree of flags, searched for the
    smallest capacity of at least ``need`` in logarithmic time."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves <= capacity:
            self.leaves *= 2
        self.any = bytearray(2 * self.leaves)

    def mark(self, capacity: int, open_bins: bool) -> None:
        node = self.leaves + capacity
        self.any[node] = open_bins
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def find(self, need: int) -> int | None:
        node = self.leaves + need
        if self.any[node]:
            return need
        while node > 1:  # up to the first subtree on the right that has one, then down its left edge
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node + (not self.any[2 * node])
                return node - self.leaves
            node //= 2
        return None


class Plan:
    """Where the pieces go: those of ``length`` numbered ``rank`` .. get bins ``bin`` .. at
    ``offset``, up to the next entry of the same length."""

    def __init__(self, entries: list[tuple[int, int, int, int]], bins: int):
        length, rank, first, offset = np.array(sorted(entries), dtype=np.int64).reshape(-1, 4).T
        self.key, self.rank, self.first, self.offset, self.bins = (length << 42) | rank, rank, first, offset, bins

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 42) | rank, side="right") - 1
        return self.first[at] + rank - self.rank[at], self.offset[at]


def best_fit_decreasing(counts: Mapping[int, int], capacity: int = CAPACITY) -> Plan:
    """Places ``counts[length]`` pieces of every length, longest first, each into the open
    bin with the least room that holds it.

    Pieces of one length are alike, and so are bins with the same history, so runs of
    both are placed in one step: the input is a histogram of at most ``capacity``
    rows, and the steps depend on it and not on the number of documents.
    """
    tree = Tightest(capacity)
    bins: dict[int, list[tuple[int, int]]] = {}  # room -> runs of bins (first, number)
    entries: list[tuple[int, int, int, int]] = []
    opened = 0

    def put(room: int, first: int, number: int) -> None:
        if number and room:
            bins.setdefault(room, []).append((first, number))
            tree.mark(room, True)

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit")
        left, rank = counts[length], 0
        while left:
            room = tree.find(length)
            if room is None:
                room, per_bin = capacity, capacity // length
                first, number = opened, -(-left // per_bin)
                opened += number
            else:
                per_bin = room // length
                first, number = bins[room].pop()
                if not bins[room]:
                    tree.mark(room, False)
            full = min(number, left // per_bin)
            for j in range(per_bin if full else 0):
                entries.append((length, rank, first, capacity - room + j * length))
                rank += full
            left -= full * per_bin
            put(room - per_bin * length, first, full)
            part = min(left, per_bin - 1) if full < number else 0
            for j in range(part):
                entries.append((length, rank, first + full, capacity - room + j * length))
                rank += 1
            left -= part
            if part:
                put(room - part * length, first + full, 1)
            put(room, first + full + bool(part), number - full - bool(part))
    return Plan(entries, opened)


def pieces_of(total: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    if total <= capacity:
        return [(0, total)]
    first = total % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, total, capacity))]


# Byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ...
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {chr(b): b for b in _SHOWN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class Pieces(dict):
    """Word piece -> its ids, each encoded once."""

    def __init__(self, vocabulary: Mapping[str, int]):
        import tiktoken

        super().__init__()
        # a byte-level vocabulary in merge order is also a table of ranks
        ranks = {bytes(_BYTE[c] for c in token): i for token, i in vocabulary.items()}
        self.ranked = tiktoken.Encoding("vocabulary", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def encode(self, piece: str) -> bytes:
        return array("I", self.ranked._encode_single_piece(piece)).tobytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece)
        if len(self) >= REMEMBERED:
            self.clear()
        self[piece] = ids
        return ids


class ByteTokens(dict):
    """Ids of a text as little-endian 32-bit bytes, equal to the tokenizer's.

    A text of the Latin letters below is cut before each space that a non-space
    follows, where the tokenizer always begins a piece; what lies between is looked
    up here, or split by an expression equal to the tokenizer's own on such text.
    Any other text goes to the tokenizer whole.
    """

    _plain = re.compile(r"[\t-\r\x20-\x7e¡-©«-±´¶-¸»¿-ɏ]*")
    _split = re.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+"
        r"| ?[^\sA-Za-z0-9À-ÖØ-öø-ɏ]+|\s+(?!\S)|\s+"
    )
    _doubled = tuple(" " + c for c in " \t\n\v\f\r")

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(file, encoding="utf-8") as f:
            state = json.load(f)
        self.special = [t["content"] for t in state["added_tokens"]]
        self.pieces = Pieces(state["model"]["vocab"])

    def _pieced(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self._split.findall(text)))

    def __missing__(self, word: str) -> bytes:
        ids = self.pieces.encode(" " + word) if word.isalpha() else self._pieced(" " + word)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not self._plain.fullmatch(text) or any(s in text for s in self.special):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if text.endswith(" ") or any(s in text for s in self._doubled):
            return self._pieced(text)
        first, *rest = text.split(" ")
        return self._pieced(first) + b"".join(map(self.__getitem__, rest))


_encoders: dict[str, ByteTokens] = {}


def encoder(file: str) -> ByteTokens:
    """One per worker process."""
    if file not in _encoders:
        _encoders[file] = ByteTokens(file)
    return _encoders[file]


def _cut(texts: Iterable[str | None], keys: Iterable, file: str, end_id: int, capacity: int, with_ids: bool) -> pd.DataFrame:
    encode, end, rows = encoder(file).encode, np.array([end_id], dtype="<u4").tobytes(), []
    for key, text in zip(keys, texts, strict=True):
        ids = (encode(text) if text else b"") + end
        for i, (start, length) in enumerate(pieces_of(len(ids) // 4, capacity)):
            piece = ids[4 * start : 4 * (start + length)]
            rows.append((key, i, start, length, zlib.crc32(piece), piece if with_ids else None))
    return pd.DataFrame(rows, columns=["key", "piece", "start", "length", "ids_crc32", "ids"])


def pieces(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``, little-endian 32-bit bytes):
    each document's ids and the end id, cut where they exceed the capacity."""
    ship(docs.sparkSession)
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = _cut(frame["text"], range(len(frame)), file, end_id, capacity, with_ids)
            made.insert(0, "doc_id", frame["doc_id"].to_numpy()[made.pop("key").to_numpy(dtype=np.int64)])
            yield made if with_ids else made.drop(columns="ids")

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    # ids travel as text, so that a null among them does not turn the others into floats
    cast = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    made = cast.mapInPandas(cut, schema.replace(f"doc_id {kind}", "doc_id string"))
    return made.withColumn("doc_id", F.col("doc_id").cast(kind))


def pack(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: few sequences of at most ``capacity``
    tokens, filled without gaps.

    A null or empty text is the end id alone. Repeated rows and null ids are packed like
    any others; an empty table gives no rows. Texts of any length are cut. Only the
    number of pieces of each length, at most ``capacity`` rows, reaches the driver;
    pieces are numbered within their length by ``gapless``, and the plan, which
    depends on those counts, is broadcast.
    """
    spark = docs.sparkSession
    rows = store(numbered(pieces(docs, file, id_col, text_col, end_id, capacity, with_ids)), "pieces")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.sparkContext.broadcast(best_fit_decreasing(counts, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        bins, offsets = plan.value.place(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": bins, "offset": offsets})

    ranked = gapless(rows, ["length"], "rank").withColumn("placed", placed("length", "rank"))
    return ranked.select(*rows.drop("part", "row").columns, "placed.sequence_id", "placed.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of a ``pack(..., with_ids=True)``: the pieces joined in order.
    A sequence is bounded by its capacity, and so is each group."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.transform(ordered, lambda p: p["ids"]), F.lit(b""), lambda all_, p: F.concat(all_, p))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
