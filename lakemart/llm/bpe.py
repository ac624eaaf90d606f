"""Byte-pair encoding and decoding with forced boundaries."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, ship

#: Words, and fragments of words, a worker remembers (some 300 bytes each).
REMEMBERED = 500_000
#: Longer words and fragments are not remembered: they hardly occur twice.
LONGEST_REMEMBERED = 256
#: Fragments of more letters are merged by a heap, since a scan for each merge takes quadratic time.
SCANNED = 48

# Byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ...
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTER = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
# White space, by code point; str.split() also cuts at four control characters.
_NOT_SPACE = re.compile("[^\t-\r \x85\xa0  -     　]+")
_CONTROLS = re.compile("[\x1c-\x1f]")


class Fragments(dict):
    """(fragment, whether it ends a word) -> its ids."""

    def __init__(self, coder: WordBpe):
        super().__init__()
        self.coder = coder

    def __missing__(self, key: tuple[str, bool]) -> list[int]:
        ids = self.coder.merged(*key)
        if len(key[0]) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = ids
        return ids


class WordBpe(dict):
    """A lower-casing byte-level tokenizer whose words carry an end mark.

    Two neighbouring bytes that stand together in no token of the vocabulary are never
    merged, nor is anything across them: a word is cut there, each fragment is
    encoded on its own, and the ids are joined. The same holds between words, so a
    text is a sequence of words, each looked up here as (its ids, its tokens).
    """

    def __init__(self, file: str):
        import regex

        super().__init__()
        with open(file, encoding="utf-8") as f:
            state = json.load(f)
        model = state["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {tuple(pair): i for i, pair in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in state["added_tokens"]}
        self.at_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        self.together = {pair for token in self.ids for pair in self._neighbours(token.removesuffix(self.end))}
        pattern = next(p["pattern"]["Regex"] for p in state["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern).findall
        # the same on ASCII, without a table of properties
        self.split_ascii = re.compile(pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9"), re.ASCII).findall
        self.fragments = Fragments(self)

    @staticmethod
    def _neighbours(letters: str) -> Iterator[str]:
        return (letters[i : i + 2] for i in range(len(letters) - 1))

    def cut(self, letters: str) -> list[str]:
        """Fragments of a word, cut at all forced boundaries."""
        together = self.together
        cuts = [i for i in range(1, len(letters)) if letters[i - 1 : i + 1] not in together]
        return [letters[a:b] for a, b in zip([0, *cuts], [*cuts, len(letters)], strict=True)] if cuts else [letters]

    def merged(self, fragment: str, last: bool) -> list[int]:
        """Joins the leftmost neighbours of the lowest rank, until no pair has a rank."""
        parts = list(fragment)
        if last:
            parts[-1] += self.end
        if len(parts) > SCANNED:
            return [self.ids[p] for p in self._merged_by_heap(parts)]
        rank, none = self.ranks.get, len(self.ranks)
        order = [rank(pair, none) for pair in zip(parts, parts[1:], strict=False)]
        while order and (lowest := min(order)) < none:
            i = order.index(lowest)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del order[i]
            if i:
                order[i - 1] = rank((parts[i - 1], parts[i]), none)
            if i < len(order):
                order[i] = rank((parts[i], parts[i + 1]), none)
        return [self.ids[p] for p in parts]

    def _merged_by_heap(self, parts: list[str | None]) -> list[str]:
        """The same merges in n log n steps. Neighbours are linked by place; an entry of the
        heap counts only while the pair at its place still has its rank."""
        rank, n = self.ranks.get, len(parts)
        before, after = [*range(-1, n - 1)], [*range(1, n + 1)]
        heap = [(r, i) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]))) is not None]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            j = after[i]
            if parts[i] is None or j == n or rank((parts[i], parts[j])) != r:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (new := rank((parts[i], parts[k]))) is not None:
                    heappush(heap, (new, i))
            h = before[i]
            if h >= 0 and (new := rank((parts[h], parts[i]))) is not None:
                heappush(heap, (new, h))
        return [p for p in parts if p is not None]

    def word_ids(self, word: str) -> list[int]:
        """Ids of a piece of text without white space."""
        if word.isascii():
            pieces = self.split_ascii(word.lower())
        else:
            pieces = self.split("".join(c.lower() for c in unicodedata.normalize("NFC", word)))
        ids: list[int] = []
        for piece in pieces:
            *inner, last = self.cut("".join(map(_LETTER.__getitem__, piece.encode())))
            for fragment in inner:
                ids += self.fragments[fragment, False]
            ids += self.fragments[last, True]
        return ids

    def __missing__(self, word: str) -> tuple[int, str, str]:
        ids = self.word_ids(word)
        found = len(ids), " ".join(map(str, ids)), " ".join(self.tokens[i] for i in ids)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found

    def _words(self, text: str) -> list[str]:
        return _NOT_SPACE.findall(text) if _CONTROLS.search(text) else text.split()

    def encode(self, text: str) -> tuple[int, str, str]:
        """(number of ids, ids joined by spaces, decoded text)."""
        found: list[tuple[int, str, str]] = []
        at = 0
        for m in self.at_special.finditer(text):
            found += map(self.__getitem__, self._words(text[at : m.start()]))
            found.append((1, str(self.special[m[0]]), m[0]))
            at = m.end()
        found += map(self.__getitem__, self._words(text[at:] if at else text))
        if not found:
            return 0, "", ""
        counts, ids, tokens = zip(*found, strict=True)
        return sum(counts), " ".join(ids), " ".join(tokens)

    def decode(self, ids: list[int]) -> str:
        """The tokens, joined by spaces: the file names no decoder."""
        return " ".join(self.tokens[i] for i in ids)


_coders: dict[str, WordBpe] = {}


def coder(file: str) -> WordBpe:
    """One per worker process."""
    if file not in _coders:
        _coders[file] = WordBpe(file)
    return _coders[file]


def encode(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row's whole text (null: empty, no ids). Strings of special
    tokens in a text become those tokens. Repeated rows and null ids are encoded like
    any others; an empty table gives no rows."""
    ship(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def encoded(texts: pd.Series) -> pd.Series:
        one = coder(file).encode
        return pd.Series([[int(i) for i in one(t)[1].split()] for t in texts])

    rows = pick(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.select("doc_id", encoded("text").alias("ids"))


def decode(rows: DataFrame, file: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of the ids (null ids: null)."""
    ship(rows.sparkSession)

    @F.pandas_udf("string")
    def decoded(ids: pd.Series) -> pd.Series:
        one = coder(file).decode
        return pd.Series([None if i is None else one(list(i)) for i in ids], dtype="object")

    return rows.withColumn("decoded", decoded(ids_col))


def digests(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: what ``encode`` and ``decode`` give, without
    moving the ids."""
    ship(docs.sparkSession)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def hashed(texts: pd.Series) -> pd.DataFrame:
        one = coder(file).encode
        rows = []
        for text in texts:
            n, ids, decoded = one(text)
            rows.append((n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    rows = pick(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.withColumn("found", hashed("text")).select("doc_id", "found.n_tokens", "found.ids_sha256", "found.decoded_sha256")
