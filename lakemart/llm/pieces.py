"""SentencePiece BPE encoding and decoding that keeps the place of every piece in its source.

A text is normalised by the longest prefixes that the model's compiled character map knows;
each normalised byte remembers the source byte it came from. Pieces cover the normalised
text without gaps, so each one projects to a span of source bytes.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, ship

#: Units (words with the spaces before them) a worker remembers, some 500 bytes each, and the longest of them.
REMEMBERED, LONGEST = 400_000, 200
#: Letters of a unit that is merged without a heap.
SHORT = 40

# Fixed values of the model format: fields of the messages, kinds of pieces, the mark for a space.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_CHARSMAP, _DUMMY_PREFIX, _TRIM, _ESCAPE = 2, 3, 4, 5
_SUFFIX, _FALLBACK, _SURFACE, _END = 24, 35, 44, 42
MARK = "▁"
_MARK = MARK.encode()


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a serialized message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = varint() if key & 7 == 2 else 8 if key & 7 == 1 else 4
        yield key >> 3, message[at : at + size]
        at += size


class CharacterMap:
    """The compiled map: a double-array trie over source bytes, whose values are places in
    a table of replacements that end with a zero byte. An empty map changes nothing."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist()
        self.texts = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, length of the prefix) of the longest known prefix at a place."""
        if not self.units:
            return None
        units, node, best = self.units, self._below(self.units[0], 0), None
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units) or units[node] & 0x800000FF != text[i]:
                break
            ends, node = units[node] >> 8 & 1, self._below(units[node], node)
            if ends:
                best = units[node] & 0x7FFFFFFF, i + 1 - at
        if best is None:
            return None
        return self.texts[best[0] : self.texts.index(b"\0", best[0])], best[1]

    @staticmethod
    def _below(unit: int, node: int) -> int:
        return node ^ (unit >> 10 << ((unit & 512) >> 6))


class Units(dict):
    """Unit of normalised text -> (number of ids, ids, decoded text, bytes of each piece), each
    encoded once. Long ones are not kept."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, unit: str) -> tuple[int, str, str, bytes]:
        made = self.model.encoded(unit)
        if len(unit) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[unit] = made
        return made


class Model:
    """A BPE model file. Other kinds of models, and pieces that users define, raise."""

    def __init__(self, data: bytes):
        settings: dict[int, dict] = {_TRAINER: {}, _NORMALIZER: {}}
        self.pieces, kinds, scores = [], [], []
        for number, value in fields(data):
            if number == _PIECES:
                piece = dict(fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0])
                kinds.append(piece.get(3, _NORMAL))
            elif number in settings:
                settings[number] = dict(fields(value))
        trainer, normalizer = settings[_TRAINER], settings[_NORMALIZER]
        if trainer.get(3, 1) != 2 or _USER in kinds or _UNUSED in kinds or trainer.get(_SUFFIX, 0):
            raise ValueError("only BPE models without pieces of users are read")
        self.map = CharacterMap(normalizer.get(_CHARSMAP, b""))
        self.dummy, self.trim, self.escape = (bool(normalizer.get(n, 1)) for n in (_DUMMY_PREFIX, _TRIM, _ESCAPE))
        self.fallback = bool(trainer.get(_FALLBACK, 0))
        self.unknown_text = trainer.get(_SURFACE, " ⁇ ".encode()).decode()
        self.end_id = trainer.get(_END, 2)
        self.kinds = kinds
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds, strict=True)) if k == _NORMAL}
        self.score = {p: -scores[i] for p, i in self.ids.items()}
        self.shown = {p: (f"{i} ", struct.pack("<i", len(p.encode()))) for p, i in self.ids.items()}
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i, k in enumerate(kinds) if k == _BYTE}
        self.octet = {i: b for b, i in self.bytes.items()}
        self.unknown = kinds.index(_UNKNOWN)
        # where no piece has a mark behind another letter, nothing is merged across a word's start
        self.cuts = self.escape and not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        signs = re.escape(self._signs())
        kinds_of_runs = f"[^{signs}{MARK}]+|{MARK}*[{signs}]+" if signs else f"[^{MARK}]+"
        self.cut = re.compile(f"{MARK}*{kinds_of_runs}|{MARK}+").findall
        self.units = Units(self)

    # normalising

    def normalised(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, the source byte."""
        if not text:
            return b"", np.zeros(1, dtype=np.int64)
        if not self.map.units and not self.trim:
            return self._unmapped(text)
        space, out, origin = _MARK if self.escape else b" ", bytearray(), []
        at = 0
        after_space = self.trim
        if self.trim:
            while at < len(text) and (found := self._prefix(text, at))[0] == b" ":
                at += found[1]
            if at == len(text):
                return b"", np.zeros(1, dtype=np.int64)
        if self.dummy:
            out += space
            origin += [at] * len(space)
        while at < len(text):
            made, used = self._prefix(text, at)
            if after_space:
                made = made.lstrip(b" ")
            if made:
                shown = made.replace(b" ", space)
                out += shown
                origin += [at] * len(shown)
                after_space = self.trim and made.endswith(b" ")
            at += used
        end = at
        if self.trim:
            while out.endswith(space):
                end = origin[len(out) - len(space)]
                del out[-len(space) :], origin[-len(space) :]
        return bytes(out), np.array([*origin, end], dtype=np.int64)

    def _prefix(self, text: bytes, at: int) -> tuple[bytes, int]:
        """What the text goes on with, normalised, and its length in the source."""
        found = self.map.longest(text, at)
        if found:
            return found
        first = text[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return text[at : at + size], size

    def _unmapped(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The same for an empty map: only spaces change."""
        shown, width = (text.replace(b" ", _MARK), len(_MARK)) if self.escape else (text, 1)
        octets = np.frombuffer(text, dtype=np.uint8)
        origin = np.arange(len(text) + 1)
        if width > 1:
            origin = np.repeat(origin, np.append(np.where(octets == 32, width, 1), 1))
        if self.dummy:
            shown = (_MARK if self.escape else b" ") + shown
            origin = np.concatenate([np.zeros(width, dtype=np.int64), origin])
        return shown, origin

    # merging

    def _signs(self) -> str:
        """Points and other signs, without those that stand in a piece beside a letter or anything
        else that is no such sign: nothing is merged across from a word to them."""
        pairs = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        signs = {c for c in {*map(chr, range(128)), *"".join(pairs)} - {MARK} if not c.isalpha() and not c.isdecimal()}
        while mixed := {c for pair in pairs if MARK not in pair and len(signs & set(pair)) == 1 and pair[0] != pair[1] for c in pair} & signs:
            signs -= mixed
        return "".join(sorted(signs))

    def merged(self, unit: str) -> list[str]:
        """Neighbours that make the piece of the best score are joined, the leftmost first, until
        none make a piece. Short units are searched for the best, long ones keep a heap."""
        parts, score, none = list(unit), self.score.get, float("inf")
        if len(parts) > SHORT:
            return self._merged_long(parts)
        ranks = [score(a + b, none) for a, b in zip(parts, parts[1:])]  # noqa: B905
        while ranks and (best := min(ranks)) is not none:
            i = ranks.index(best)
            del ranks[i]
            parts[i] = piece = parts[i] + parts.pop(i + 1)
            if i:
                ranks[i - 1] = score(parts[i - 1] + piece, none)
            if i < len(ranks):
                ranks[i] = score(piece + parts[i + 1], none)
        return parts

    def _merged_long(self, parts: list[str]) -> list[str]:
        after = [*range(1, len(parts)), -1]
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            piece = parts[i] + parts[j]
            if piece in self.score:
                heapq.heappush(heap, (self.score[piece], i, piece))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, piece = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j < 0 or parts[i] + parts[j] != piece:
                continue  # one of the two has been joined with another since
            parts[i], parts[j] = piece, ""
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return list(filter(None, parts))

    def encoded(self, unit: str) -> tuple[int, str, str, bytes]:
        """Of a unit: the number of ids, the ids, each with a space behind it, the decoded text,
        and the bytes of normalised text that each id covers."""
        parts = self.merged(unit)
        try:
            ids, sizes = zip(*[self.shown[p] for p in parts], strict=True)
            return len(parts), "".join(ids), unit.replace(MARK, " "), b"".join(sizes)
        except KeyError:
            return self._encoded_unknown(parts)

    def _encoded_unknown(self, parts: list[str]) -> tuple[int, str, str, bytes]:
        ids: list[int] = []
        sizes: list[int] = []
        for part in parts:
            octets = part.encode()
            if part not in self.ids and self.fallback:  # the last of a letter's bytes covers it
                ids += [self.bytes[b] for b in octets]
                sizes += [0] * (len(octets) - 1) + [len(octets)]
            else:
                ids.append(self.ids.get(part, self.unknown))
                sizes.append(len(octets))
        return len(ids), "".join(f"{i} " for i in ids), self.plain(ids), np.array(sizes, dtype="<i4").tobytes()

    def encode(self, text: str | None) -> tuple[list[tuple[int, str, str, bytes]], np.ndarray]:
        """A text's units as ``Units`` has them, and the source bytes where its pieces begin,
        with the end of the last."""
        shown, origin = self.normalised((text or "").encode())
        units = list(map(self.units.__getitem__, self._cut(shown.decode())))
        sizes = np.frombuffer(b"".join([u[3] for u in units]), dtype="<i4")
        return units, origin[np.concatenate([[0], np.cumsum(sizes)])]

    def _cut(self, shown: str) -> list[str]:
        """Words with the spaces before them, runs of signs, and spaces that nothing follows."""
        return self.cut(shown) if self.cuts else [shown] if shown else []

    # decoding

    def plain(self, ids: list[int]) -> str:
        """The text of ids that stand in the middle of a text."""
        out, octets = [], bytearray()
        for i in ids:
            if i in self.octet:
                octets.append(self.octet[i])
                continue
            if octets:
                out.append(shown_bytes(bytes(octets)))
                octets.clear()
            if self.kinds[i] == _UNKNOWN:
                out.append(self.unknown_text)
            elif self.kinds[i] != _CONTROL:
                out.append(self.pieces[i].replace(MARK, " "))
        if octets:
            out.append(shown_bytes(bytes(octets)))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: the space that stands for a text's start is left out. Where spaces
        are trimmed, so are those of the pieces after it, until some text has come."""
        dropped = 0
        for i in ids if self.dummy or self.trim else ():
            if self.kinds[i] == _CONTROL:
                continue
            led = self.kinds[i] == _NORMAL and self.pieces[i].startswith(MARK)
            dropped += led
            if not led or not self.trim or self.pieces[i] != MARK:
                break
        return self.plain(ids)[dropped:]


def shown_bytes(octets: bytes) -> str:
    """Text of bytes; each byte that is part of no letter becomes a replacement mark."""
    try:
        return octets.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(octets):
            for size in (1, 2, 3, 4):
                try:
                    out.append(octets[at : at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                at += 1
        return "".join(out)


_models: dict[str, Model] = {}


def model(file: str) -> Model:
    """One per worker process."""
    if file not in _models:
        with open(file, "rb") as f:
            _models[file] = Model(f.read())
    return _models[file]


def encode(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, starts, ends`` of every row's whole text: ids without an end id, and the
    span of source bytes of each (UTF-8, end exclusive; the bytes of a letter without a
    piece: the last has the letter, those before it an empty span). The spans cover the text.

    Null and empty texts have no ids. Repeated rows and null ids are encoded like any
    others; an empty table gives no rows. Texts and words of any length take time in
    proportion, but for a logarithm.
    """
    ship(docs.sparkSession)

    @F.pandas_udf("ids array<int>, starts array<long>, ends array<long>")
    def encoded(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for units, places in map(model(file).encode, texts):
            ids = np.array("".join([u[1] for u in units]).split(), dtype=np.int32)
            rows.append((ids, places[:-1], places[1:]))
        return pd.DataFrame(rows, columns=["ids", "starts", "ends"])

    rows = pick(docs, id_col, text_col).toDF("doc_id", "text")
    return rows.select("doc_id", encoded("text").alias("found")).select("doc_id", "found.*")


def decode(rows: DataFrame, file: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of the ids (null ids: null)."""
    ship(rows.sparkSession)

    @F.pandas_udf("string")
    def decoded(ids: pd.Series) -> pd.Series:
        one = model(file).decode
        return pd.Series([None if i is None else one(list(i)) for i in ids], dtype="object")

    return rows.withColumn("decoded", decoded(ids_col))


def digests(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32``: what ``encode``, with the model's end
    id, and ``decode`` give, without moving the ids; the last is over the places where pieces
    begin and the end of the last, as little-endian 64-bit numbers."""
    ship(docs.sparkSession)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long")
    def hashed(texts: pd.Series) -> pd.DataFrame:
        one, rows = model(file), []
        for units, places in map(one.encode, texts):
            ids = "".join([u[1] for u in units]) + str(one.end_id)
            if one.trim or not one.dummy:
                decoded = one.decode([int(i) for i in ids.split()])
            else:
                decoded = "".join([u[2] for u in units])[1:]  # the first unit begins with the mark of the start
            rows.append((
                len(places), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(),
                zlib.crc32(places.astype("<i8").tobytes()),
            ))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"])

    rows = pick(docs, id_col, text_col).toDF("doc_id", "text")
    return rows.select("doc_id", hashed("text").alias("found")).select("doc_id", "found.*")
