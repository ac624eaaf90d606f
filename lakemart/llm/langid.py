"""Languages of texts: scripts narrow the choice, Viterbi labels spans of words."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, ship

# First code points of blocks and their script. Letters elsewhere are of script 0.
SCRIPTS = [
    (0x0041, "Latin"), (0x0250, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "other"), (0x0900, "Devanagari"), (0x0980, "Bengali"),
    (0x0A00, "other"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "other"), (0x0E00, "Thai"), (0x0E80, "other"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1380, "other"), (0x1E00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "other"), (0x3040, "Kana"), (0x3100, "other"), (0x3400, "Han"), (0xA000, "other"),
    (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "other"), (0x20000, "Han"), (0x30000, "other"),
]
#: Hash buckets of letter trigrams.
BUCKETS = 1 << 15
#: Added to each bucket's count of each language.
SMOOTHING = 0.5
#: What a change of language between two words costs, in natural logarithms of odds.
SWITCH = 8.0
#: A language is a candidate for a script that has at least this part of its letters.
SCRIPT_SHARE = 0.005
#: Learned languages, at most: their table is collected and broadcast.
MAX_LANGUAGES = 64
#: Code points handled at once.
_CHUNK = 1 << 20


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, list[str]]:
    """By code point: the lower-case letter (0 for what is no letter); the script's number."""
    lower = np.zeros(sys.maxunicode + 1, dtype=np.uint32)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if unicodedata.category(c)[0] == "L":
            small = c.lower()
            lower[i] = ord(small) if len(small) == 1 else i
    names = ["other", *sorted({name for _, name in SCRIPTS} - {"other"})]
    script = np.zeros(sys.maxunicode + 1, dtype=np.int8)
    starts = [start for start, _ in SCRIPTS] + [sys.maxunicode + 1]
    for (start, name), end in zip(SCRIPTS, starts[1:], strict=True):
        script[start:end] = names.index(name)
    return lower, script, names


@dataclass
class Letters:
    """The letters of some texts: words are runs of letters of one text."""

    bucket: np.ndarray  # of the trigram that ends at each letter
    word: np.ndarray  # first letter of each word
    place: np.ndarray  # code point at which each word starts, counted over all texts
    length: np.ndarray  # letters of each word
    script: np.ndarray  # of each word's first letter
    text: np.ndarray  # number of the text of each word


def letters_of(texts: list[str]) -> Letters:
    lower, script, _ = _tables()
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    folded = lower[points]
    at = np.flatnonzero(folded)
    if not len(at):
        empty = np.empty(0, dtype=np.int64)
        return Letters(empty, empty, empty, empty, empty, empty)
    text = np.repeat(np.arange(len(texts)), sizes)[at]
    begins = np.ones(len(at), dtype=bool)
    begins[1:] = (at[1:] != at[:-1] + 1) | (text[1:] != text[:-1])
    word = np.flatnonzero(begins)
    c = folded[at].astype(np.uint64)
    before = np.zeros_like(c)
    before[1:] = np.where(begins[1:], 0, c[:-1])
    earlier = np.zeros_like(c)
    earlier[1:] = np.where(begins[1:], 0, before[:-1])
    mixed = (c * np.uint64(0x9E3779B97F4A7C15)) ^ (before * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (earlier * np.uint64(0x165667B19E3779F9))
    mixed ^= mixed >> np.uint64(29)
    bucket = ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 15)).astype(np.int64)
    length = np.diff(np.append(word, len(at)))
    return Letters(bucket, word, at[word], length, script[points[at[word]]], text[word])


def _chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Whole texts, about ``_CHUNK`` code points at a time; (number of the first, texts)."""
    first = total = 0
    for i, t in enumerate(texts):
        if i > first and total + len(t) > _CHUNK:
            yield first, texts[first:i]
            first, total = i, 0
        total += len(t)
    if texts:
        yield first, texts[first:]


@dataclass
class Model:
    languages: list[str]
    weight: np.ndarray  # bucket x language: log probability, less the mean of the languages
    candidates: np.ndarray  # script x language: whether it is written so
    usual: int  # the most common language


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts trigrams and scripts over the whole texts of all rows whose label is not null.
    Each task adds up its own counts; the sums, at most ``BUCKETS`` rows for each
    language, come to the driver."""
    ship(docs.sparkSession)
    rows = pick(docs, text_col, lang_col).toDF("text", "lang").where("lang is not null and text is not null")
    languages = [r[0] for r in rows.select(F.col("lang").cast("string")).distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages.sort()

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, _, names = _tables()
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            for lang, texts in frame.groupby("lang")["text"]:
                total = sums.setdefault(lang, np.zeros(BUCKETS + len(names), dtype=np.int64))
                for _, some in _chunks(texts.tolist()):
                    found = letters_of(some)
                    total[:BUCKETS] += np.bincount(found.bucket, minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(found.script, weights=found.length, minlength=len(names)).astype(np.int64)
        for lang, total in sums.items():
            seen = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "feature": seen, "n": total[seen]})

    labelled = rows.select("text", F.col("lang").cast("string").alias("lang"))
    summed = labelled.mapInPandas(count, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    table = summed.toPandas()
    return _model(languages, table)


def _model(languages: list[str], table: pd.DataFrame) -> Model:
    _, _, names = _tables()
    counts = np.zeros((BUCKETS + len(names), len(languages)))
    for i, lang in enumerate(languages):
        own = table[table["lang"] == lang]
        counts[own["feature"].to_numpy(np.int64), i] = own["n"]
    grams, scripts = counts[:BUCKETS] + SMOOTHING, counts[BUCKETS:]
    weight = np.log(grams / grams.sum(axis=0)) if languages else grams
    weight -= weight.mean(axis=1, keepdims=True) if languages else 0
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    usual = int(scripts.sum(axis=0).argmax()) if languages else 0
    return Model(languages, weight.astype(np.float32), share >= SCRIPT_SHARE, usual)


def best_paths(scores: np.ndarray, begins: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """The labels of each text's words with the greatest sum of scores, less ``switch`` for
    each change: Viterbi over all texts side by side, one word at a time."""
    states = scores.shape[1]
    path = np.zeros(len(scores), dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    begin, length = begins[order], lengths[order]
    if not len(order) or not states:
        return path
    # texts with more than t words are the first so many
    active = np.searchsorted(-length, -np.arange(length[0]), side="left")
    origin = np.zeros(scores.shape, dtype=np.int16)
    best = scores[begin[: active[0]]].astype(np.float64)
    own = np.arange(states)
    for t in range(1, length[0]):
        best = best[: active[t]]
        top = best.argmax(axis=1)
        jump = best[np.arange(len(best)), top] - switch
        stay = best >= jump[:, None]
        rows = begin[: active[t]] + t
        origin[rows] = np.where(stay, own, top[:, None])
        best = np.where(stay, best, jump[:, None]) + scores[rows]
        path_end = length[: active[t]] == t + 1
        path[rows[path_end]] = best[path_end].argmax(axis=1)
    short = length == 1
    path[begin[short]] = scores[begin[short]].argmax(axis=1)
    for t in range(length[0] - 1, 0, -1):
        rows = begin[: active[t]] + t
        path[rows - 1] = origin[rows, path[rows]]
    return path


def label(texts: list[str], model: Model, switch: float = SWITCH) -> tuple[list[str], list[float], list[list[tuple[int, int, str]]]]:
    """Language, score and spans of each text."""
    n = len(model.languages)
    parts = []
    for first, some in _chunks(texts):
        found = letters_of(some)
        if len(found.word):
            scores = np.add.reduceat(model.weight[found.bucket], found.word, axis=0) if n else np.zeros((len(found.word), 0))
            allowed = model.candidates[found.script]
            none = ~allowed.any(axis=1)
            scores = np.where(allowed | none[:, None], scores, scores.min(initial=0.0) - 1e4)
            scores[none] = 0.0  # a script that no learned language has says nothing
            offset = np.cumsum([0, *(len(t) for t in some)])[found.text]
            parts.append((scores, found.place - offset, found.length, found.text + first))
    if not parts or not n:
        return ["und"] * len(texts), [0.0] * len(texts), [[] for _ in texts]
    scores, place, length, text = (np.concatenate([p[i] for p in parts]) for i in range(4))
    words = np.bincount(text, minlength=len(texts))
    begins = np.cumsum(words) - words
    some = words > 0
    path = best_paths(scores, begins[some], words[some], switch)
    letters = np.bincount(text * n + path, weights=length, minlength=len(texts) * n).reshape(len(texts), n)
    flat = ~scores.any(axis=1)
    known = np.bincount(text[~flat], minlength=len(texts)) > 0
    chosen = np.where(known, letters.argmax(axis=1), model.usual)
    share = letters[np.arange(len(texts)), chosen] / np.maximum(letters.sum(axis=1), 1)
    names = [model.languages[c] if w else "und" for c, w in zip(chosen, some, strict=True)]
    change = np.ones(len(path), dtype=bool)
    change[1:] = (path[1:] != path[:-1]) | (text[1:] != text[:-1])
    heads = np.flatnonzero(change)
    tails = np.append(heads[1:], len(path)) - 1
    spans: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    for t, s, e, p in zip(text[heads].tolist(), place[heads].tolist(), (place[tails] + length[tails]).tolist(), path[heads].tolist(), strict=True):
        spans[t].append((s, e, model.languages[p]))
    return names, np.where(some, share, 0.0).tolist(), spans


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` of every row's whole text.

    A word is a run of letters. Its script narrows the languages to those written in it;
    trigrams score these; Viterbi gives each text the labels of the greatest sum, where
    every change of language costs ``switch``. ``spans`` are the runs of one label (start,
    end, lang; code points). ``lang_pred`` has the most letters, ``score`` is its part of
    them. Null texts and texts without a letter are ``und`` with score 0 and no spans; so is
    everything under a model that has learned no language. Equal sums: the first language
    in sorted order. Repeated rows and null ids are labelled like any others.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"

    @F.pandas_udf(kind)
    def labelled(texts: pd.Series) -> pd.DataFrame:
        names, scores, spans = label(texts.tolist(), shared.value, switch)
        as_rows = [[{"start": s, "end": e, "lang": name} for s, e, name in one] for one in spans]
        return pd.DataFrame({"lang_pred": names, "score": scores, "spans": as_rows})

    rows = pick(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.withColumn("found", labelled("text")).select("doc_id", "found.lang_pred", "found.score", "found.spans")
