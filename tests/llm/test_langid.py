import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from lakemart.llm import langid
from lakemart.llm.queries import held_out, op4_script_viterbi

EN = "the house of the other thing that they think this with them and there was nothing more than the weather".split()
DE = "der die das und ich nicht ein eine schön über straße zwischen auch noch wieder werden gewesen".split()
RU = "это очень хороший день потому что мы вместе идем домой".split()


def labelled(rng, words, n):
    return " ".join(rng.choices(words, k=n))


def learned(stored):
    rng = random.Random(1)
    rows = [(i, labelled(rng, w, 60), lang) for i, (w, lang) in enumerate([(EN, "en"), (DE, "de"), (RU, "ru")] * 10)]
    return langid.learn(stored(rows + [(99, "ignored", None), (98, None, "en")]))


def brute_path(scores, switch):
    best = max(
        itertools.product(range(scores.shape[1]), repeat=len(scores)),
        key=lambda p: sum(scores[i, s] for i, s in enumerate(p)) - switch * sum(a != b for a, b in itertools.pairwise(p)),
    )
    return sum(scores[i, s] for i, s in enumerate(best)) - switch * sum(a != b for a, b in itertools.pairwise(best))


def test_paths_are_the_best():
    rng = np.random.default_rng(3)
    for _ in range(60):
        lengths = rng.integers(1, 7, size=rng.integers(1, 6))
        begins = np.cumsum(lengths) - lengths
        scores = rng.normal(size=(lengths.sum(), 3)) * 3
        path = langid.best_paths(scores, begins, lengths, 2.0)
        for b, n in zip(begins, lengths, strict=True):
            p = path[b : b + n]
            value = scores[np.arange(b, b + n), p].sum() - 2.0 * (p[1:] != p[:-1]).sum()
            assert abs(value - brute_path(scores[b : b + n], 2.0)) < 1e-9


def test_mixed_text_gets_spans(stored):
    model = learned(stored)
    mixed = " ".join(EN[:9]) + ". " + " ".join(DE[:9]) + " " + " ".join(RU[:5]) + "!"
    names, scores, spans = langid.label([mixed, "", "12 !?", "漢字", " ".join(RU)], model)
    assert [s[2] for s in spans[0]] == ["en", "de", "ru"]
    assert mixed[spans[0][2][0] : spans[0][2][1]] == " ".join(RU[:5])
    assert names[1:3] == ["und", "und"] and scores[1:3] == [0.0, 0.0] and spans[1:3] == [[], []]
    assert names[3] in ("de", "en", "ru")  # letters of a script nobody learned
    assert (names[4], scores[4]) == ("ru", 1.0)


def test_rows(stored, documents):
    model = learned(stored)
    rows = [(1, " ".join(EN)), (1, " ".join(EN)), (None, " ".join(DE)), (2, None), (3, ""), (4, "…"), (5, " ".join(DE) * 5000)]
    got = langid.identify(stored(rows), model).collect()
    assert sorted(((r.doc_id, r.lang_pred) for r in got), key=repr) == sorted([(1, "en"), (1, "en"), (None, "de"), (2, "und"), (3, "und"), (4, "und"), (5, "de")], key=repr)
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.identify(documents([]), model).count() == 0
    nothing = langid.learn(documents([]))
    assert {r.lang_pred for r in langid.identify(stored(rows), nothing).collect()} == {"und"}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    got = op4_script_viterbi(spark, folder).join(truth, "doc_id").where("held_out and lang is not null")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    assert spark.range(1).select(held_out("id")).first()[0] is not None
