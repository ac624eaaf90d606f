import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import toxicity
from lakemart.llm.queries import documents as documents_of
from lakemart.llm.queries import held_out, op5_nnpu

BAD = ["awful", "vile", "nasty"]


def corpus(rng, n=600):
    words = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        text = rng.choices(words, k=40) + (rng.sample(BAD, 2) if bad else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        if i % 2 == 0:
            labels.append((i, int(bad)))
    return rows, labels


def test_learns_from_positives_and_unlabelled(spark, stored):
    rows, labels = corpus(random.Random(9))
    marks = spark.createDataFrame(labels + [(10**6, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(stored(rows), marks)
    scores = toxicity.Classifier.score(model, [t for _, t in rows])
    bad = [s for (i, _), s in zip(rows, scores, strict=True) if i % 5 == 0]
    good = [s for (i, _), s in zip(rows, scores, strict=True) if i % 5]
    assert min(bad) > toxicity.THRESHOLD and np.mean([s < toxicity.THRESHOLD for s in good]) > 0.99
    assert model.score(["VILE, awful!"])[0] > model.score(["w1 w2"])[0]


def test_gradient_is_of_the_stated_risk():
    rng = np.random.default_rng(1)
    def sparse(n):
        rows = [np.flatnonzero(rng.random(6) < 0.5) for _ in range(n)]
        return toxicity.Sparse(np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])]))
    p, u = sparse(7), sparse(9)
    dense = lambda s: np.array([np.bincount(s.columns[a:b], minlength=6) for a, b in zip(s.starts, s.starts[1:])])
    w = rng.normal(size=6)
    assert np.allclose(p.times(w), dense(p) @ w)
    g = rng.normal(size=9)
    assert np.allclose(u.transposed_times(g, 6), dense(u).T @ g)
    # with many steps and no penalty the risk does not get worse than at the start
    prior = 0.3
    def risk(w, b):
        gp, gu = p.times(w) + b, u.times(w) + b
        return prior * np.logaddexp(0, -gp).mean() + max(0, np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean())
    before = risk(np.zeros(6), np.log(prior / (1 - prior)))
    assert risk(*toxicity.fit(p, u, prior, 6, steps=300, rate=0.02, penalty=0.0)) < before


def test_odd_tables(spark, stored, documents):
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (2, None), (3, ""), (4, "d " * 100_000)]
    model = toxicity.train(stored(rows), no_labels)
    got = toxicity.score(stored(rows).withColumn("c0", F.lit(1)), model, name="p")
    assert got.columns[-1] == "p" and got.count() == 6
    assert got.where("p between 0 and 1").count() == 6
    clashing = stored(rows).withColumns({"score": F.lit(2.0), "p": F.lit("x")})
    assert toxicity.drop_toxic(clashing, model).dtypes == clashing.dtypes
    assert toxicity.drop_toxic(clashing, model).count() == 6
    assert toxicity.score(documents([]), model).count() == 0
    assert toxicity.train(documents([]), no_labels).words == []


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = op5_nnpu(spark, folder).join(labels, "doc_id").where("held_out and toxic is not null").select("score", "predicted", "toxic").toPandas()
    caught, marked = got[got.toxic == 1], got[got.predicted == 1]
    assert (caught.predicted == 1).mean() > 0.6
    assert (marked.toxic == 1).mean() > 0.8


def test_smallest_tables_keep_clean_documents(spark):
    folder = "/root/testdata/sf0.001"  # 9 confirmed positives to learn from
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = op5_nnpu(spark, folder).join(labels, "doc_id").where("held_out and toxic = 0").select("predicted").toPandas()
    assert len(got) > 10 and got.predicted.mean() < 0.1


@pytest.mark.parametrize(("positives", "most"), [(10, 0.1), (30, 0.03)])
def test_few_positives_keep_clean_documents(spark, positives, most):
    folder = "/root/testdata/sf0.1"
    docs = documents_of(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic is not null")
    learned = labels.join(docs.where(~held_out()).select("doc_id"), "doc_id", "left_semi").orderBy("doc_id").toPandas()
    bad, good = learned[learned.toxic == 1], learned[learned.toxic == 0]
    some = [*bad.doc_id[:positives], *good.doc_id[: len(good) * positives // len(bad)]]
    model = toxicity.train(docs.where(~held_out()), labels.where(F.col("doc_id").isin([int(i) for i in some])))
    clean = [r.text or "" for r in docs.where(held_out()).join(labels.where("toxic = 0"), "doc_id", "left_semi").select("text").collect()]
    scores = np.array(model.score(clean))
    assert len(clean) > 500 and (scores >= toxicity.THRESHOLD).mean() < most
    assert model.score([""])[0] < toxicity.THRESHOLD
