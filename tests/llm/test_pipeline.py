"""The stages against plain Python, each on what the one before kept."""

import random

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from lakemart.llm.queries import tokenizer, toxicity_classifier
from lakemart.llm.toxicity import THRESHOLD

from .conftest import SCHEMA
from .test_jaccard import brute as near_groups
from .test_secret_scan import bare_spans, base_spans

BAD = ["vile", "awful", "nasty"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def corpus(rng):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.randint(30, 60))) for _ in range(120)]
    texts += [" ".join(rng.choices(words, k=30) + rng.sample(BAD, 3)) for _ in range(40)]
    texts += [texts[i].upper() for i in range(5)] + [texts[i] for i in range(5)]
    near = texts[7].split() + texts[8].split()
    texts += [" ".join(near), " ".join([*near[:-1], "changed"]), " ".join(["begun", *near])]
    own = [" ".join(rng.choices(words, k=40)) for _ in range(5)]
    texts += [f"{t} password = Secret{i:03d}x end" for i, t in enumerate(own[:2])] + [f"{t} token=exampletoken1" for t in own[2:]]
    texts += [None, "", "", "one"]
    return [(i * 2 + 1, t, "en", f"s{i % 6}", len(t or "")) for i, t in enumerate(texts)]


def cut(text, owners):
    spans = []
    base = base_spans(text)
    for k, s, e, v in base + bare_spans(text):
        alone = k != "bare" or len(owners[v]) < 3 and not any(a < e and b > s for _, a, b, _ in base)
        if alone and len(owners[v]) < 3:
            spans.append((s, e))
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out.append(text[at:s] + "[SECRET]")
        at = max(at, e)
    return "".join(out) + text[at:]


def test_stages_and_run(spark, tmp_path):
    rows = corpus(random.Random(4))
    folder = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 0, int(any(b in (t or "") for b in BAD))) for i, t, *_ in rows if i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.dtypes == docs.dtypes
        path = str(tmp_path / name)
        made.write.parquet(path)
        kept.append((docs, spark.read.parquet(path)))
        docs = kept[-1][1]
    rows_of = [(sorted(map(tuple, a.collect())), sorted(map(tuple, b.collect()))) for a, b in kept]

    before, after = rows_of[0]
    classifier = toxicity_classifier(spark, kept[0][0], folder)
    scores = classifier.score([r[1] or "" for r in before])
    assert after == [r for r, s in zip(before, scores, strict=True) if s < THRESHOLD]
    assert not any(b in (r[1] or "") for r in after for b in BAD) and len(after) > 120

    before, after = rows_of[1]
    last = {}
    for r in before:
        last[lower(r[1])] = max(r[0], last.get(lower(r[1]), -1))
    assert after == [r for r in before if last[lower(r[1])] == r[0]]

    before, after = rows_of[2]
    group = {d: (n, c) for d, n, c in near_groups([(r[0], r[1]) for r in before])}
    assert after == [r for r in before if group[r[0]][0] == 0 or group[r[0]][1] == r[0]] and len(after) < len(before)

    before, after = rows_of[3]
    owners = {}
    for _, t, _, owner, _ in before:
        for *_, v in base_spans(t or "") + bare_spans(t or ""):
            owners.setdefault(v, set()).add(owner)
    clean = [(i, t if t is None else cut(t, owners), lang, owner) for i, t, lang, owner, _ in before]
    assert [r[:4] for r in after] == clean and all(r[4] == len(r[1] or "") for r in after)
    assert sum("[SECRET]" in (r[1] or "") for r in after) == 2

    before, _ = rows_of[4]
    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    packed = kept[4][1].collect()
    lengths = {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t, *_ in before}
    assert {r.doc_id: r.length for r in packed} == lengths
    assert len({r.sequence_id for r in packed}) == int(np.ceil(sum(lengths.values()) / 2048))
    assert sorted((r.doc_id, r.length) for r in corpus_pipeline.run(spark, folder).collect()) == sorted(lengths.items())
