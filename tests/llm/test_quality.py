"""Co-training: both views give labels, both are weighed, confidence is calibrated."""

import random

import numpy as np

from sievework.llm import base, quality

from .test_operators import WORDS, docs_of


def rows(n, seed):
    """Good documents have short lines and good words; one in five hides one of the two signs."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        good = rng.random() < 0.5
        told = good if rng.random() < 0.85 else not good  # what the words say
        shown = good if rng.random() < 0.85 else not good  # what source and layout say
        words = [rng.choice(WORDS) + ("" if told else rng.choice(["%%%", "", "##"])) for _ in range(30)]
        text = ("\n" if shown else " ").join(words)
        out.append((text, "books" if shown else "spam", "en", len(text), int(good)))
    return out


def test_both_views_teach_and_are_weighed():
    labelled, unlabelled, held = rows(500, 1), rows(600, 2), rows(400, 3)
    model = quality.cotrain(labelled, [r[:4] for r in unlabelled], sure=0.8)
    assert sum(a for a, _ in model.rounds) > 50 and sum(b for _, b in model.rounds) > 50
    assert model.mix[1] > 0.1 and model.mix[2] > 0.1
    view = quality.TextView(model.buckets, model.grams)
    a, b = model.text.logit(view.matrix([r[0] for r in held])), model.meta.logit(quality.meta_matrix(held))
    y = np.array([r[4] for r in held])
    right = [((p >= 0.5) == y).mean() for p in (model.score(a, b), quality._sigmoid(a), quality._sigmoid(b))]
    assert right[0] >= max(right[1:]) - 0.01 and right[0] >= 0.8, right
    sure = quality._sigmoid(b)
    assert abs(sure[sure > 0.5].mean() - y[sure > 0.5].mean()) < 0.1  # as often right as it says


def test_sample_is_the_same_however_dealt(spark):
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    a = sorted(r.doc_id for r in base.first_by_hash(df.repartition(7), "doc_id", 100).collect())
    b = sorted(r.doc_id for r in base.first_by_hash(df.repartition(2), "doc_id", 100).collect())
    assert a == b and len(a) == 100 and len(base.first_by_hash(df.limit(5), "doc_id", 100).collect()) == 5


def test_long_empty_and_missing(spark):
    docs = docs_of(spark, [(1, None), (2, ""), (3, "w " * 60_000), (4, "\n\n"), (None, "x"), (5, "a"), (5, "a")])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 0), (4, 0, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.score_documents(docs, labels).collect()
    assert len(out) == 7 and all(0 <= r.score <= 1 and 0 <= r.toxic_score <= 1 for r in out)
    assert quality.score_documents(docs.limit(0), labels).count() == 0
