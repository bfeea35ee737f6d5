"""The toxicity classifier: features, ratios, held-out accuracy and odd rows."""

import random

import numpy as np
import pytest
from helpers import fold

from pitwall.llm import toxicity
from pitwall.llm.toxicity import Features, fitted, hashed, ratios, score_toxicity


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    docs, labels = [], []
    for k in range(400):
        own = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        bad = rng.random() < 0.2
        if bad:
            own[rng.randrange(len(own))] = rng.choice(("Vermin", "vile!", "WRETCH"))
        docs.append((k, " ".join(own)))
        labels.append((k, 1, int(bad)))
    return docs, labels


def scored(spark, docs, labels, **more):
    df = spark.createDataFrame([(i, t, "x", 0.5, 1) for i, t in docs], "doc_id long, text string, row string, score double, toxic int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return score_toxicity(df, marks, **more).select("row.*", "held_out", "score", "predicted").toPandas().iloc[:, [0, 5, 6, 7]]


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    got = scored(spark, docs, labels)
    truth = {i: y for i, _, y in labels}
    assert got.held_out.tolist() == [fold(i, 5) == 0 for i in got.doc_id]
    held = got[got.held_out]
    assert np.mean([p == truth[i] for i, p in zip(held.doc_id, held.predicted)]) > 0.95
    assert (got.predicted == (got.score >= 0.5)).all() and got.score.between(0, 1).all()


def test_held_out_labels_are_not_learned(spark, corpus):
    docs, labels = corpus
    turned = [(i, q, 1 - y if fold(i, 5) == 0 else y) for i, q, y in labels]
    assert scored(spark, docs, labels).equals(scored(spark, docs, turned))


def test_joins_agree_and_sample_is_bounded(spark, corpus):
    docs, labels = corpus
    known = scored(spark, docs, labels).sort_values("doc_id")
    assert np.allclose(known.score, scored(spark, docs, labels, broadcast_rows=0).sort_values("doc_id").score)
    few = scored(spark, docs, labels, sample_rows=60).sort_values("doc_id")
    assert abs(few.score.mean() - known.score.mean()) < 0.2


def test_odd_rows(spark, corpus):
    docs, labels = corpus
    odd = [(None, "vermin"), (1000, None), (1001, ""), (1002, "a"), (1003, "vermin " * 50_000), (1004, "é\U0001F600 \x00"), (1005, "vile!")]
    more = [(None, 0, 1), (1000, 1, None), (1001, 1, 7), (5, 1, 1), (5, 1, 0), (99_999, 1, 1)]
    got = scored(spark, docs + odd + docs[:5], labels + more)
    assert len(got) == len(docs) + len(odd) + 5
    by = {i: s for i, s in zip(got.doc_id, got.score) if i == i and i >= 1000}
    assert by[1000] == by[1001] == by[1002] and by[1003] > 0.5 and by[1005] > 0.5
    assert not got[got.doc_id.isna()].held_out.any()


def test_without_labels(spark, corpus):
    docs, labels = corpus
    assert set(scored(spark, docs[:20], [], ).score) == {0.5}
    assert set(scored(spark, docs[:20], [(i, q, 0) for i, q, _ in labels]).predicted) == {0}
    assert len(scored(spark, [], labels)) == 0


def test_features_by_hand():
    own = Features().of("AbcaB")
    runs = {"abcab"[k:k + n] for n in (2, 3, 4, 5) for k in range(6 - n)}
    assert sorted(own) == sorted({int(hashed(r)[-1]) for r in runs}) and len(Features().of("x")) == 0


def test_long_texts_in_stretches(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdeÉß 中") for _ in range(5000))
    whole = set(Features().of(text).tolist())
    monkeypatch.setattr(toxicity, "STRETCH", 700)
    parts = Features().of(text)
    assert set(parts.tolist()) == whole and len(parts) == len(whole)


def test_ratios_and_fit():
    counts = np.array([[3, 0, 0, 1], [0, 4, 0, 1]])
    r = ratios(counts)
    assert r[0] < 0 < r[1] and r[2] == 0 and r[3] == pytest.approx(np.log(2 / 9) - np.log(2 / 8))
    texts = [np.array([0, 3]), np.array([0]), np.array([1]), np.array([1, 3]), np.zeros(0, np.int64)]
    weights, intercept = fitted(texts, np.array([0.0, 0, 1, 1, 1]), r)
    # the gradient of the penalised loss is zero there
    z = np.array([sum(weights[b] * r[b] for b in t) * 10 / np.sqrt(max(len(t), 1)) + intercept for t in texts])
    slope = 1 / (1 + np.exp(-z)) - np.array([0.0, 0, 1, 1, 1])
    grad = [sum(s * r[b] * 10 / np.sqrt(len(t)) for s, t in zip(slope, texts) if b in t) + weights[b] for b in range(4)]
    assert np.abs(grad).max() < 0.05 and abs(slope.sum()) < 0.05
