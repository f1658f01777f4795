import math

import numpy as np
import pytest

from conftest import SF_CHECK
from stratum.llm import quality
from stratum.llm.queries import op9_quality


def brute_contexts(texts):
    place, sign = quality.random_vectors()
    sums = np.zeros((quality.SLOTS, quality.DIM))
    for t in texts:
        ids = quality.slots_of(t or "", quality._Slots())
        for i, a in enumerate(ids):
            for j in range(max(0, i - quality.WINDOW), min(len(ids), i + quality.WINDOW + 1)):
                if j != i:
                    np.add.at(sums[a], place[ids[j]], sign[ids[j]])
    return (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1)).astype(np.float32)


def test_word_vectors_equal_brute_force(docs_of):
    texts = ["a b c d e", "a a a b", "", None, "x", "!! hello, world 42 !!", "b c"]
    got = quality.word_vectors(docs_of(list(enumerate(texts))).repartition(3))
    assert got == pytest.approx(brute_contexts(texts), abs=1e-6)
    assert not quality.word_vectors(docs_of([])).any()


def brute_score(text, model):
    """One document, word by word and unit by unit."""
    n, net = quality.DIM, model.network
    ids = quality.slots_of(text, quality._Slots()).tolist()
    x = [0.0] * (n + quality.MEASURES)
    if ids:
        for i in ids:
            for d in range(n):
                x[d] += float(model.vectors[i, d]) / len(ids)
        x[n:] = [math.sqrt(sum(v * v for v in x[:n])), sum(i == quality.REPEAT for i in ids) / len(ids),
                 sum(c.isupper() for c in text) / len(text), math.log(1 + len(ids)) / 10]
    z = [(v - m) / s for v, m, s in zip(x, net.mean, net.scale)]
    hidden = [math.tanh(sum(a * net.w1[i, j] for i, a in enumerate(z)) + net.b1[j]) for j in range(len(net.b1))]
    logit = sum(h * w for h, w in zip(hidden, net.w2)) + net.b2
    return 1 / (1 + math.exp(-logit / net.temperature))


def test_scores_equal_brute_force(docs_of, spark):
    rows = [(i, f"some plain words number{i} here and there") for i in range(15)]
    rows += [(i, f"BAD bad bad {i}!! bad bad") for i in range(15, 30)] + [(30, None), (31, ""), (32, "Ünï çode 42 ... X"), (33, "w " * 70_000)]
    labels = spark.createDataFrame([(i, int(i < 15)) for i in range(30)], "doc_id long, quality int")
    model = quality.fit(docs_of(rows), labels)
    got = {r.doc_id: r.score for r in quality.score(docs_of(rows), model).collect()}
    assert model.network.temperature > 0
    for i, text in rows:
        assert got[i] == pytest.approx(brute_score(text or "", model), abs=2e-4), i


def test_an_id_with_several_labels_has_the_greatest(docs_of, spark):
    rows = [(i, "good plain words here" if i < 9 else "bad!! bad!!") for i in range(18)]
    one = spark.createDataFrame([(i, int(i < 9)) for i in range(18)], "doc_id long, quality int")
    more = one.unionByName(spark.createDataFrame([(i, 0) for i in range(9)] * 3, "doc_id long, quality int")).repartition(5)
    a, b = quality.fit(docs_of(rows), one), quality.fit(docs_of(rows), more)
    assert (a.network.w1 == b.network.w1).all() and a.network.temperature == b.network.temperature


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 6))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = quality.train(x[:3000], y[:3000], epochs=30)
    s = net.scores(x[3000:])
    assert abs(s.mean() - y[3000:].mean()) < 0.06
    assert quality.log_loss(np.log(s / (1 - s)), y[3000:]) < 0.6


def test_frame_edges(docs_of, spark):
    rows = [(i, "good plain words here") for i in range(20)] + [(i, "bad!! bad!! bad!!") for i in range(20, 40)]
    rows += [(90, None), (91, ""), (92, "word " * 100_000), (92, "word " * 100_000), (None, "a")]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(40)] + [(None, 1), (3, None)],
                                   "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert len(got) == 44 and all(0 <= s <= 1 for s in got.values())
    assert got[0] > 0.5 > got[25]
    kept = quality.keep(docs, model)
    assert kept.columns == docs.columns and {0, 19} <= {r.doc_id for r in kept.collect()}
    assert quality.score(docs_of([]), model).count() == 0
    blank = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, blank).collect()} == {0.5}
    assert quality.keep(docs, blank).count() == docs.count()


def test_held_out_accuracy(spark):
    y = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    got = op9_quality(spark, SF_CHECK).collect()
    assert len(got) == spark.read.parquet(f"{SF_CHECK}/documents.parquet").count()
    held = [r for r in got if r.held_out and r.doc_id in y]
    assert held and np.mean([r.predicted == y[r.doc_id] for r in held]) > 0.93
