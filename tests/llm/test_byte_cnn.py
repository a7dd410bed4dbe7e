import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectern.llm import byte_cnn
from lectern.llm.byte_cnn import PAD, Shape, fit, forward, gradient, lay_out, probabilities, production_rows, start_weights
from lectern.llm.kernels import text_bytes
from lectern.llm.ngram_lm import fold

SMALL = Shape(embedding=3, width=8, stride=4, filters=5, half=32, hidden=4)
TEXTS = ["", "abc", "x" * 32, "Ünï çödé", "hello world " * 7, "".join(chr(97 + (i * i) % 26) for i in range(300)), "y" * 33]


def laid(texts, shape=SMALL):
    return lay_out(*text_bytes(pa.array(texts)), shape)


def weights():
    rng = np.random.default_rng(2)
    return {k: v + 0.05 * rng.normal(size=v.shape) for k, v in start_weights(SMALL, 1).items()}


def plain_logit(w, shape, text):
    """The network by its definition, one window at a time."""
    data = list(text.encode()) + [PAD] * (shape.half + shape.width)
    size = len(text.encode())
    halves = max(1, math.ceil(size / shape.half))
    of_half = []
    for h in range(halves):
        found = []
        for at in range(h * shape.half, (h + 1) * shape.half, shape.stride):
            if at < size or at == 0:
                read = np.concatenate([w["bytes"][data[at + j] if at + j < size else PAD] for j in range(shape.width)])
                found.append(np.maximum(read @ w["filters"] + w["filters_0"], 0))
        of_half.append(found)
    units = []
    for a in range(max(1, halves - 1)):
        both = of_half[a] + (of_half[a + 1] if halves > 1 else [])
        pooled = np.concatenate([np.mean(both, axis=0), np.max(both, axis=0)])
        units.append(np.maximum(pooled @ w["hidden"] + w["hidden_0"], 0))
    return float(np.max(units, axis=0) @ w["out"] + w["out_0"][0])


def test_forward_equals_the_definition(monkeypatch):
    w = weights()
    want = [plain_logit(w, SMALL, t) for t in TEXTS]
    assert np.allclose(forward(w, SMALL, laid(TEXTS))[0], want, rtol=1e-4, atol=1e-5)
    monkeypatch.setattr(byte_cnn, "HALVES", 2)  # blocks and neighbours change nothing
    assert np.allclose(forward(w, SMALL, laid(TEXTS))[0], want, rtol=1e-4, atol=1e-5)
    for t, logit in zip(TEXTS, want):
        assert np.allclose(forward(w, SMALL, laid([t]))[0], [logit], rtol=1e-4, atol=1e-5)


def test_gradient_equals_differences():
    w, texts, targets = weights(), laid(TEXTS), np.array([0, 1, 1, 0, 1, 0, 1.0])
    _, g = gradient(w, SMALL, texts, targets, 2.0)
    rng = np.random.default_rng(0)
    for name, value in w.items():
        for _ in range(8):
            at = tuple(rng.integers(0, s) for s in value.shape)
            if name == "bytes":
                at = (int(rng.choice([97, 101, 120, PAD])), at[1])
            sides = []
            for step in (1e-4, -1e-4):
                moved = {k: v.copy() for k, v in w.items()}
                moved[name][at] += step
                sides.append(gradient(moved, SMALL, texts, targets, 2.0)[0])
            slope = (sides[0] - sides[1]) / 2e-4
            assert abs(slope - g[name][at]) <= 5e-3 * max(0.02, abs(slope)), (name, at)


@pytest.fixture(scope="module")
def corpus(spark):
    """Junk holds a passage of signs somewhere, good texts do not; labels for some."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    docs, labels = [], []
    for i in range(900):
        junk = rng.random() < 0.3
        text = [rng.choice(words) for _ in range(rng.randrange(10, 200))]
        if junk:
            at = rng.randrange(len(text))
            text[at:at] = [rng.choice(words) + "$$%" for _ in range(30)]
        docs.append((i, " ".join(text)))
        labels.append((i, int(not junk)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy_and_equal_runs(corpus):
    docs, labels = corpus
    model = fit(docs, labels, production_rows(), rounds=5)
    held = model.score(docs).filter(fold("doc_id", 5) == 0).join(labels, "doc_id").collect()
    right = [(r.score >= 0.3) == (r.quality == 1) for r in held]
    assert len(held) > 100 and sum(right) >= 0.95 * len(right)
    again = fit(docs.repartition(7), labels.repartition(3), production_rows(), rounds=5)
    assert all(np.array_equal(model.weights[k], again.weights[k]) for k in model.weights)


def test_held_out_labels_are_not_read(corpus):
    docs, labels = corpus
    flipped = labels.withColumn("quality", F.when(fold("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (fit(docs, rows, production_rows(), max_rows=60, rounds=1) for rows in (labels, flipped))
    assert all(np.array_equal(one.weights[k], two.weights[k]) for k in one.weights)


def test_the_sample_holds_a_text_once(spark, corpus):
    docs, labels = corpus
    copies = spark.range(1000, 3000).select(F.col("id").alias("doc_id"), F.lit("one text of many copies").alias("text"))
    rows = byte_cnn._sample(
        docs.unionByName(copies), labels.unionByName(copies.select("doc_id", F.lit(1).alias("quality"))), F.lit(True), 5000, 5, "doc_id", "text", "quality"
    ).collect()
    assert len(rows) == 901 and sum(r.text.startswith("one text") for r in rows) == 1
    assert len(byte_cnn._sample(docs, labels, F.lit(True), 17, 5, "doc_id", "text", "quality").collect()) == 17


def test_awkward_rows(awkward, nothing, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (7, 0), (7, 0), (None, 1), (6, None), (99, 0), (8, 5)], "doc_id long, quality int")
    model = fit(awkward, labels, rounds=1)
    rows = model.score(awkward).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(round(r.score, 6))
    assert len(by[1] | by[8]) == 1 and by[2] == by[3]  # equal texts score alike, null as empty
    assert model.score(nothing).collect() == []
    prior = fit(awkward, labels.filter("quality = 1"))
    assert prior.weights is None and {r.score for r in prior.score(awkward).collect()} == {1.0}
    assert {r.score for r in fit(nothing, labels.limit(0)).score(awkward).collect()} == {0.5}


def test_probabilities_stay_inside():
    assert (0 < probabilities(np.array([-1e6, 0, 1e6]))).all() and (probabilities(np.array([-1e6, 0, 1e6])) < 1).all()
