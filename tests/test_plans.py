"""The reading plans on a corpus small enough to follow by hand."""

import math

import pytest

from lectern.operators.sparse import Bm25Index
from lectern.plans import reading
from lectern.plans.retrieval import retrieve_dense_for_dataset, retrieve_for_dataset

TEXTS = ["Seoul is the capital of Korea.", "Paris is the capital of France.", "Cats sleep all day."]
EXAMPLES = [
    ("a", "capital of Korea", TEXTS[0], (["Seoul"], [0])),
    ("b", "capital of France", TEXTS[1], (["Paris"], [0])),
]
SCHEMA = "id string, question string, context string, answers struct<text:array<string>,answer_start:array<int>>"


@pytest.fixture()
def examples(spark):
    return spark.createDataFrame(EXAMPLES, SCHEMA)


@pytest.fixture()
def passages(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "pid long, text string")


def test_retrieval_shapes(examples, passages):
    index = Bm25Index(passages)
    asked = examples.select("id", "question")
    predict = retrieve_for_dataset(index, asked, passages, k=1, predict=True)
    assert predict.columns == ["context", "id", "question"]
    results = {r.id: r for r in retrieve_for_dataset(index, examples, passages, k=2, first_only=True).collect()}
    assert results["a"].answers == "Seoul" and results["a"].original_context == TEXTS[0]
    full = {r.id: r for r in retrieve_for_dataset(index, examples, passages, k=1).collect()}
    assert full["b"].answers.text == ["Paris"]


def test_dense_retrieval(spark, passages):
    examples = spark.createDataFrame([(0, "q0"), (1, "q1")], "id long, question string")
    queries = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "qid long, vec array<float>")
    vectors = spark.createDataFrame([(0, [0.9, 0.1]), (1, [0.2, 0.8]), (2, [0.5, 0.5])], "pid long, vec array<float>")
    got = retrieve_dense_for_dataset(queries, vectors, examples, passages, k=2, predict=True)
    assert {r.id: r.context for r in got.collect()} == {"0": f"{TEXTS[0]} {TEXTS[2]}", "1": f"{TEXTS[1]} {TEXTS[2]}"}


def test_extractive(spark, examples):
    features = reading.extractive_features(examples)
    trained = {r.example_id: r for r in reading.extractive_train_features(examples).collect()}
    rows = []
    for r in features.collect():
        at = trained[r.example_id].start_position
        peak = [5.0 if i == at else 0.0 for i in range(len(r.tokens))]
        rows.append((r.feature_id, peak, peak))
    logits = spark.createDataFrame(rows, "feature_id string, start_logits array<double>, end_logits array<double>")
    predictions, _ = reading.extractive_answers(features, logits, examples)
    assert {r.id: r.prediction_text for r in predictions.collect()} == {"a": "Seoul", "b": "Paris"}
    assert tuple(reading.score(predictions, examples).first()) == (100.0, 100.0, 2)


def test_generative(spark, examples):
    row = reading.generative_inputs(examples).filter("example_id = 'a'").first()
    assert row.input == "question: capital of Korea context: Seoul is the capital of Korea </s>"
    assert row.target == "Seoul </s>"
    vocabulary = spark.createDataFrame(
        [(0, "<pad>", True), (1, "</s>", True), (2, "Seoul.", False), (3, "Paris", False)],
        "vocab_id int, token string, special boolean",
    )
    out = spark.createDataFrame([("a", [2, 1, -100]), ("b", [2, 3, 1])], "id string, ids array<int>")
    answers = reading.generative_answers(out, vocabulary, pad_id=0)
    assert {r.id: r.prediction_text for r in answers.collect()} == {"a": "Seoul", "b": "Seoul Paris"}
    scores = reading.score(answers, examples).first()
    assert scores.exact_match == 50.0 and scores.f1 == pytest.approx(100 * (1 + 2 / 3) / 2, abs=1e-4)


def test_augmented(spark, passages):
    questions = spark.createDataFrame([(0, "capital of Korea")], "qid long, question string")
    queries = spark.createDataFrame([(0, [2.0, 0.0])], "qid long, vec array<float>")
    vectors = spark.createDataFrame([(0, [3.0, 0.0]), (1, [3.0, 4.0]), (2, [0.0, 1.0])], "pid long, vec array<float>")
    hits, pairs = reading.augmented_inputs(queries, vectors, questions, passages, k=2)
    assert [(r.pid, r.score) for r in hits.orderBy("rank").collect()] == [(0, 2.0), (1, 1.2)]
    for r in pairs.collect():
        assert len(r.tokens) == len(r.attention_mask) == 512
        assert " ".join(t for t in r.tokens if t != "[PAD]") == f"capital of Korea {TEXTS[r.pid]}"
        assert sum(r.attention_mask) == 9
    p = 1 / (1 + math.exp(-0.8))
    # position 0: entry 5 wins only by its weight; position 1: the end marker
    logits = spark.createDataFrame(
        [(0, 1, 0, 5, 1.0), (0, 1, 0, 6, 0.0), (0, 2, 0, 5, 0.0), (0, 2, 0, 6, 1.0)]
        + [(0, r, 1, v, x) for r in (1, 2) for v, x in ((1, 2.0), (5, 0.0))],
        "id long, rank int, pos int, vocab_id int, logit double",
    )
    assert p > 0.5
    targets = spark.createDataFrame([(0, [5, 1, 3])], "id long, ids array<int>")
    for bound in (2, None):
        decoded, match = reading.augmented_answers(hits, logits, targets, max_hits=bound)
        assert [r.ids for r in decoded.collect()] == [[5, 1]]
        assert tuple(match.first()) == (1.0, 1)
