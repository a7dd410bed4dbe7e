from collections import Counter

import pytest
from test_text import python_normal

from lectern.operators import metrics


def python_f1(prediction, gold):
    p, g = python_normal(prediction).split(), python_normal(gold).split()
    same = sum((Counter(p) & Counter(g)).values())
    return 2 * same / (len(p) + len(g)) if same else 0.0


CASES = [
    (1, "1976", ["1976"]),
    (2, "the cat sat on the mat", ["a cat on mat", "cat sat"]),
    (3, "", ["the"]),
    (4, None, ["anything"]),
    (5, "x x y", ["x y y", "x x"]),
    (6, "The", ["x"]),
    (7, "été, the Paris", ["Paris été", "paris"]),
]


@pytest.fixture()
def given(spark):
    references = spark.createDataFrame([(i, g) for i, _, g in CASES], "id long, golds array<string>")
    predictions = spark.createDataFrame([(i, p) for i, p, _ in CASES if p is not None], "id long, prediction_text string")
    return references, predictions


def test_scores_per_gold(given):
    rows = metrics.per_gold_scores(*given).collect()
    assert len(rows) == sum(len(g) for _, _, g in CASES)
    cases = {i: (p, g) for i, p, g in CASES}
    for r in rows:
        prediction, golds = cases[r.id]
        gold = golds[r.gold_no]
        em = prediction is not None and python_normal(prediction) == python_normal(gold)
        assert r.exact_match == float(em)
        assert r.f1 == pytest.approx(0.0 if prediction is None else python_f1(prediction, gold))


def test_worked_example(spark):
    references = spark.createDataFrame([("a", ["1976"])], "id string, golds array<string>")
    predictions = spark.createDataFrame([("a", "1976")], "id string, prediction_text string")
    assert tuple(metrics.evaluate(references, predictions).first()) == (100.0, 100.0, 1)


def test_missing_prediction_counts(given):
    row = metrics.evaluate(*given).first()
    assert row.total == len(CASES)
    expected = [0.0 if p is None else python_f1(p, g[0]) for _, p, g in CASES]
    assert row.f1 == pytest.approx(100 * sum(expected) / len(CASES), abs=1e-6)
    best = metrics.evaluate(*given, all_golds=True).first()
    assert best.f1 >= row.f1
    assert [r.id for r in metrics.unanswered(*given).collect()] == [4]


def test_references_without_golds_count(spark):
    references = spark.createDataFrame([(1, ["a b"]), (2, []), (3, None)], "id long, golds array<string>")
    predictions = spark.createDataFrame([(1, "a b"), (2, "c")], "id long, prediction_text string")
    for every in (False, True):
        got = metrics.evaluate(references, predictions, every).first()
        assert (got.total, got.exact_match, got.f1) == (3, pytest.approx(100 / 3, abs=1e-6), pytest.approx(100 / 3, abs=1e-6))
