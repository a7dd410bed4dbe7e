"""Span decoding against a plain search over all pairs."""

import math
import random

import pytest

from lectern.operators import reader

SCHEMA = (
    "feature_id string, example_id long, window_no int, offsets array<struct<s:int,e:int>>, "
    "start_logits array<double>, end_logits array<double>"
)


def make(seed, examples=6, tokens=40):
    rng = random.Random(seed)
    contexts, rows = [], []
    for x in range(examples):
        words = [rng.choice(["ab", "cde", "f", "ghij"]) for _ in range(tokens)]
        context, spans = "", []
        for w in words:
            spans.append((len(context), len(context) + len(w)))
            context += w + " "
        contexts.append((x, context))
        for w in range(rng.randint(1, 3)):
            inside = spans[w * 5 : w * 5 + 25] if x else []
            offsets = [None, None, *inside, None]
            draw = lambda: [rng.randint(-40, 40) / 8 for _ in offsets]  # noqa: E731  eighths: exact sums, many ties
            rows.append((f"{x}-{w}", x, w, offsets, draw(), draw()))
    return contexts, rows


def search(context, windows, n_best, max_length, with_null):
    found = []
    for _, _, w, offsets, starts, ends in windows:
        by = lambda v: sorted(range(len(v)), key=lambda i: (-v[i], i))[:n_best]
        for i in by(starts):
            for j in by(ends):
                if offsets[i] and offsets[j] and i <= j < i + max_length:
                    found.append((-(starts[i] + ends[j]), w, i, j, starts[i], ends[j], context[offsets[i][0] : offsets[j][1]]))
    null = None
    if with_null:
        score, w, a, b = min((f[4][0] + f[5][0], f[2], f[4][0], f[5][0]) for f in windows)
        null = (-score, w, -1, -1, a, b, "")
        found.append(null)
    found.sort()
    best = found[:n_best]
    if null and null not in best:
        best.append(null)
    out = [(t, a, b, -m) for m, _, _, _, a, b, t in best]
    if not out or (len(out) == 1 and out[0][0] == ""):
        out.insert(0, ("empty", 0.0, 0.0, 0.0))
    top = max(s for *_, s in out)
    total = sum(math.exp(s - top) for *_, s in out)
    return [(*row, math.exp(row[3] - top) / total) for row in out], null


@pytest.mark.parametrize("with_null", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_nbest(spark, seed, with_null):
    contexts, rows = make(seed)
    features = spark.createDataFrame(rows, SCHEMA)
    examples = spark.createDataFrame(contexts, "id long, context string")
    candidates = reader.nbest(features, examples, n_best=5, with_null=with_null, max_answer_length=8)
    answers = reader.best_answers(candidates, reader.null_scores(features) if with_null else None)
    got = {}
    for r in candidates.orderBy("example_id", "rank").collect():
        got.setdefault(r.example_id, []).append(r)
    given = {r.id: r for r in answers.collect()}
    for x, context in contexts:
        expected, null = search(context, [r for r in rows if r[1] == x], 5, 8, with_null)
        assert [(r.text, r.start_logit, r.end_logit, r.score) for r in got[x]] == [e[:4] for e in expected]
        assert [r.probability for r in got[x]] == pytest.approx([e[4] for e in expected])
        assert sum(r.probability for r in got[x]) == pytest.approx(1.0)
        if with_null:
            text, a, b = next((e[0], e[1], e[2]) for e in expected if e[0])
            diff = -null[0] - a - b
            assert given[x].score_diff == pytest.approx(diff)
            assert given[x].prediction_text == ("" if diff > 0 else text)
        else:
            assert given[x].prediction_text == expected[0][0]


def test_max_context_mask(spark):
    rows = [("0-0", 0, 0, [(0, 1), (2, 3)], [1.0, 2.0], [1.0, 2.0], [True, False])]
    features = spark.createDataFrame(rows, SCHEMA + ", allowed array<boolean>")
    spans = reader.candidate_spans(features, max_context="allowed").collect()
    assert sorted((r.start_index, r.end_index) for r in spans) == [(0, 0), (0, 1)]
