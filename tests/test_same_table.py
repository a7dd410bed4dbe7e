"""Questions and passages out of one table, and what a task holds of them."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import dense, mixture


@pytest.fixture
def vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-4, 5, 6)]) for i in range(60)]
    return spark.createDataFrame(rows, "vec_id long, vec array<float>")


def _brute(rows, k):
    at = {r["vec_id"]: np.array(r["vec"]) for r in rows}
    return {
        (q, rank, p)
        for q, x in at.items()
        for rank, (_, p) in enumerate(sorted((-round(float(x @ y), 6), p) for p, y in at.items())[:k], 1)
    }


@pytest.mark.parametrize("block", [7, 4096])
def test_questions_and_passages_of_one_table(vectors, monkeypatch, block):
    monkeypatch.setattr(dense, "QUERY_BLOCK", block)
    queries, passages = (vectors.select(F.col("vec_id").alias(n), "vec") for n in ("qid", "pid"))
    hits = dense.vector_topk(queries, passages, 4)
    assert {(r["qid"], r["rank"], r["pid"]) for r in hits.collect()} == _brute(vectors.collect(), 4)
    pairs = mixture.pair_vectors(hits, queries, passages).collect()
    assert len(pairs) == 240 and all(len(r["vec"]) == 12 for r in pairs)
