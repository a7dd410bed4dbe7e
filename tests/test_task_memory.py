"""What tasks and the driver hold: pieces, term counts, scores and salted copies."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators import clustered_text, dense, sizing, sparse


class _Read:
    """Reads a text as its words, as a tokenizer of a file would."""

    def __init__(self, value):
        self.tokens = value.split()
        self.ids = [len(t) for t in self.tokens]
        self.offsets = [(i, i + 1) for i in range(len(self.tokens))]


class _Tokenizer:
    def encode(self, value, add_special_tokens):
        return _Read(value)


@pytest.mark.parametrize("texts", [["a bc", None, "", "d"], [None, None], [""], []])
def test_pieces_are_columns(texts):
    got = tx._pieces(_Tokenizer(), pa.array(texts, pa.string())).to_pylist()
    rows = [None if t is None else [{"t": w, "id": len(w), "s": i, "e": i + 1} for i, w in enumerate(t.split())] for t in texts]
    assert got == rows


def test_salted_copies_do_not_pass_the_driver(spark):
    big = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    small = spark.range(5).select(F.col("id").alias("k"), F.col("id").alias("w"))
    joined = sizing.sized_join(big, small, ["k"], "v", fits=False)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and joined.count() == 72


def test_scores_of_a_block_are_cut_to_k(monkeypatch):
    monkeypatch.setattr(dense, "SCORE_CELLS", 30)
    monkeypatch.setattr(dense, "QUERY_ROWS", 4, raising=False)
    rng = np.random.default_rng(3)
    q, p = rng.integers(-3, 4, (10, 4)).astype(float), rng.integers(-3, 4, (50, 4)).astype(float)
    found = dense._search_block(np.arange(10), q, np.arange(50), p, 3, "ip")
    want = [(i, j) for i in range(10) for j in sorted(range(50), key=lambda j: (-float(q[i] @ p[j]), j))[:3]]
    assert [*zip(found["qid"].to_pylist(), found["pid"].to_pylist())] == want


@pytest.mark.parametrize("bigrams", [False, True])
def test_terms_are_counted_by_passage(bigrams):
    texts = [["a", "b", "a", "b"], None, [], ["b"], ["b", "b"]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(5)), pa.array([len(t) if t else 0 for t in texts], pa.int64()), pa.array(texts, pa.list_(pa.string()))],
        names=["pid", "dl", "tokens"],
    )
    got = {(r["pid"], r["term"]): (r["dl"], r["tf"]) for r in sparse._term_counts(batch, bigrams).to_pylist()}
    want = {}
    for pid, t in enumerate(texts):
        terms = (t or []) + ([" ".join(x) for x in zip(t, t[1:])] if bigrams and t else [])
        want |= {(pid, w): (len(t), n) for w, n in Counter(terms).items()}
    assert got == want


def test_nearest_centres_meet_a_weight_once(spark):
    weights = spark.createDataFrame([(0, "a", 1.0), (1, "b", 0.6), (1, "c", 0.8), (2, "z", 1.0)], "pid long, term string, w double")
    rows = [(0, "a", 0.5), (0, "b", 0.5), (1, "b", 0.9), (1, "c", 0.1), (2, "a", 0.2)]
    centres = spark.createDataFrame(rows, "cell int, term string, w double")
    ids = spark.range(4).withColumnRenamed("id", "pid")
    found = clustered_text.nearest_centres(weights, ids, centres, "pid")
    assert found.schema["cell"].dataType.simpleString() == "int"
    got = {r["pid"]: (r["cell"], r["d2"]) for r in found.collect()}
    assert got == {0: (0, 0.5), 1: (1, 0.58), 2: (2, 1.04), 3: (2, 0.04)}


def test_embedding_by_batches(spark):
    def make_encoder():
        return lambda texts: np.array([[len(texts), len(str(t))] for t in texts])

    df = spark.createDataFrame([(i, "x" * i) for i in range(10)], "pid long, text string").coalesce(1)
    rows = dense.embed(df, make_encoder, batch_size=4).collect()
    assert all(r["vec"][1] == r["pid"] and r["vec"][0] <= 4 for r in rows)


def test_passages_stay_where_they_are_for_the_examples(spark, monkeypatch):
    """The candidates of the examples are counted, so their number bounds what goes to the passages."""
    from lectern.catalog import fixtures as fx

    docs = spark.createDataFrame([(i, f"x {i} the quick brown fox jumps over it {i}") for i in range(8)], "doc_id long, text string")
    asked = spark.createDataFrame([(0, "the quick brown fox jumps")], "qid long, question string")
    bounds, gather = [], fx.gather
    monkeypatch.setattr(fx, "table", lambda *_: docs)
    monkeypatch.setattr(fx, "questions", lambda *_: asked)
    monkeypatch.setattr(fx, "gather", lambda hits, table, max_hits=None: bounds.append(max_hits) or gather(hits, table, max_hits=max_hits))
    found = fx._qa_examples(spark, "made by test_task_memory").collect()
    assert bounds == [8] and [(r["id"], r["context"]) for r in found] == [(0, "x 0 the quick brown fox jumps over it 0")]


def test_stored_tables_are_packed(spark, tmp_path):
    from lectern.sources.index_store import TableStore

    rows = spark.range(20).select(F.col("id").alias("pid"), F.lit("a b").alias("text"))
    TableStore(spark, str(tmp_path)).load_or_build("plain", {"n": 1}, lambda: rows)
    TableStore(spark, str(tmp_path)).load_or_build_passages({"n": 1}, lambda: rows)
    found = TableStore(spark, str(tmp_path)).load_or_build_bucketed("terms", {"n": 1}, lambda n: rows, "pid", lambda: 2, "text")
    files = [*tmp_path.rglob("*.parquet")]
    assert files and all(".zstd." in f.name for f in files) and found.count() == 20
