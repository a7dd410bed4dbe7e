import numpy as np
import pytest

from lectern.functions.vectors import l2_normalize, squared_distance
from lectern.operators import clustered_text, dense, sparse
from pyspark.sql import functions as F


def table(spark, matrix, key):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(matrix)], f"{key} long, vec array<float>")


def brute(queries, passages, k, metric, cells=None, qcells=None):
    out = {}
    q, p = queries.astype(np.float32).astype(float), passages.astype(np.float32).astype(float)
    for i, v in enumerate(q):
        score = p @ v if metric == "ip" else -((p - v) ** 2).sum(1)
        allowed = range(len(p)) if cells is None else [j for j in range(len(p)) if cells[j] == qcells[i]]
        order = sorted(allowed, key=lambda j: (-round(score[j], 6), j))[:k]
        out[i] = [(j, round(abs(score[j]) if metric == "l2" else score[j], 6)) for j in order]
    return out


def rows(df):
    out = {}
    for r in df.orderBy("qid", "rank").collect():
        out.setdefault(r.qid, []).append((r.pid, r.score))
    return out


def same(got, expected):
    assert got.keys() == {k for k, v in expected.items() if v}
    for qid, hits in got.items():
        assert [p for p, _ in hits] == [p for p, _ in expected[qid]]
        assert [s for _, s in hits] == pytest.approx([s for _, s in expected[qid]], abs=2e-6)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    passages = rng.integers(-3, 4, (90, 6)).astype(float)  # small integers: many equal scores
    return passages[:11] + 0.5, passages


@pytest.mark.parametrize("metric", ["ip", "l2"])
@pytest.mark.parametrize("block", [4096, 4])
def test_topk(spark, data, metric, block, monkeypatch):
    monkeypatch.setattr(dense, "QUERY_BLOCK", block)
    monkeypatch.setattr(dense, "PASSAGE_BLOCK", 20)
    queries, passages = data
    got = dense.vector_topk(table(spark, queries, "qid"), table(spark, passages, "pid"), 7, metric)
    same(rows(got), brute(queries, passages, 7, metric))


def test_score_chunks_do_not_matter(spark, data, monkeypatch):
    monkeypatch.setattr(dense, "SCORE_CELLS", 11 * 13)
    queries, passages = data
    got = dense.vector_topk(table(spark, queries, "qid"), table(spark, passages, "pid"), 5)
    same(rows(got), brute(queries, passages, 5, "ip"))


def test_clustered(spark, data, monkeypatch):
    monkeypatch.setattr(dense, "PASSAGE_BLOCK", 10)
    queries, passages = data
    centers = passages[[0, 20, 40]]
    nearest = lambda m: [int(np.argmin(((centers - v) ** 2).sum(1))) for v in m]
    centroids = spark.createDataFrame([(i, list(map(float, c))) for i, c in enumerate(centers)], "cell int, vec array<double>")
    assigned = dense.nearest_cells(table(spark, passages, "pid"), centroids, "pid")
    assert {r.pid: r.cell for r in assigned.collect()} == dict(enumerate(nearest(passages)))
    got = dense.clustered_topk(table(spark, queries, "qid"), assigned, centroids, 6)
    same(rows(got), brute(queries, passages, 6, "l2", nearest(passages), nearest(queries)))


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, b array<double>")
    row = df.select(l2_normalize(F.col("a")), l2_normalize(F.col("b")), squared_distance(F.col("a"), F.col("b"))).first()
    assert tuple(row) == ([0.6, 0.8], [0.0, 0.0], 25.0)


def test_scalar_codes(spark):
    df = spark.createDataFrame([(0, [0.0, 5.0]), (1, [1.0, 5.0]), (2, [0.49, 5.0])], "pid long, vec array<double>")
    ranges = dense.scalar_ranges(df)
    encoded = dense.scalar_encode(df, ranges, bits=2)
    assert {r.pid: r.code for r in encoded.collect()} == {0: [0, 0], 1: [3, 0], 2: [1, 0]}
    decoded = {r.pid: r.vec for r in dense.scalar_decode(encoded, ranges, bits=2).collect()}
    assert decoded[2] == [0.375, 5.0]


def test_a_task_keeps_k_per_question(spark, data):
    queries, passages = data
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    hits = dense._broadcast_search(table(spark, queries, "qid"), table(spark, passages, "pid").coalesce(1), 2, "ip")
    counts = {r.qid: r["count"] for r in hits.groupBy("qid").count().collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert counts == {i: 2 for i in range(len(queries))}


def test_uneven_product_codes(spark):
    df = spark.createDataFrame([(i, [float(i % 3 + d) for d in range(10)]) for i in range(12)], "pid long, vec array<double>")
    books = dense.product_codebooks(df, parts=4, codes=3)
    decoded = {r.pid: r.vec for r in dense.product_decode(dense.product_encode(df, books), books).collect()}
    assert all(decoded[r.pid] == pytest.approx(r.vec) for r in df.collect())


def test_product_codes(spark, data):
    _, passages = data
    df = table(spark, passages, "pid")
    books = dense.product_codebooks(df, parts=2, codes=4)
    table_of = {(r.part, r.code): np.array(r.vec) for r in books.collect()}
    decoded = {r.pid: r.vec for r in dense.product_decode(dense.product_encode(df, books), books).collect()}
    for pid, vector in enumerate(passages):
        expected = []
        for part in range(2):
            piece = vector[part * 3 : part * 3 + 3]
            expected.extend(min((((c - piece) ** 2).sum(), i) for (p, i), c in table_of.items() if p == part)[1:])
        codes = [table_of[(p, c)] for p, c in enumerate(expected)]
        assert decoded[pid] == pytest.approx(np.concatenate(codes))


def test_clustered_text(spark):
    texts = ["red cat", "red dog", "red cat cat", "blue sky", "blue sea", "blue blue sky", "green", ""]
    passages = spark.createDataFrame(list(enumerate(texts)), "pid long, text string")
    questions = spark.createDataFrame([(0, "red cat"), (1, "blue sea sky"), (2, "green"), (3, "zebra")], "qid long, question string")
    index = sparse.TfidfIndex(passages, with_bigrams=False)
    cells = clustered_text.fit_cells(index, cells=3, rounds=4)
    got = rows(clustered_text.clustered_tfidf_topk(index, cells, questions, 3))
    cell_of = {r.pid: r.cell for r in cells.assigned.collect()}
    weights, asked = {}, {}
    for r in index.weights.collect():
        weights.setdefault(r.pid, {})[r.term] = r.w
    for r in index.question_weights(questions).collect():
        asked.setdefault(r.qid, {})[r.term] = r.w
    centres = {}
    for r in cells.centres.collect():
        centres.setdefault(r.cell, {})[r.term] = r.w

    def apart(a, b):
        return sum((a.get(t, 0) - b.get(t, 0)) ** 2 for t in a.keys() | b.keys())

    assert cell_of == {p: min(centres, key=lambda c: (round(apart(weights.get(p, {}), centres[c]), 6), c)) for p in range(len(texts))}
    for r in clustered_text.nearest_centres(index.question_weights(questions), questions, cells.centres, "qid").collect():
        assert r.d2 == pytest.approx(apart(asked.get(r.qid, {}), centres[r.cell]), abs=2e-6)
        q = asked.get(r.qid, {})  # none of its terms is known
        distance = {}
        for pid, cell in cell_of.items():
            if cell == r.cell:
                w = weights.get(pid, {})
                distance[pid] = sum((q.get(t, 0) - w.get(t, 0)) ** 2 for t in q.keys() | w.keys())
        expected = sorted(distance.items(), key=lambda e: (round(e[1], 6), e[0]))[:3]
        assert [p for p, _ in got.get(r.qid, [])] == [p for p, _ in expected]
        assert [s for _, s in got.get(r.qid, [])] == pytest.approx([s for _, s in expected], abs=2e-6)


def test_sums_and_ranges_of_many_tasks_and_nulls(spark, monkeypatch):
    """More tasks than are merged at a time, null labels, vectors and entries, wide vectors."""
    monkeypatch.setattr(dense, "_MERGED", 2)
    rng = np.random.default_rng(6)
    table = [(int(i % 3) if i % 7 else None, None if i % 11 == 0 else [None if rng.random() < 0.1 else float(x) for x in rng.normal(size=40)]) for i in range(200)]
    df = spark.createDataFrame(table, "label int, vec array<double>").repartition(9)
    want = {}
    for label, vec in table:
        for d, x in enumerate(vec or []):
            if x is not None:
                want.setdefault((label, d), []).append(x)
    got = {(r.cell, d): x for r in dense.label_centroids(df).collect() for d, x in enumerate(r.vec)}
    assert got == pytest.approx({k: round(sum(v) / len(v), 6) for k, v in want.items()}, abs=1e-6)
    ranges = {r.d: (r.lo, r.hi) for r in dense.scalar_ranges(df).collect()}
    columns = [[vec[d] for _, vec in table if vec and vec[d] is not None] for d in range(40)]
    assert ranges == {d: (min(c), max(c)) for d, c in enumerate(columns)}
    assert dense.label_centroids(df.limit(0)).collect() == dense.scalar_ranges(df.limit(0)).collect() == []


@pytest.mark.parametrize("width", [64, 768])
def test_no_expression_per_dimension(spark, width):
    """The plan does not grow with the width."""
    df = spark.createDataFrame([(0, [1.0] * width), (1, [3.0] * width), (1, [5.0] * width)], "label int, vec array<float>")
    for made in (dense.label_centroids(df), dense.scalar_ranges(df)):
        assert len(made._jdf.queryExecution().optimizedPlan().toString()) < 6000
    assert {r.cell: r.vec for r in dense.label_centroids(df).collect()} == {0: [1.0] * width, 1: [4.0] * width}
    assert [(r.d, r.lo, r.hi) for r in dense.scalar_ranges(df).orderBy("d").collect()] == [(d, 1.0, 5.0) for d in range(width)]
