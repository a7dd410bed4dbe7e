import random

import pytest
from pyspark.sql import functions as F

from lectern.operators import corpus, mixture, sampling, sizing
from lectern.sources import readers, sinks
from lectern.sources.index_store import TableStore, corpus_fingerprint


@pytest.mark.parametrize("shifts", [(10, 20, 20), (2, 3), (1,)])
def test_positions(spark, shifts):
    rng = random.Random(5)
    ids = rng.sample(range(-40, 40), 30) + [2**62, -(2**62), 10**12]
    df = spark.createDataFrame([(i,) for i in ids], "k long")
    got = {r.k: r.n for r in sizing.positions(df, "k", "n", shifts=shifts).collect()}
    assert got == {k: n for n, k in enumerate(sorted(ids))}


@pytest.mark.parametrize("k", [1, 71, 72, 90, 500, 2000])
def test_first_rows(spark, k):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("x"))
    got = {r.id for r in sizing.first_rows(df, -F.col("x"), [F.col("id")], k).collect()}
    assert got == set(sorted(range(500), key=lambda i: (-(i % 7), i))[:k])


def test_first_rows_filters_in_place(spark):
    """A large k sorts only the rows at the cut: no sort of the whole table, one count."""
    df = spark.range(500).select("id", (F.col("id") % 7).alias("x"))
    plan = sizing.first_rows(df, -F.col("x"), [F.col("id")], 400)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_dedup_is_idempotent_and_ordered(spark):
    docs = spark.createDataFrame([(5, "b"), (3, "a"), (9, "b"), (4, "b"), (7, "c")], "doc_id long, text string")
    once = corpus.dedup_in_order(docs)
    assert sorted((r.pid, r.text) for r in once.collect()) == [(0, "a"), (1, "b"), (2, "c")]
    again = corpus.dedup_in_order(once, doc_id="pid")
    assert sorted(again.collect()) == sorted(once.collect())


def test_salted_join(spark):
    big = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c")], "k long, w string")
    joined = [sizing.sized_join(big, small, ["k"], "v", fits=f).select("k", "v", "w") for f in (True, False)]
    assert sorted(joined[0].collect()) == sorted(joined[1].collect())


def test_size_check(spark):
    df = spark.range(20).select(F.repeat(F.lit("x"), 100).alias("s"))
    assert sizing.fits_broadcast(df, 20, 4000)
    assert not sizing.fits_broadcast(df, 19, 4000)
    assert not sizing.fits_broadcast(df, 20, 1999)
    assert sizing.count_up_to(df, 20) == 20 and sizing.count_up_to(df, 19) is None


def test_store(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    builds = []

    def build(_=None):
        builds.append(1)
        return spark.range(10).select(F.col("id").alias("pid"), F.col("id").cast("string").alias("term"))

    key = {"corpus": corpus_fingerprint(spark.range(3), ["id"])}
    for _ in range(2):
        assert store.load_or_build("plain", key, build).count() == 10
        assert store.load_or_build_bucketed("buckets", key, build, "pid", lambda: 3, "term").count() == 10
    assert len(builds) == 2
    for table in spark.catalog.listTables():  # another session knows the files, not the table
        if table.name.startswith("buckets_"):
            spark.sql(f"DROP TABLE {table.name}")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    again = store.load_or_build_bucketed("buckets", key, build, "pid", lambda: 9, "term")
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert again.count() == 10 and len(builds) == 2
    plan = again.groupBy("pid").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    other = {"corpus": corpus_fingerprint(spark.range(4), ["id"])}
    assert other != key
    store.load_or_build("plain", other, build)
    assert len(builds) == 3


def test_gather_reads_only_its_blocks(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    passages = spark.range(0, 3 << 20, 1 << 18).select(F.col("id").alias("pid"), F.concat(F.lit("t"), "id").alias("text"))
    table = store.load_or_build_passages({"n": 1}, lambda: passages)
    hits = spark.createDataFrame([(1, 1, 1 << 20)], "qid long, rank int, pid long")
    for bound in (1, None):
        found = corpus.gather(hits, table, max_hits=bound)
        assert [(r.qid, r.text) for r in found.collect()] == [(1, f"t{1 << 20}")]
    plan = corpus.gather(hits, table, max_hits=1)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_corpus_object(spark, tmp_path):
    (tmp_path / "corpus.json").write_text('{"0": {"text": "a", "title": "x"}, "7": {"text": "b\\nc"}}', encoding="utf-8")
    rows = readers.read_corpus_object(spark, str(tmp_path / "corpus.json")).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == [(0, "a"), (7, "b\nc")]


def test_prediction_object(spark):
    df = spark.createDataFrame([("b", "2"), ("a", "1")], "id string, prediction_text string")
    assert sinks.prediction_object(df).first().json == '{"a":"1","b":"2"}'


def test_sequence_match(spark):
    targets = spark.createDataFrame(
        [(1, [5, 6, 1, 9]), (2, [5, 1]), (3, [5, 6]), (4, [1]), (5, [5, 1]), (6, [5, 1])], "id long, ids array<int>"
    )
    predicted = spark.createDataFrame(
        [(1, [5, 6, 1, 2]), (2, [5, 5, 1]), (3, [5, 6]), (4, [1, 1]), (5, [7, 1])], "id long, ids array<int>"
    )
    assert tuple(mixture.sequence_exact_match(predicted, targets).first()) == (round(2 / 6, 6), 6)


def test_negatives_miss_the_positive(spark):
    corpus_df = spark.range(7).select(F.col("id").alias("pid"))
    positives = spark.range(200).select(F.col("id").alias("qid"), (F.col("id") % 7).alias("pid"))
    rows = sampling.draw_negatives(positives, corpus_df, negatives=3).collect()
    assert len(rows) == 800
    assert all(r.pid == r.qid % 7 if r.slot == 0 else (r.pid != r.qid % 7 and 0 <= r.pid < 7) for r in rows)


def test_batches_hold_every_row_once(spark):
    rows = sampling.shuffled_batches(spark.range(45).toDF("k"), "k", 8).collect()
    sizes = {}
    for r in rows:
        sizes[r.batch_id] = sizes.get(r.batch_id, 0) + 1
    assert sizes == {0: 8, 1: 8, 2: 8, 3: 8, 4: 8, 5: 5}
