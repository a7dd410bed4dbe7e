"""Null ids, normalisation behind a check, blocks of logits, pieces of a tokenizer, k-means from a seed."""

import random
import sys
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators import corpus, dense, mixture, windows


def test_texts_without_an_id_come_last(spark):
    rows = [(1, "a"), (None, "b"), (2, "a"), (None, "a"), (None, "c"), (None, "c"), (7, None), (None, None), (7, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.pid, r.text) for r in corpus.dedup_in_order(df).orderBy("pid").collect()]
    assert [p for p, _ in got] == list(range(5)) and got[0] == (0, "a")
    assert {t for _, t in got[1:3]} == {None, "d"} and {t for _, t in got[3:]} == {"b", "c"}
    assert got == [(r.pid, r.text) for r in corpus.dedup_in_order(df.repartition(5)).orderBy("pid").collect()]
    lone = spark.createDataFrame([(None, "x"), (None, "y"), (None, "x")], "doc_id long, text string")
    assert sorted(r.text for r in corpus.dedup_in_order(lone).collect()) == ["x", "y"]


def test_nfkc_behind_the_check(spark):
    rng = random.Random(1)
    marks = [chr(c) for c in (0x301, 0x308, 0x327, 0x1161, 0x11A8, 0x9BE, 0x3099, 0xFB01, 0xFF21, 0xAC00, 0x1100, 0xE9, 0x2160, 0xBD, 0x1D400)]
    texts = ["", None, "plain", "Grüße, España", "한국어 텍스트", "é", "á̧"]
    texts += ["".join(rng.choice(marks + list("aeoのカ")) for _ in range(rng.randrange(1, 8))) for _ in range(300)]
    texts += [chr(c) for c in range(1, sys.maxunicode + 1, 97) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.n for r in df.select("i", tx.nfkc("t").alias("n")).collect()}
    assert all(got[i] == (None if t is None else unicodedata.normalize("NFKC", t)) for i, t in enumerate(texts))
    asked = df.filter(F.regexp_like("t", F.lit(tx.unstable_class()))).select("t").collect()
    assert not {"plain", "Grüße, España", "한국어 텍스트"} & {r.t for r in asked}
    assert "RLIKE" in df.select(tx.nfkc("t"))._jdf.queryExecution().optimizedPlan().toString()


def test_blocks_equal_the_long_form(spark):
    rng = np.random.default_rng(3)
    long, blocks, weights = [], [], []
    for q in range(4):
        for rank in range(1, 4):
            values = rng.integers(0, 5, size=(6, 7)) / 4.0
            blocks.append((q, rank, 6, [float(x) for x in values.reshape(-1)]))
            long += [(q, rank, p, v, float(values[p, v])) for p in range(6) for v in range(7)]
            weights.append((q, rank, float(rank) / 6))
    long = spark.createDataFrame(long, "id long, rank int, pos int, vocab_id int, logit double")
    blocks = spark.createDataFrame(blocks, "id long, rank int, positions int, logits array<float>").repartition(5)
    weights = spark.createDataFrame(weights, "qid long, rank int, p double")
    want = {r.id: r.ids for r in mixture.as_sequence(mixture.greedy_decode(mixture.mixed_logits(long, weights))).collect()}
    assert {r.id: r.ids for r in mixture.decode_blocks(blocks, weights).collect()} == want
    mixed = {(r.id, r.pos, r.vocab_id): r.logit for r in mixture.mixed_logits(long, weights).collect()}
    got = {(r.id, i // 7, i % 7): x for r in mixture.mix_blocks(blocks, weights).collect() for i, x in enumerate(r.logits)}
    assert got == pytest.approx(mixed)


@pytest.fixture(scope="module")
def pieces():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tx.subwords(tokenizers.path("byte_bpe_50k.json"))


PASSAGES = ["The cat sat on the mat. " * 30, "", None, "über 𝒳 größe\n\n  <|endoftext|> ñandú " * 20, "x"]


def test_chunks_of_pieces_cover_the_text(spark, pieces):
    df = spark.createDataFrame(list(enumerate(PASSAGES)), "pid long, text string")
    for size, overlap in ((7, 0), (1, 0), (500, 0)):
        rows = windows.fixed_chunks(df, size, overlap, pieces).orderBy("pid", "chunk_no").collect()
        got = {}
        for r in rows:
            got[r.pid] = got.get(r.pid, "") + r.text
            assert len(r.tokens) <= size
        assert {p: t for p, t in got.items() if t} == {i: t for i, t in enumerate(PASSAGES) if t}
    overlapping = windows.fixed_chunks(df, 9, 4, pieces).filter("pid = 0").orderBy("chunk_no").collect()
    assert all(a.tokens[-4:] == b.tokens[:4] for a, b in zip(overlapping, overlapping[1:]))


def test_windows_over_pieces(spark, pieces):
    context = "Zoë naïvely sold 17 coöperative größere Häuser near Besançon. " * 12
    at = context.index("größere", 300)
    df = spark.createDataFrame([(1, "What was sold?", context, (["größere Häuser"], [at]))],
                               "id long, question string, context string, answers struct<text:array<string>,answer_start:array<int>>")
    rows = windows.label_answers(windows.features(df.withColumn("read", F.col("context")), 60, 20, pieces)).orderBy("window_no").collect()
    held = [r for r in rows if r.start_position]
    assert len(rows) > 3 and held and all(len(r.tokens) <= 60 and len(r.tokens) == len(r.offsets) for r in rows)
    for r in held:
        assert "größere Häuser" in context[r.offsets[r.start_position].s : r.offsets[r.end_position].e]
    assert windows.rejected_questions(df, 6, pieces).first().question_tokens > 2


def test_kmeans_from_a_seed(spark):
    rng = np.random.default_rng(9)
    points = np.concatenate([rng.normal(c, 0.05, size=(40, 3)) for c in (0.0, 5.0, 9.0)])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(points)], "pid long, vec array<float>")
    one = sorted((r.cell, r.vec) for r in dense.seeded_kmeans(df, 3, rounds=20).collect())
    assert one == sorted((r.cell, r.vec) for r in dense.seeded_kmeans(df.repartition(7), 3, rounds=20).collect())
    moved = dense.moved_centroids(df, dense.seeded_kmeans(df, 3, rounds=20), rounds=1)
    assert sorted((r.cell, r.vec) for r in moved.collect()) == one  # nothing moves any more
