import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lectern.catalog.reader_queries import WORDS_SQL, chunk_sql
from lectern.operators import windows
from lectern.plans import reading


def examples(spark, rows):
    return spark.createDataFrame(
        rows, "id long, question string, context string, answers struct<text:array<string>,answer_start:array<int>>"
    )


def test_windows_cover_every_token(spark):
    context = " ".join(f"w{i}" for i in range(57))
    found = windows.features(examples(spark, [(1, "a b", context, ([], []))]), max_length=20, stride=5).collect()
    seen, size = set(), 20 - 2 - 3
    for r in sorted(found, key=lambda r: r.window_no):
        assert len(r.tokens) == len(r.offsets) <= 20
        inside = [t for t, o in zip(r.tokens, r.offsets) if o is not None]
        assert inside == [context[o.s : o.e] for o in r.offsets if o is not None]
        start = r.window_no * (size - 5)
        assert inside == [f"w{i}" for i in range(start, min(start + size, 57))]
        seen.update(inside)
    assert len(seen) == 57


def test_labels(spark):
    context = " ".join(f"w{i}" for i in range(40))
    start = context.index("w12")
    rows = [
        (1, "q", context, (["w12 w13"], [start])),
        (2, "q", context, ([], [])),
        (3, "q", context, (["12 w1"], [start + 1])),
    ]
    labelled = windows.label_answers(windows.features(examples(spark, rows), max_length=20, stride=4))
    hits = 0
    for r in labelled.collect():
        span = r.tokens[r.start_position : r.end_position + 1]
        if r.start_position == 0:
            assert r.end_position == 0
            assert r.id == 2 or not {"w12", "w13"} <= set(r.tokens)
        else:
            assert span == ["w12", "w13"]
            hits += 1
    assert hits >= 2


def test_fixed_chunks(spark):
    df = spark.createDataFrame([(1, " ".join(map(str, range(23)))), (2, ""), (3, "x")], "pid long, text string")
    chunks = {}
    for r in windows.fixed_chunks(df, size=10, overlap=3).collect():
        chunks.setdefault(r.pid, {})[r.chunk_no] = r.tokens
    assert chunks[1] == {i: [str(x) for x in range(i * 7, min(i * 7 + 10, 23))] for i in range(3)}
    assert chunks[2] == {0: []} and chunks[3] == {0: ["x"]}


def test_recursive_chunks(spark):
    rng = random.Random(3)
    fresh = iter(range(1000, 10000))
    words = lambda n: " ".join(f"{next(fresh)}" + "x" * rng.randint(0, 8) for _ in range(n))
    texts = [words(200), "\n\n".join(words(20) for _ in range(8)), "y" * 95, "", "  \n\n ", "a\nb\n\nc d"]
    df = spark.createDataFrame(list(enumerate(texts)), "pid long, text string")
    found = {}
    for r in windows.recursive_chunks(df, size=40, overlap=10).orderBy("pid", "chunk_no").collect():
        found.setdefault(r.pid, []).append(r.text)
    for pid, text in enumerate(texts):
        chunks = found.get(pid, [])
        assert all(0 < len(c) <= 40 and c in text for c in chunks)
        # in order, nothing but whitespace between them, neighbours share at most the overlap
        end = 0
        for c in chunks:
            at = text.find(c, max(0, end - 10))
            assert at >= 0 and (text[end:at].strip() == "" if at > end else end - at <= 10)
            end = at + len(c)
        assert text[end:].strip() == ""
    assert found[2] == ["y" * 40, "y" * 40, "y" * 35]
    assert found[5] == ["a\nb\n\nc d"]


def test_recursive_chunks_by_own_length(spark):
    df = spark.createDataFrame([(0, "a b c d e f g")], "pid long, text string")
    out = windows.recursive_chunks(df, size=3, overlap=1, length=lambda s: len(s.split())).orderBy("chunk_no").collect()
    assert [r.text for r in out] == ["a b c", "c d e", "e f g"]


def test_a_long_question_does_not_end_the_job(spark):
    examples = spark.createDataFrame(
        [(1, " ".join(["q"] * 300), " ".join(map(str, range(200)))), (2, "short one", "a b c")], "id long, question string, context string"
    )
    got = windows.features(examples).groupBy("id").agg(F.max(F.size("tokens")).alias("n"), F.count("*").alias("w")).collect()
    assert {r.id: (r.n <= 384, r.w >= 1) for r in got} == {1: (True, True), 2: (True, True)}


def test_long_questions_stay_whole(spark):
    """Room for many tokens, for one and for none."""
    long = {1: 10, 2: 15, 3: 16, 4: 17, 5: 40}
    rows = [(i, " ".join(f"q{j}" for j in range(n)), " ".join(f"w{j}" for j in range(30)), ([], [])) for i, n in long.items()]
    found = {}
    for r in windows.features(examples(spark, rows), max_length=20, stride=5).collect():
        at = long[r.id]
        assert r.tokens[: at + 2] == ["[CLS]", *(f"q{j}" for j in range(at)), "[SEP]"] and len(r.tokens) == len(r.offsets) <= 20
        found.setdefault(r.id, set()).update(r.tokens[at + 2 : -1])
    assert found == {i: {f"w{j}" for j in range(30)} for i in (1, 2, 3)}
    out = windows.rejected_questions(examples(spark, rows), max_length=20).collect()
    assert sorted(map(tuple, out)) == [(4, 17, 16), (5, 40, 16)]


def test_rejected_questions_keep_their_prediction(spark):
    rows = [(1, "q", "w0 w1", ([], [])), (2, " ".join(["q"] * 40), "w0 w1", ([], []))]
    own = examples(spark, rows)
    features = reading.extractive_features(own, max_length=20, stride=5)
    flat = F.transform("tokens", lambda t, i: F.when(i == 3, 5.0).otherwise(0.0))
    logits = features.select("feature_id", flat.alias("start_logits"), flat.alias("end_logits"))
    for with_null in (False, True):
        got = reading.extractive_answers(features, logits, own, with_null=with_null)[0].collect()
        assert {r.id: r.prediction_text for r in got} == {1: "w0", 2: "empty"}


@pytest.mark.parametrize("size,overlap", [(40, 10), (7, 3), (2, 1), (30, 0), (12, 11)])
def test_chunk_sql_by_the_plain_computation(size, overlap):
    """Long words, separators of all kinds next to each other, none at all, and an empty and a null text."""
    rng = random.Random(size)
    alphabet = ["a", "b", "é", "漢", "😀", " ", " ", "\n", "\n\n", "\t", "word", "longerword", "y" * 9]
    texts = ["", None, "  \n\n ", "a\nb\n\nc d", "y" * 95, "\n\n\n\nx"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 120))) for _ in range(60)]
    con = duckdb.connect()
    con.execute("CREATE TABLE passages (pid BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO passages VALUES (?, ?)", list(enumerate(texts)))
    for sql, length in (("length({})", len), (WORDS_SQL, lambda t: len(t.split()))):
        got = {}
        for pid, number, text in con.execute(chunk_sql(size, overlap, sql) + " ORDER BY pid, chunk_no").fetchall():
            assert number == len(got.setdefault(pid, []))
            got[pid].append(text)
        for pid, text in enumerate(texts):
            assert got.get(pid, []) == windows.split_recursively(text or "", size, overlap, length)
