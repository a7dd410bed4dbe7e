import json
import random

import pytest

from lectern.sources import readers, sinks
from lectern.sources.json_entries import json_entries, write_json_value

TEXTS = ["", "a", "}", "{[", '"', "\\", '\\"}', "}}}}", ", ", "über   𝒳 }{", "line\nbreak\r\n}", "x" * 700 + "}" * 50, "\\\\\\", '{"a": [1, 2]}']


def texts(rng):
    return "".join(rng.choice(TEXTS) for _ in range(rng.randrange(0, 6)))


@pytest.fixture()
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield cut
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [61, 400, 1 << 20])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_object_in_many_ranges(spark, tmp_path, small_ranges, size, ascii_only):
    rng = random.Random(size)
    want = {str(i): {"title": texts(rng), "text": texts(rng), "tags": [texts(rng), {"n": [1]}]} for i in range(8 if size < 100 else 60)}
    path = tmp_path / "corpus.json"
    path.write_text(json.dumps(want, ensure_ascii=ascii_only, indent=rng.choice([None, 1])) + "\n", encoding="utf-8")
    small_ranges(size)
    entries = json_entries(spark, str(path))
    if size < 1000:
        assert spark.read.text(str(path), lineSep="}").rdd.getNumPartitions() > 3
    assert {k: v for r in entries.collect() for k, v in json.loads("{" + r.entry + "}").items()} == want
    assert {str(r.doc_id): r.text for r in readers.read_corpus_object(spark, str(path)).collect()} == {k: v["text"] for k, v in want.items()}


@pytest.mark.parametrize("size", [50, 1 << 20])
def test_articles_over_three_levels(spark, tmp_path, small_ranges, size):
    rng = random.Random(3)
    data, want = [], set()
    for a in range(9):
        paragraphs = []
        for p in range(rng.randrange(0, 4)):
            context = texts(rng)
            qas = [{"id": f"{a}-{p}-{q}", "question": texts(rng), "answers": [{"text": "t", "answer_start": q}]} for q in range(rng.randrange(0, 3))]
            want |= {(f"T{a}", context, qa["id"], qa["question"], qa["answers"][0]["answer_start"]) for qa in qas}
            paragraphs.append({"context": context, "qas": qas})
        data.append({"title": f"T{a}", "paragraphs": paragraphs})
    for name in ("one.json", "two.json"):  # every file is a value of its own
        (tmp_path / name).write_text(json.dumps({"version": "1.1", "meta": {"k": [1, {"z": "}"}]}, "data": data}), encoding="utf-8")
    small_ranges(size)
    rows = readers.read_questions(spark, str(tmp_path)).collect()
    assert len(rows) == 2 * len(want)
    assert {(r.title, r.context, r.id, r.question, r.answers[0].answer_start) for r in rows} == want


def test_flatten_takes_the_data_level(spark):
    df = spark.createDataFrame([("1.1", [("T", [("c", [("q1", "?"), ("q2", "!")])])])],
                               "version string, data array<struct<title:string,paragraphs:array<struct<context:string,qas:array<struct<id:string,question:string>>>>>>")
    assert [tuple(r) for r in readers.flatten_articles(df).orderBy("id").collect()] == [("T", "c", "q1", "?"), ("T", "c", "q2", "!")]


def test_object_written_in_parts(spark, tmp_path):
    rng = random.Random(5)
    want = {f"{i:04}": (None if i % 9 == 0 else texts(rng)) for i in range(200)}
    df = spark.createDataFrame(list(want.items()), "id string, prediction_text string").repartition(4)
    sinks.write_predictions_object(df, str(tmp_path / "out"))
    files = sorted((tmp_path / "out").glob("part-*"))
    assert files
    assert list(json.loads("".join(f.read_text(encoding="utf-8") for f in files)).items()) == sorted(want.items())
    got = {r.id: r.prediction_text for r in readers.read_predictions_object(spark, str(tmp_path / "out"), parts=True).collect()}
    assert got == want


def test_empty_values(spark, tmp_path):
    sinks.write_predictions_object(spark.createDataFrame([], "id string, prediction_text string"), str(tmp_path / "none"))
    assert readers.read_predictions_object(spark, str(tmp_path / "none"), parts=True).collect() == []
    write_json_value(spark.createDataFrame([(1, "[]")], "at int, line string"), str(tmp_path / "one"), "[", "]")
    assert [r.entry for r in json_entries(spark, str(tmp_path / "one"), parts=True).collect()] == ["[]"]
    (tmp_path / "data.json").write_text('{"version": "1.1", "data": []}')
    assert readers.read_questions(spark, str(tmp_path / "data.json")).collect() == []
