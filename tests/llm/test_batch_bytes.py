"""Arrow batches of the pipeline's steps are bounded by bytes, as both sides of a task keep what the largest took."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectern.llm import packing, tables
from lectern.llm.decontaminate import contaminated
from lectern.llm.lines import drop_repeated_lines
from lectern.llm.minhash import near_duplicates
from lectern.llm.queries import RANKS

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def default_bound(spark):
    """Spark's own limits: 64 MB and 10,000 rows."""
    keys = {KEY: "64m", "spark.sql.execution.arrow.maxRecordsPerBatch": "10000"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def sizes():
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["bytes", "rows"])

    return run


def test_batches_of_texts(spark, default_bound):
    docs = spark.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("x"), 4096).alias("text"))
    got = tables.arrow_map(docs, sizes(), "bytes long, rows long").collect()
    assert sum(r.rows for r in got) == 4000 and max(r.bytes for r in got) < tables.BATCH_BYTES + (64 << 10)
    # narrow rows come as before, and a text longer than a batch is one of its own
    assert [r.rows for r in tables.arrow_map(spark.range(0, 9000, 1, 1), sizes(), "bytes long, rows long").collect()] == [9000]
    long = spark.range(0, 3, 1, 1).select("id", F.repeat(F.lit("x"), tables.BATCH_BYTES).alias("text"))
    assert [r.rows for r in tables.arrow_map(long, sizes(), "bytes long, rows long").collect()] == [1, 1, 1]


def test_a_smaller_bound_of_the_user_stays(spark, default_bound):
    spark.conf.set(KEY, "1m")
    tables.arrow_map(spark.range(1), sizes(), "bytes long, rows long")
    assert spark.conf.get(KEY) == "1m"


STEPS = {
    "lines": drop_repeated_lines,
    "near duplicates": near_duplicates,
    "decontamination": lambda docs: contaminated(docs, docs.select(F.col("doc_id").alias("item_id"), "text")),
    "packing": lambda docs: packing.pack(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN),
}


@pytest.mark.parametrize("step", STEPS)
def test_every_step_bounds_its_batches(spark, default_bound, step):
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, None)], "doc_id long, text string")
    STEPS[step](docs)
    assert int(spark.conf.get(KEY)) == tables.BATCH_BYTES


def test_pieces_go_back_in_small_batches(monkeypatch):
    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(packing, "TaskContext", Task)
    blobs = [np.full(5000, i, "<u2").tobytes() for i in range(400)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(400), pa.int64()), pa.array(blobs, pa.binary())], names=["doc_id", "ids"])
    got = list(packing._cut(2048)(iter([rows])))
    assert sum(sum(b.column("length").to_pylist()) for b in got) == 400 * 5000
    assert max(b.nbytes for b in got) < 2 << 20
