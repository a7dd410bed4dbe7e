from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"

# every case that an operator has to survive: nulls, empty and long texts, ties, repeated rows
AWKWARD = [
    (1, "one two three four five six seven eight nine ten"),
    (1, "one two three four five six seven eight nine ten"),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b "),
    (5, "Ünï çödé — “quoted” text"),
    (6, "word " * 5000),
    (7, "\n".join(f"a line of its own number {i}" for i in range(300))),
    (8, "one two three four five six seven eight nine ten"),
    (None, "one two three four five six seven eight nine ten"),
    (None, None),
    (9, "x"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """(doc_id, text) and columns whose names clash with those of the operators."""
    rows = spark.createDataFrame(AWKWARD, "doc_id long, text string")
    clash = ["n_words", "kept", "n", "h", "row", "_row", "band", "score", "size", "label", "features", "host", "key"]
    return rows.select("*", F.lit("src").alias("source"), F.lit("en").alias("lang"), F.lit(0).cast("long").alias("n_chars"), *[F.lit("x").alias(c) for c in clash])


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
