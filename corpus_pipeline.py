"""From raw documents to packed sequences: five stages, each a whole operator.

Every stage works on all rows that the one before kept. Its result is written as Parquet
and read again, so a lost executor never goes back beyond the stage it was in; the tables that it
made on the way are then deleted."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.llm.decontaminate import contaminated
from lectern.llm.lines import body_key, drop_repeated_lines
from lectern.llm.minhash import one_of_each_group
from lectern.llm.packing import pack
from lectern.llm.quality import kept_documents
from lectern.llm.queries import QUALITY_POLICY, RANKS
from lectern.llm.tables import settled

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy rejects go; a null or empty text is one of them."""
    return kept_documents(docs, QUALITY_POLICY)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and ``n_chars`` follows the text. No document goes, also
    where nothing is left of it."""
    cleaned = drop_repeated_lines(docs)
    chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return cleaned.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the first by id and text. Rows that share only an id, and
    rows without one, are documents of their own; documents without words belong to no group."""
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item go. The text decides, so rows are found
    again by their text and an id is not needed. A null or empty text holds nothing and stays, repeated rows stay or
    go together, and an empty table stays empty."""
    bodies = docs.select(body_key("text").alias("body"), "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = settled(lambda: contaminated(bodies, benchmark, key="body").select(F.col("doc_id").alias("_body")).distinct(), "found")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), body_key("text").alias("_body"))
    return whole.join(found, "_body", "left_anti").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens; every row is packed, repeated ones as often as they occur, one without
    an id or a text too, and no row gives no piece."""
    pieces = pack(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, length=2048)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates_stage),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

# a tokenizer's ids cannot be had in SQL; tests follow the stages by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settled(lambda: stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
