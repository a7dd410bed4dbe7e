"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.llm import sql
from lectern.llm.byte_cnn import fit as fit_quality, production_rows
from lectern.llm.decontaminate import contaminated
from lectern.llm.divergence import audit
from lectern.llm.lines import drop_repeated_lines
from lectern.llm.minhash import near_duplicates
from lectern.llm.ngram_lm import fit, fold, score
from lectern.llm.packing import pack
from lectern.llm.quality import judged, ledger
from lectern.llm.shards import interleave
from lectern.llm.toxicity import fit as fit_toxicity, production_part
from lectern.llm.urls import judge, mine, taught
from lectern.llm.whitening import whiten
from lectern.llm.wrappers import extract

Query = Callable[[SparkSession, str], DataFrame]

# the rules of the contract: verdict, host, start of the path
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
QUALITY_POLICY = "v2"
RANKS = "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = judged(ledger(table(spark, sf_dir, "documents")), QUALITY_POLICY)
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "fail_bits", "sole_bit",
    )


def op2_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave(table(spark, sf_dir, "documents"), 40)


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return judge(pages, URL_RULES, mine(taught(pages, URL_RULES, labels)))


def op5_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), production_part())
    return model.score(docs).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = drop_repeated_lines(docs, totals=("n_lines", "n_dropped"))
    return cleaned.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs.filter(fold("doc_id", 5) != 1))
    scored = score(docs, model)
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op8_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, length=2048
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op11_incremental_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = fit_quality(docs, table(spark, sf_dir, "labels"), production_rows()).score(docs)
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op13_divergence_skyband(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_ledger": op1_quality_ledger,
    "op2_string_tiling": op2_string_tiling,
    "op3_interleaved_shards": op3_interleaved_shards,
    "op4_url_rules": op4_url_rules,
    "op5_boosted_toxicity": op5_boosted_toxicity,
    "op6_line_dedup": op6_line_dedup,
    "op7_kneser_ney": op7_kneser_ney,
    "op8_wrapper_text": op8_wrapper_text,
    "op9_circulant_minhash": op9_circulant_minhash,
    "op10_hilbert_packing": op10_hilbert_packing,
    "op11_incremental_whitening": op11_incremental_whitening,
    "op12_byte_cnn": op12_byte_cnn,
    "op13_divergence_skyband": op13_divergence_skyband,
}
ORACLES: dict[str, str] = {
    "op1_quality_ledger": sql.QUALITY,
    "op3_interleaved_shards": sql.SHARDS,
    "op6_line_dedup": sql.LINES,
    "op9_circulant_minhash": sql.NEAR_DUPLICATES,
    "op13_divergence_skyband": sql.DIVERGENCE,
}
