"""Sinks for predictions, candidate lists, metrics and rewritten datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.sources.json_entries import write_json_value

NBEST_SCHEMA = (
    "id bigint, nbest array<struct<text:string,start_logit:double,end_logit:double,probability:double>>"
)


def prediction_lines(predictions: DataFrame) -> DataFrame:
    """(id, line): one JSON object per answer."""
    return predictions.select("id", F.to_json(F.struct("id", "prediction_text")).alias("line"))


def write_predictions(predictions: DataFrame, path: str) -> None:
    prediction_lines(predictions).select("line").write.mode("errorifexists").text(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id string, prediction_text string").json(path)


def prediction_object(predictions: DataFrame) -> DataFrame:
    """(json): all answers as one id -> text object in id order. One object is one row in one
    task: this is the small export, and ``write_predictions_object`` the one that scales."""
    entries = F.array_sort(F.collect_list(F.struct(F.col("id").cast("string").alias("id"), F.col("prediction_text"))))
    return predictions.agg(F.to_json(F.map_from_entries(entries)).alias("json"))


def write_predictions_object(predictions: DataFrame, path: str) -> None:
    """One id -> text object in the order of the ids, in ordered parts that many tasks write. A missing answer is null."""
    pair = F.create_map(F.col("id").cast("string"), F.col("prediction_text"))
    line = F.regexp_replace(F.to_json(pair, {"ignoreNullFields": "false"}), r"^\{|\}$", "")
    write_json_value(predictions.select(F.col("id").alias("at"), line.alias("line")), path, "{", "}")


def write_articles(articles: DataFrame, path: str, key: str, version: str = "1.1") -> None:
    """``{"version": ..., "data": [...]}`` with an entry per row, in the order of ``key``, which is not written."""
    row = F.struct(*[c for c in articles.columns if c != key])
    lines = articles.select(F.col(key).alias("at"), F.to_json(row).alias("line"))
    write_json_value(lines, path, f'{{"version": "{version}", "data": [', "]}")


def write_nbest(report: DataFrame, path: str) -> None:
    report.write.mode("errorifexists").json(path)


def read_nbest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NBEST_SCHEMA).json(path)


def write_null_odds(odds: DataFrame, path: str) -> None:
    odds.select("id", "score_diff").write.mode("errorifexists").json(path)


def read_null_odds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id bigint, score_diff double").json(path)


def with_sample_count(metrics: DataFrame, samples: DataFrame) -> DataFrame:
    """The metrics row with the number of evaluated samples."""
    return metrics.withColumn("eval_samples", samples.agg(F.count("*")).scalar())


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.mode("errorifexists").json(path)


def write_dataset(dataset: DataFrame, path: str, split: str | None = None) -> None:
    """A rewritten dataset goes to a new path: Spark reads its input lazily and
    must not overwrite it."""
    writer = dataset.write.mode("errorifexists")
    (writer.partitionBy(split) if split else writer).parquet(path)
