"""Readers for corpora, question sets and nested question documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.sources.json_entries import json_entries

CORPUS_OBJECT = "map<string,struct<text:string>>"
ARTICLE = (
    "struct<title:string,paragraphs:array<struct<context:string,"
    "qas:array<struct<id:string,question:string,answers:array<struct<text:string,answer_start:int>>>>>>>"
)
ANSWERS = "struct<text:array<string>,answer_start:array<int>>"


def read_corpus(spark: SparkSession, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) of a Parquet corpus; only these columns are read."""
    return spark.read.parquet(path).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))


def read_corpus_object(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """(doc_id, text) of files that hold one JSON object id -> {text, ...}; a large file is
    read by many tasks. With ``parts`` the files of a folder are one object."""
    entries = json_entries(spark, path, parts=parts)
    members = entries.select(F.explode(F.from_json(F.concat(F.lit("{"), "entry", F.lit("}")), CORPUS_OBJECT)).alias("key", "doc"))
    return members.select(F.col("key").cast("bigint").alias("doc_id"), F.col("doc.text").alias("text"))


def read_predictions_object(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """(id, prediction_text) of files that hold one JSON object id -> answer."""
    entries = json_entries(spark, path, parts=parts)
    pairs = F.explode(F.from_json(F.concat(F.lit("{"), "entry", F.lit("}")), "map<string,string>"))
    return entries.select(pairs.alias("id", "prediction_text"))


def read_articles(spark: SparkSession, path: str, article: str = ARTICLE, parts: bool = False) -> DataFrame:
    """Articles of files ``{"version": ..., "data": [article, ...]}``, one row each."""
    entries = json_entries(spark, path, level=2, parts=parts)
    return entries.select(F.from_json("entry", article).alias("a")).select("a.*").filter(F.col("paragraphs").isNotNull())


def read_questions(spark: SparkSession, path: str, article: str = ARTICLE, parts: bool = False) -> DataFrame:
    """One row per question of such files, with the title and the context it is about."""
    return flatten_articles(read_articles(spark, path, article, parts))


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of a dataset stored partitioned by ``split``: only its files
    are opened."""
    return spark.read.parquet(path).filter(F.col("split") == split).drop("split")


def flatten_articles(articles: DataFrame) -> DataFrame:
    """One row per question of nested articles -> paragraphs -> qas; of ``data``, an array of articles, as well. Other
    columns of articles and paragraphs, as title and context, are carried along."""
    if "data" in articles.columns:
        articles = articles.select(F.inline("data"))
    paragraphs = articles.select(*[c for c in articles.columns if c != "paragraphs"], F.inline("paragraphs"))
    return paragraphs.select(*[c for c in paragraphs.columns if c != "qas"], F.inline("qas"))
