"""Answer and retrieval metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lectern.functions.text import answer_tokens
from lectern.operators.sizing import spread

DIGITS = 6


def join_predictions(references: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every reference, with its prediction where there is one."""
    return references.join(predictions.select("id", "prediction_text"), "id", "left")


def unanswered(references: DataFrame, predictions: DataFrame) -> DataFrame:
    return references.join(predictions.select("id"), "id", "left_anti")


def per_gold_scores(references: DataFrame, predictions: DataFrame) -> DataFrame:
    """(id, gold_no, answered, exact_match, f1) for ``references`` (id, golds).

    Token overlap is counted by (id, token) on one partitioning by id, so a long
    answer costs its length and not its square."""
    paired = spread(join_predictions(references, predictions), "id")
    golds = paired.select(
        "id", F.posexplode_outer("golds").alias("gold_no", "gold"), "prediction_text"
    ).filter(F.col("gold_no").isNotNull())
    read = golds.select(
        "id",
        "gold_no",
        F.col("prediction_text").isNotNull().alias("answered"),
        answer_tokens(F.col("prediction_text")).alias("p"),
        answer_tokens(F.col("gold")).alias("g"),
    ).select(
        "id",
        "gold_no",
        "answered",
        F.coalesce(F.col("p") == F.col("g"), F.lit(False)).alias("em"),
        F.coalesce("p", F.array().cast("array<string>")).alias("p"),
        "g",
    )
    # (token, in prediction, in gold); one empty mark keeps pairs without tokens
    marks = F.concat(
        F.transform("p", lambda t: F.struct(t.alias("t"), F.lit(1).alias("np"), F.lit(0).alias("ng"))),
        F.transform("g", lambda t: F.struct(t.alias("t"), F.lit(0).alias("np"), F.lit(1).alias("ng"))),
        F.array(F.struct(F.lit("").alias("t"), F.lit(0).alias("np"), F.lit(0).alias("ng"))),
    )
    counts = (
        read.select("id", "gold_no", "answered", "em", F.inline(marks))
        .groupBy("id", "gold_no", "answered", "em", "t")
        .agg(F.sum("np").alias("np"), F.sum("ng").alias("ng"))
        .groupBy("id", "gold_no", "answered", "em")
        .agg(F.sum(F.least("np", "ng")).alias("same"), F.sum("np").alias("np"), F.sum("ng").alias("ng"))
    )
    precision, recall = F.col("same") / F.col("np"), F.col("same") / F.col("ng")
    f1 = F.when(F.col("same") > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return counts.select("id", "gold_no", "answered", F.col("em").cast("double").alias("exact_match"), f1.alias("f1"))


def best_gold_scores(scores: DataFrame) -> DataFrame:
    """(id, exact_match, f1): the maximum over the golds of a question."""
    return scores.groupBy("id").agg(F.max("exact_match").alias("exact_match"), F.max("f1").alias("f1"))


def corpus_scores(per_question: DataFrame) -> DataFrame:
    """(exact_match, f1, total) in percent of all references."""
    return per_question.agg(
        F.round(100 * F.avg("exact_match"), DIGITS).alias("exact_match"),
        F.round(100 * F.avg("f1"), DIGITS).alias("f1"),
        F.count("*").alias("total"),
    )


def evaluate(references: DataFrame, predictions: DataFrame, all_golds: bool = False) -> DataFrame:
    """Exact match and F1 against the first gold, or the best of all golds. A reference
    without a gold stays in the total and scores 0."""
    scores = per_gold_scores(references, predictions)
    picked = best_gold_scores(scores) if all_golds else scores.filter(F.col("gold_no") == 0)
    every = spread(references.select("id"), "id").join(picked.select("id", "exact_match", "f1"), "id", "left")
    return corpus_scores(every.fillna(0.0, ["exact_match", "f1"]))


def comparison_table(references: DataFrame, predictions: DataFrame) -> DataFrame:
    return join_predictions(references, predictions).select(
        "id", F.get("golds", 0).alias("reference"), F.col("prediction_text").alias("prediction")
    )


def agreement(left: DataFrame, right: DataFrame) -> DataFrame:
    """(agreement, total): share of equal answers among the common ids."""
    both = left.select("id", F.col("prediction_text").alias("a")).join(
        right.select("id", F.col("prediction_text").alias("b")), "id"
    )
    return both.agg(
        F.round(F.avg((F.col("a") == F.col("b")).cast("double")), DIGITS).alias("agreement"),
        F.count("*").alias("total"),
    )


def hit_rate_equal(results: DataFrame) -> DataFrame:
    """(hit_rate, total): share of questions whose context is the gold context."""
    hit = (F.col("context") == F.col("original_context")).cast("double")
    return results.agg(F.round(F.avg(hit), DIGITS).alias("hit_rate"), F.count("*").alias("total"))


def hit_rate_contains(results: DataFrame) -> DataFrame:
    """The same for a gold context found anywhere in the concatenated passages."""
    hit = F.contains("context", "original_context").cast("double")
    return results.agg(F.round(F.avg(hit), DIGITS).alias("hit_rate"), F.count("*").alias("total"))
