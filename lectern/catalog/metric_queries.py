"""Queries of the metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.catalog import fixtures as fx
from lectern.catalog.registry import query
from lectern.operators import metrics
from lectern.operators.corpus import carry_gold
from lectern.operators.sparse import retrieve
from lectern.plans.retrieval import contexts_for


def _given(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """References and predictions of the conversation pairs."""
    pairs = fx.qa_pairs(spark, sf)
    predictions = pairs.filter(F.col("prediction_text").isNotNull()).select("id", "prediction_text")
    return pairs.select("id", "golds"), predictions


@query(
    "e1_exact_match",
    "SELECT id, gold_no, CAST(em AS DOUBLE) AS exact_match FROM scored",
    uses="scored",
)
def e1(spark: SparkSession, sf: str) -> DataFrame:
    scores = metrics.per_gold_scores(*_given(spark, sf))
    return scores.select("id", F.col("gold_no").cast("bigint").alias("gold_no"), "exact_match")


@query("e2_token_f1", "SELECT id, gold_no, round(f1, 6) AS f1 FROM scored", uses="scored")
def e2(spark: SparkSession, sf: str) -> DataFrame:
    scores = metrics.per_gold_scores(*_given(spark, sf))
    return scores.select("id", F.col("gold_no").cast("bigint").alias("gold_no"), F.round("f1", 6).alias("f1"))


@query(
    "e3_best_of_golds",
    "SELECT id, CAST(max(em) AS DOUBLE) AS exact_match, round(max(f1), 6) AS f1 FROM scored GROUP BY id",
    uses="scored",
)
def e3(spark: SparkSession, sf: str) -> DataFrame:
    best = metrics.best_gold_scores(metrics.per_gold_scores(*_given(spark, sf)))
    return best.select("id", "exact_match", F.round("f1", 6).alias("f1"))


@query(
    "e4_corpus_scores",
    """SELECT round(100 * avg(CASE WHEN id % 7 = 0 THEN 0 ELSE em END), 6) AS exact_match,
              round(100 * avg(CASE WHEN id % 7 = 0 THEN 0 ELSE f1 END), 6) AS f1, count(*) AS total
       FROM scored WHERE gold_no = 0""",
    uses="scored",
)
def e4(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh reference has lost its golds: it counts, with score 0."""
    references, predictions = _given(spark, sf)
    emptied = F.when(F.col("id") % 7 == 0, F.array().cast("array<string>")).otherwise(F.col("golds"))
    return metrics.evaluate(references.withColumn("golds", emptied), predictions)


@query(
    "e5_unanswered",
    "SELECT id FROM pairs WHERE prediction IS NULL",
    uses="pairs",
)
def e5(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.unanswered(*_given(spark, sf)).select("id")


def _retrieved(spark: SparkSession, sf: str, k: int) -> DataFrame:
    examples = fx.qa_examples(spark, sf)
    asked = examples.select(F.col("id").alias("qid"), "question")
    hits = retrieve(fx.index(spark, sf, "bm25"), asked, k)
    return carry_gold(contexts_for(hits, examples, fx.passages(spark, sf), k), examples)


_TOP = """FROM examples x JOIN (SELECT qid, string_agg(text, ' ' ORDER BY rank) AS context
          FROM bm25_ranked JOIN passages USING (pid) WHERE rank <= {k} GROUP BY qid) c ON c.qid = x.id"""


@query(
    "e6_hit_rate_equal",
    "SELECT round(avg(CASE WHEN c.context = x.context THEN 1.0 ELSE 0.0 END), 6) AS hit_rate, count(*) AS total "
    + _TOP.format(k=1),
    uses="examples bm25_ranked passages",
)
def e6(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.hit_rate_equal(_retrieved(spark, sf, 1))


@query(
    "e7_hit_rate_contains",
    "SELECT round(avg(CASE WHEN contains(c.context, x.context) THEN 1.0 ELSE 0.0 END), 6) AS hit_rate, count(*) AS total "
    + _TOP.format(k=10),
    uses="examples bm25_ranked passages",
)
def e7(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.hit_rate_contains(_retrieved(spark, sf, 10))


@query(
    "e9_comparison_table",
    "SELECT id, gold1 AS reference, prediction FROM pairs",
    uses="pairs",
)
def e9(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.comparison_table(*_given(spark, sf))


@query(
    "e10_agreement",
    """SELECT round(avg(CASE WHEN prediction = gold2 THEN 1.0 ELSE 0.0 END), 6) AS agreement, count(*) AS total
       FROM pairs WHERE prediction IS NOT NULL""",
    uses="pairs",
)
def e10(spark: SparkSession, sf: str) -> DataFrame:
    references, predictions = _given(spark, sf)
    other = references.select("id", F.get("golds", 1).alias("prediction_text"))
    return metrics.agreement(predictions, other)


@query(
    "r11_prediction_join",
    """SELECT id, coalesce(prediction, '') AS prediction_text, prediction IS NOT NULL AS answered,
              CASE WHEN prediction = gold1 THEN 1 ELSE 0 END AS same FROM pairs""",
    uses="pairs",
)
def r11(spark: SparkSession, sf: str) -> DataFrame:
    joined = metrics.join_predictions(*_given(spark, sf))
    same = F.coalesce((F.col("prediction_text") == F.get("golds", 0)).cast("int"), F.lit(0))
    return joined.select(
        "id", F.coalesce("prediction_text", F.lit("")).alias("prediction_text"),
        F.col("prediction_text").isNotNull().alias("answered"), same.cast("int").alias("same"),
    )
