"""The reading plans, from questions to answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.catalog import fixtures as fx
from lectern.catalog.registry import query
from lectern.catalog.text_queries import prompt_sql
from lectern.plans import reading
from lectern.operators import dense
from lectern.plans.retrieval import retrieve_clustered_for_dataset, retrieve_dense_for_dataset, retrieve_for_dataset
from lectern.sources import readers, sinks


@query(
    "flow_extractive",
    r"""SELECT round(100 * avg(CASE WHEN p = g THEN 1.0 ELSE 0.0 END), 6) AS exact_match,
               round(100 * avg(CASE WHEN same > 0 THEN 2.0 * same / (len(p) + len(g)) ELSE 0.0 END), 6) AS f1, count(*) AS total FROM (
          SELECT p, g, list_sum([least(len([x for x in p if x = t]), len([x for x in g if x = t])) for t in list_distinct(p)]) AS same FROM (
          SELECT [x for x in string_split_regex(regexp_replace(lower(text), '[!-/:-@\[-`{-~]', '', 'g'), '\s+')
                  if x not in ('', 'a', 'an', 'the')] AS p,
                 [x for x in string_split_regex(regexp_replace(lower(answer), '[!-/:-@\[-`{-~]', '', 'g'), '\s+')
                  if x not in ('', 'a', 'an', 'the')] AS g
          FROM examples JOIN nbest ON example_id = id AND rank = 1))""",
    uses="examples nbest",
)
def flow_extractive(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of the gold contexts, span decoding, scores."""
    examples, scored = fx.qa_examples(spark, sf), fx.scored_features(spark, sf)
    logits = scored.select("feature_id", "start_logits", "end_logits")
    predictions, _ = reading.extractive_answers(reading.extractive_features(examples), logits, examples)
    return reading.score(predictions, examples).select("exact_match", "f1", "total")


@query(
    "flow_independent",
    """SELECT x.id, x.question, rank, text AS context, round(score / (SELECT max(score) FROM bm25_ranked WHERE rank <= 10), 6) AS score,
              x.context AS original_context, x.answer AS answers
       FROM examples x JOIN bm25_ranked ON qid = x.id JOIN passages USING (pid) WHERE rank <= 10""",
    uses="examples bm25_ranked passages",
)
def flow_independent(spark: SparkSession, sf: str) -> DataFrame:
    """Every retrieved passage as a context of its own."""
    results = retrieve_for_dataset(
        fx.index(spark, sf, "bm25"), fx.qa_examples(spark, sf), fx.passages(spark, sf), k=10, first_only=True, independent=True
    )
    return results.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "flow_generative",
    rf"""SELECT x.id AS example_id,
               array_to_string([t for t in string_split_regex('question: ' || {prompt_sql('x.question')} || '  context: '
                 || {prompt_sql('c.context')} || ' </s>', '\s+') if t <> ''][1:384], ' ') AS input,
               array_to_string([t for t in string_split_regex({prompt_sql('x.answer')} || ' </s>', '\s+') if t <> ''][1:30], ' ')
                 AS target
        FROM examples x JOIN (SELECT qid, string_agg(text, ' ' ORDER BY rank) AS context
                              FROM bm25_ranked JOIN passages USING (pid) WHERE rank <= 10 GROUP BY qid) c ON c.qid = x.id""",
    uses="examples bm25_ranked passages",
)
def flow_generative(spark: SparkSession, sf: str) -> DataFrame:
    """BM25 contexts, prompts and targets."""
    results = retrieve_for_dataset(
        fx.index(spark, sf, "bm25"), fx.qa_examples(spark, sf), fx.passages(spark, sf), k=10, first_only=True
    )
    return reading.generative_inputs(results).withColumn("example_id", F.col("example_id").cast("bigint"))


def _retrieved_sql(hits: str) -> str:
    """Examples with their passages, from hits (qid, pid, rank)."""
    return f"""SELECT x.answer AS answers, c.context, x.context AS original_context, CAST(x.id AS VARCHAR) AS id, x.question
       FROM examples x JOIN (SELECT qid, string_agg(text, ' ' ORDER BY rank) AS context FROM ({hits}) JOIN passages USING (pid)
                             WHERE rank <= 10 GROUP BY qid) c ON c.qid = x.id"""


_NEAR_IN_CELL = """SELECT qid, pid, row_number() OVER (PARTITION BY qid ORDER BY d2, pid) AS rank FROM (
     SELECT a.vec_id AS qid, b.vec_id AS pid,
            round(list_sum([(x.v[i] - y.v[i]) * (x.v[i] - y.v[i]) for i in range(1, len(x.v) + 1)]), 6) AS d2
     FROM cells a JOIN cells b USING (cell) JOIN vecs x ON x.vec_id = a.vec_id JOIN vecs y ON y.vec_id = b.vec_id)"""


def _vectors_of(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A vector for every question and passage, that of the table with its number."""
    vectors = fx.vectors(spark, sf)
    asked = vectors.join(fx.qa_examples(spark, sf).select(F.col("id").alias("vec_id")), "vec_id", "left_semi")
    return asked.select(F.col("vec_id").alias("qid"), "vec"), vectors.select(F.col("vec_id").alias("pid"), "vec", "label")


@query("flow_dense", _retrieved_sql("SELECT qid, pid, rank FROM ip_ranked"), uses="ip_ranked examples passages")
def flow_dense(spark: SparkSession, sf: str) -> DataFrame:
    """Contexts by inner product of vectors."""
    asked, stored = _vectors_of(spark, sf)
    return retrieve_dense_for_dataset(asked, stored.select("pid", "vec"), fx.qa_examples(spark, sf), fx.passages(spark, sf), first_only=True)


@query("flow_clustered", _retrieved_sql(_NEAR_IN_CELL), uses="cells vecs examples passages")
def flow_clustered(spark: SparkSession, sf: str) -> DataFrame:
    """Contexts among the vectors of a question's cell."""
    asked, stored = _vectors_of(spark, sf)
    centroids = dense.label_centroids(stored)
    assigned = dense.nearest_cells(stored.select("pid", "vec"), centroids, "pid")
    return retrieve_clustered_for_dataset(asked, assigned, centroids, fx.qa_examples(spark, sf), fx.passages(spark, sf), first_only=True)


_COSINE = """(SELECT * FROM (SELECT qid, pid, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, pid) AS rank FROM (
       SELECT a.vec_id AS qid, b.vec_id AS pid, round(list_inner_product(a.v, b.v) / sqrt(list_inner_product(b.v, b.v)), 6) AS score
       FROM vecs a, vecs b WHERE a.vec_id IN (SELECT id FROM examples))) WHERE rank <= 10)"""


@query(
    "flow_augmented",
    f"""SELECT id, pos, vocab_id FROM (SELECT id, pos, vocab_id, row_number() OVER (PARTITION BY id, pos ORDER BY round(logit, 6) DESC, vocab_id) AS n
        FROM (SELECT l.id, pos, vocab_id, sum(p * logit) AS logit
              FROM (SELECT qid AS id, rank, pos, v AS vocab_id, ((pos * 7 + v * 13 + qid * 29 + rank * 3) % 17) / 4.0 AS logit
                    FROM {_COSINE}, range(30) a(pos), range(16) b(v)) l
              JOIN (SELECT qid, rank, x / sum(x) OVER (PARTITION BY qid) AS p FROM (
                    SELECT qid, rank, exp(score - max(score) OVER (PARTITION BY qid)) AS x FROM {_COSINE})) w
              ON w.qid = l.id AND w.rank = l.rank GROUP BY l.id, pos, vocab_id)) WHERE n = 1""",
    uses="vecs examples",
)
def flow_augmented(spark: SparkSession, sf: str) -> DataFrame:
    """Hits by cosine, their logits mixed by score, and the decoded sequences."""
    asked, stored = _vectors_of(spark, sf)
    examples, k = fx.qa_examples(spark, sf), 10
    questions = examples.select(F.col("id").alias("qid"), "question")
    hits, _ = reading.augmented_inputs(asked, stored.select("pid", "vec"), questions, fx.passages(spark, sf), k)
    decoded, _ = reading.augmented_answers(hits, fx.sequence_logits(hits))
    return decoded.select("id", F.posexplode("ids").alias("pos", "vocab_id")).select(
        "id", F.col("pos").cast("bigint").alias("pos"), F.col("vocab_id").cast("bigint").alias("vocab_id")
    )


@query(
    "flow_evaluation_files",
    """SELECT round(100 * avg(coalesce(em, 0)), 6) AS exact_match, round(100 * avg(coalesce(f1, 0)), 6) AS f1, count(*) AS total
       FROM scored WHERE gold_no = 0""",
    uses="scored",
)
def flow_evaluation_files(spark: SparkSession, sf: str) -> DataFrame:
    """Scores from a ``{version, data[]}`` file of references and a file of answers by id."""
    pairs = fx.qa_pairs(spark, sf)
    answers = F.transform("golds", lambda g: F.struct(g.alias("text"), F.lit(0).alias("answer_start")))
    qa = F.struct(F.col("id").cast("string").alias("id"), F.lit("").alias("question"), answers.alias("answers"))
    paragraphs = F.array(F.struct(F.lit("").alias("context"), F.array(qa).alias("qas")))
    references, answered = fx.fresh_path(spark, "references"), fx.fresh_path(spark, "answers")
    sinks.write_articles(pairs.select("id", paragraphs.alias("paragraphs")), references, "id")
    sinks.write_predictions_object(pairs.filter(F.col("prediction_text").isNotNull()).select("id", "prediction_text"), answered)
    return reading.score_files(spark, references, answered, parts=True).select("exact_match", "f1", "total")
