"""Retrieval for a whole dataset, as the reader wants it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lectern.operators.corpus import carry_gold, concat_passages, gather, scaled_by_global_max, to_eval_schema, to_predict_schema
from lectern.operators.dense import clustered_topk, vector_topk
from lectern.operators.sizing import count_up_to
from lectern.operators.sparse import Bm25Index, TfidfIndex, retrieve

DEFAULT_K = 10


def with_texts(hits: DataFrame, questions: DataFrame, passages: DataFrame, k: int) -> DataFrame:
    """Hits with their passage texts; questions times k bounds the hit list."""
    asked = count_up_to(questions)
    return gather(hits, passages, max_hits=None if asked is None else asked * k)


def contexts_for(hits: DataFrame, examples: DataFrame, passages: DataFrame, k: int) -> DataFrame:
    """(id, question, context): the k passages of each question as one context."""
    contexts = concat_passages(with_texts(hits, examples, passages, k)).withColumnRenamed("qid", "id")
    return examples.select("id", "question").join(contexts, "id")


def ranked_contexts(hits: DataFrame, examples: DataFrame, passages: DataFrame, k: int) -> DataFrame:
    """(id, question, rank, context, score): every hit with its passage as the context."""
    texts = with_texts(scaled_by_global_max(hits), examples, passages, k)
    ranked = texts.select(F.col("qid").alias("id"), "rank", F.col("text").alias("context"), "score")
    return examples.select("id", "question").join(ranked, "id")


def _shaped(contexts: DataFrame, examples: DataFrame, predict: bool, first_only: bool) -> DataFrame:
    if predict:
        return to_predict_schema(contexts)
    carried = carry_gold(contexts, examples, first_only)
    return to_eval_schema(carried) if first_only else carried


def retrieve_for_dataset(
    index: TfidfIndex | Bm25Index,
    examples: DataFrame,
    passages: DataFrame,
    k: int = DEFAULT_K,
    predict: bool = False,
    first_only: bool = False,
    fill: bool = False,
    independent: bool = False,
) -> DataFrame:
    """Sparse retrieval of ``examples`` (id, question[, context, answers]).

    ``predict`` gives (context, id, question). Otherwise the gold context and
    answers come along, the latter as the first answer's text with
    ``first_only``. ``independent`` gives one row per question and rank, each passage
    a context of its own, with its score over the largest of all."""
    questions = examples.select(F.col("id").alias("qid"), "question")
    hits = retrieve(index, questions, k, fill)
    if independent:
        return carry_gold(ranked_contexts(hits, examples, passages, k), examples, first_only)
    return _shaped(contexts_for(hits, examples, passages, k), examples, predict, first_only)


def retrieve_dense_for_dataset(
    question_vectors: DataFrame,
    passage_vectors: DataFrame,
    examples: DataFrame,
    passages: DataFrame,
    k: int = DEFAULT_K,
    predict: bool = False,
    first_only: bool = False,
) -> DataFrame:
    """The same from vectors: ``question_vectors`` (qid, vec), ``passage_vectors``
    (pid, vec)."""
    hits = vector_topk(question_vectors, passage_vectors, k)
    return _shaped(contexts_for(hits, examples, passages, k), examples, predict, first_only)


def retrieve_clustered_for_dataset(
    question_vectors: DataFrame,
    assigned: DataFrame,
    centroids: DataFrame,
    examples: DataFrame,
    passages: DataFrame,
    k: int = DEFAULT_K,
    nprobe: int = 1,
    predict: bool = False,
    first_only: bool = False,
) -> DataFrame:
    """The same among the passages of a question's nearest cells: ``assigned`` (pid, vec,
    cell) may be a stored table, and ``centroids`` (cell, vec) those it was built with."""
    hits = clustered_topk(question_vectors, assigned, centroids, k, nprobe)
    return _shaped(contexts_for(hits, examples, passages, k), examples, predict, first_only)
