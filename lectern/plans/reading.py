"""The three ways from retrieved passages to scored answers.

Models stay outside: each plan produces their inputs and consumes their outputs,
which are tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.functions.text import attention_mask, cased_tokens, clean_prompt, pad, prompt, target, truncate
from lectern.operators import metrics, mixture, reader, sequences, windows
from lectern.operators.corpus import first_answer
from lectern.operators.dense import cosine_topk
from lectern.plans.retrieval import with_texts
from lectern.sources import readers

INPUT_LIMIT = 384
ANSWER_LIMIT = 30


# -- extractive -----------------------------------------------------------

def extractive_train_features(examples: DataFrame, **limits) -> DataFrame:
    """Windows of (id, question, context, answers) with answer positions."""
    return windows.label_answers(windows.features(examples, **limits)).withColumnRenamed("id", "example_id")


def extractive_features(examples: DataFrame, **limits) -> DataFrame:
    """Windows to predict from. Examples of ``windows.rejected_questions`` have none and get the stand-in answer."""
    return windows.features(examples.select("id", "question", "context"), **limits).withColumnRenamed("id", "example_id")


def extractive_answers(
    features: DataFrame, logits: DataFrame, examples: DataFrame, with_null: bool = False, **limits
) -> tuple[DataFrame, DataFrame]:
    """(predictions, n-best) from ``logits`` (feature_id, start_logits, end_logits)."""
    scored = features.join(logits, "feature_id")
    candidates = reader.nbest(scored, examples, with_null=with_null, **limits)
    null = reader.null_scores(scored) if with_null else None
    return reader.best_answers(candidates, null), candidates


# -- generative -----------------------------------------------------------

def generative_inputs(examples: DataFrame, answers: bool = True) -> DataFrame:
    """(example_id, input, target): prompts cut to their token limits. ``answers``
    is a struct of texts, or already the text of the first."""
    columns = [
        F.col("id").alias("example_id"),
        F.array_join(truncate(cased_tokens(prompt(F.col("question"), F.col("context"))), INPUT_LIMIT), " ").alias("input"),
    ]
    if answers:
        plain = examples.schema["answers"].dataType.typeName() == "string"
        text = F.col("answers") if plain else first_answer(F.col("answers"))
        columns.append(F.array_join(truncate(cased_tokens(target(text)), ANSWER_LIMIT), " ").alias("target"))
    return examples.select(*columns)


def generative_answers(sequences_out: DataFrame, vocabulary: DataFrame, pad_id: int) -> DataFrame:
    """(id, prediction_text) of generated ids: decoded, cleaned and stripped."""
    texts = sequences.decode(sequences.unmask_labels(sequences_out, pad_id), vocabulary)
    return texts.select("id", clean_prompt(F.col("text")).alias("prediction_text"))


# -- retrieval-augmented --------------------------------------------------

def augmented_inputs(
    question_vectors: DataFrame, passage_vectors: DataFrame, questions: DataFrame, passages: DataFrame, k: int = 10
) -> tuple[DataFrame, DataFrame]:
    """(hits, pairs): the k passages per question by cosine, and the padded token
    pairs a generator reads, one per hit."""
    hits = cosine_topk(question_vectors, passage_vectors, k)
    pairs = sequences.question_passage_pairs(with_texts(hits, questions, passages, k), questions)
    width = sequences.PAIR_LIMIT
    return hits, pairs.select(
        "qid", "rank", "pid", pad(F.col("tokens"), width).alias("tokens"),
        attention_mask(F.col("tokens"), width).alias("attention_mask"),
    )


def augmented_answers(
    hits: DataFrame, logits: DataFrame, targets: DataFrame | None = None, max_hits: int | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """(id, ids) decoded from the score-weighted logits, and the exact match up to
    the end marker when ``targets`` (id, ids) are given."""
    mixed = mixture.mixed_logits(logits, mixture.retrieval_weights(hits), max_hits)
    decoded = mixture.as_sequence(mixture.greedy_decode(mixed))
    return decoded, None if targets is None else mixture.sequence_exact_match(decoded, targets)


# -- scores ---------------------------------------------------------------

def score(predictions: DataFrame, examples: DataFrame, all_golds: bool = False) -> DataFrame:
    """(exact_match, f1, total) of ``predictions`` (id, prediction_text)."""
    golds = examples.select("id", F.col("answers.text").alias("golds"))
    return metrics.evaluate(golds, predictions, all_golds)


def score_files(spark: SparkSession, references: str, predictions: str, all_golds: bool = False, parts: bool = False) -> DataFrame:
    """(exact_match, f1, total) of an object of answers by id against the questions of a ``{version, data[]}`` file."""
    questions = readers.read_questions(spark, references, parts=parts)
    golds = questions.select("id", F.col("answers.text").alias("golds"))
    return metrics.evaluate(golds, readers.read_predictions_object(spark, predictions, parts), all_golds)
