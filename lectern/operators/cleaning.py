"""Cleaning of question answering examples, with answer offsets kept true."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.text import nfkc, nfkc_all, remap_offset, rewrite_special

Clean = Callable[[Column], Column]


def remap_answers(examples: DataFrame, clean: Clean, clean_texts: bool = False) -> DataFrame:
    """Clean the context and move every answer start to where it lands.

    The answer text is left alone unless ``clean_texts`` is set."""
    starts = F.transform("answers.answer_start", lambda s: remap_offset(F.col("context"), s, clean))
    texts = F.transform("answers.text", clean) if clean_texts else F.col("answers.text")
    answers = F.struct(texts.alias("text"), starts.alias("answer_start"))
    # two steps: inside a lambda, a name of the same projection would win
    return examples.withColumn("answers", answers).withColumn("context", clean(F.col("context")))


def normalize_examples(examples: DataFrame) -> DataFrame:
    """Unicode NFKC of context, answers and question. NFKC can change lengths, so
    the answer starts move too. The prefixes of all answers are flattened into
    one array column because a Python function cannot run inside ``transform``."""
    prefixes = F.transform("answers.answer_start", lambda s: F.substring(F.col("context"), F.lit(1), s))
    joined = examples.withColumns({"_pre": prefixes, "_ans": F.col("answers.text")})
    cleaned = joined.withColumns(
        {
            "context": nfkc("context"),
            "question": nfkc("question"),
            "_pre": nfkc_all("_pre"),
            "_ans": nfkc_all("_ans"),
        }
    )
    answers = F.struct(
        F.col("_ans").alias("text"), F.transform("_pre", lambda p: F.length(p)).alias("answer_start")
    )
    return cleaned.withColumn("answers", answers).drop("_pre", "_ans")


def clean_examples(examples: DataFrame) -> DataFrame:
    """Normalise, then rewrite special characters in the context."""
    return remap_answers(normalize_examples(examples), rewrite_special)
