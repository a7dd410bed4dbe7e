"""Model inputs and outputs as token sequences: padding, ids and pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lectern.functions.text import Tokenizer, attention_mask, cased_tokens, pad, strip, truncate
from lectern.operators.sizing import fits_broadcast

IGNORED_LABEL = -100
PAIR_LIMIT = 512


def pad_to_batch(df: DataFrame, batch: str = "batch_id", multiple: int = 8) -> DataFrame:
    """Pad ``tokens`` to the longest of the batch, rounded up to ``multiple``,
    and add the attention mask."""
    longest = F.max(F.size("tokens")).over(Window.partitionBy(batch))
    width = (F.ceil(longest / multiple) * multiple).cast("int")
    return (
        df.withColumn("_width", width)
        .withColumn("attention_mask", attention_mask(F.col("tokens"), F.col("_width")))
        .withColumn("tokens", pad(F.col("tokens"), F.col("_width")))
        .drop("_width")
    )


def unmask_labels(sequences: DataFrame, pad_id: int) -> DataFrame:
    """Replace the label that losses ignore by the padding id."""
    return sequences.withColumn(
        "ids", F.transform("ids", lambda i: F.when(i == IGNORED_LABEL, pad_id).otherwise(i))
    )


def decode(sequences: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(id, text): tokens of ``sequences`` (id, ids) without special ones, joined
    and stripped. ``vocabulary`` is (vocab_id, token, special)."""
    entries = sequences.select("id", F.posexplode_outer("ids").alias("pos", "vocab_id"))
    names = vocabulary.filter(~F.col("special")).select("vocab_id", "token")
    # frequent tokens make hot keys: a vocabulary that fits goes to the entries
    named = entries.join(F.broadcast(names) if fits_broadcast(names) else names, "vocab_id", "left")
    kept = F.array_sort(F.collect_list(F.when(F.col("token").isNotNull(), F.struct("pos", "token"))))
    words = F.array_join(F.transform(kept, lambda t: t["token"]), " ")
    return named.groupBy("id").agg(strip(words).alias("text"))


def question_passage_pairs(
    hits: DataFrame, questions: DataFrame, limit: int = PAIR_LIMIT, tokenizer: Tokenizer = cased_tokens
) -> DataFrame:
    """(qid, rank, pid, tokens): the question in front of each retrieved passage,
    cut to ``limit`` tokens. ``hits`` already carries the passage text."""
    paired = hits.join(questions.select("qid", "question"), "qid")
    tokens = F.concat(tokenizer(F.col("question")), tokenizer(F.col("text")))
    return paired.select("qid", "rank", "pid", truncate(tokens, limit).alias("tokens"))
