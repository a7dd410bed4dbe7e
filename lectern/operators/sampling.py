"""Samples, negatives, triplets and batches, with seeds instead of state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.vectors import dot
from lectern.operators.sizing import first_rows, positions

SEED = 2024
NEGATIVES = 2
DIGITS = 6


def shuffle_hash(key: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def fixed_sample(df: DataFrame, key: str, n: int = 1000, seed: int = SEED) -> DataFrame:
    """``n`` rows without replacement: the smallest hashes of key and seed."""
    hashed = df.withColumn("_h", shuffle_hash(F.col(key), seed))
    first = F.conv(F.substring("_h", 1, 4), 16, 10).cast("long")
    return first_rows(hashed, first, [F.col("_h"), F.col(key)], n).drop("_h")


def draw_negatives(positives: DataFrame, corpus: DataFrame, negatives: int = NEGATIVES, seed: int = SEED) -> DataFrame:
    """(qid, slot, pid): the positive in slot 0, then ``negatives`` draws with
    replacement from all other passages.

    A draw picks one of the n - 1 others and steps over the positive, which has
    the law of drawing again until the positive is missed. Draws hash question,
    slot and seed, so those of one question do not depend on each other."""
    n = corpus.agg(F.count("*")).scalar()
    slots = positives.select("qid", F.col("pid").alias("_pos"), F.explode(F.sequence(F.lit(0), F.lit(negatives))).alias("slot"))
    named = F.concat_ws(":", F.col("qid").cast("string"), F.col("slot").cast("string"), F.lit(str(seed)))
    draw = F.pmod(F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long"), F.greatest(n - 1, F.lit(1)))
    pid = F.when(F.col("slot") == 0, F.col("_pos")).otherwise(draw + F.when(draw >= F.col("_pos"), 1).otherwise(0))
    return slots.select("qid", "slot", pid.cast("long").alias("pid"))


def triplets(drawn: DataFrame, questions: DataFrame, passages: DataFrame) -> DataFrame:
    """(qid, question, passages): positive first, then the negatives."""
    texts = drawn.join(passages.select("pid", "text"), "pid")
    ordered = F.array_sort(F.collect_list(F.struct("slot", "text")))
    listed = texts.groupBy("qid").agg(F.transform(ordered, lambda t: t["text"]).alias("passages"))
    return questions.select("qid", "question").join(listed, "qid")


def contrastive_loss(drawn: DataFrame, queries: DataFrame, passages: DataFrame) -> DataFrame:
    """(loss): mean negative log-softmax of the positive's inner product among
    those of its group. ``queries`` (qid, vec), ``passages`` (pid, vec)."""
    scored = (
        drawn.join(passages.select("pid", F.col("vec").alias("_p")), "pid")
        .join(queries.select("qid", F.col("vec").alias("_q")), "qid")
        .select("qid", "slot", dot(F.col("_q"), F.col("_p")).alias("x"))
    )
    groups = scored.groupBy("qid").agg(
        F.collect_list("x").alias("xs"), F.max("x").alias("m"), F.max(F.when(F.col("slot") == 0, F.col("x"))).alias("x0")
    )
    lse = F.col("m") + F.log(F.aggregate(F.transform("xs", lambda x: F.exp(x - F.col("m"))), F.lit(0.0), lambda a, x: a + x))
    return groups.agg(F.round(F.avg(lse - F.col("x0")), DIGITS).alias("loss"))


def shuffled_batches(df: DataFrame, key: str, batch_size: int = 8, seed: int = SEED) -> DataFrame:
    """Add batch_id: rows in hash order, ``batch_size`` to a batch. The first 60
    bits of the hash give the order; their even spread bounds the buckets."""
    order = F.conv(F.substring(shuffle_hash(F.col(key), seed), 1, 15), 16, 10).cast("long")
    placed = positions(df.withColumn("_h", order), "_h", "_n", tie=[key], shifts=(44,))
    return placed.withColumn("batch_id", F.floor(F.col("_n") / batch_size)).drop("_h", "_n")
