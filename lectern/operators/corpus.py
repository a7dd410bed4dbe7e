"""Relational operators over the corpus, the question tables and hit lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lectern.operators.sizing import BROADCAST_ROWS, positions, top_k
from lectern.sources.index_store import PASSAGE_BLOCK_BITS

SCORE_DIGITS = 6


def dedup_in_order(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(pid, text): distinct texts, numbered by their first occurrence.

    Texts are told apart by a 256-bit digest, so only digests and ids are grouped and
    numbered. Copies collapse before the shuffle, so a text held by many rows is
    no hot key. The texts move once, to meet their number by id. Texts that share an id, and those found without
    any id, which come last, are in the order of their digests."""
    rows = docs.select(F.col(doc_id).alias("_first"), F.col(text).alias("text"))
    # a missing text has the empty digest, which no text has
    digest = F.coalesce(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), F.lit(b"")).alias("_digest")
    first_seen = rows.select("_first", digest).groupBy("_digest").agg(F.min("_first").alias("_first"))
    with_id = first_seen.filter("_first is not null")
    numbered = positions(with_id, "_first", "pid", tie=("_digest",))
    texts = rows.select("_first", digest, "text").withColumnRenamed("_digest", "_d")
    met = texts.join(numbered.withColumnRenamed("_digest", "_d"), ["_d", "_first"])
    # an id that occurs twice with one text brings it twice; both lie where they met
    named = met.dropDuplicates(["_d", "_first"]).select("pid", "text")
    if rows.filter("_first is null").isEmpty():
        return named
    front = F.coalesce(F.conv(F.hex(F.substring("_digest", 1, 7)), 16, 10).cast("long"), F.lit(-1).cast("long"))
    lone = first_seen.filter("_first is null").select("_digest", front.alias("_front"))
    placed = positions(lone, "_front", "place", tie=("_digest",), shifts=(36,))
    before = with_id.agg(F.count("*")).scalar()
    found = texts.filter("_first is null").join(placed, F.col("_d") == F.col("_digest"))
    last = found.withColumn("pid", F.col("place") + before).dropDuplicates(["pid"])
    return named.unionByName(last.select("pid", "text"))


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.select(F.col(text).alias("text")).dropDuplicates(["text"])


def union_splits(*splits: DataFrame) -> DataFrame:
    """All rows of all splits, copies kept."""
    out = splits[0]
    for split in splits[1:]:
        out = out.unionByName(split)
    return out


def select_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def to_predict_schema(results: DataFrame) -> DataFrame:
    return results.select(*(F.col(c).cast("string").alias(c) for c in ("context", "id", "question")))


def to_eval_schema(results: DataFrame) -> DataFrame:
    names = ("answers", "context", "original_context", "id", "question")
    return results.select(*(F.col(c).cast("string").alias(c) for c in names))


def first_answer(answers: Column) -> Column:
    return F.get(answers["text"], 0)


def carry_gold(results: DataFrame, gold: DataFrame, first_only: bool = False) -> DataFrame:
    """Add the gold context and answers where a question has them."""
    answers = first_answer(F.col("answers")) if first_only else F.col("answers")
    known = gold.select("id", F.col("context").alias("original_context"), answers.alias("answers"))
    return results.join(known, "id", "left")


def rank_hits(scores: DataFrame, k: int, by: str = "qid", ascending: bool = False) -> DataFrame:
    """Top-k per question. The rank uses the rounded score, then the smaller
    passage id, so it does not depend on the order of a floating sum."""
    rounded = scores.withColumn("score", F.round("score", SCORE_DIGITS))
    order = F.col("score").asc() if ascending else F.col("score").desc()
    return top_k(rounded, by, [order, F.col("pid").asc()], k)


def gather(hits: DataFrame, table: DataFrame, key: str = "pid", max_hits: int | None = None) -> DataFrame:
    """Fetch the rows the hits point at. ``max_hits`` is a known bound on the
    hit list (questions times k): below the broadcast size the hits go to the
    table. Otherwise both sides shuffle on the key, and adaptive execution
    splits a passage that very many questions hit."""
    on = [key]
    if "block" in table.columns:
        # a stored passage table: the hits' blocks prune its directories. Spark
        # plans that only for a side with a filter, so there is one
        hits = hits.withColumn("block", F.shiftright(key, PASSAGE_BLOCK_BITS)).filter(F.col("block") >= 0)
        on = ["block", key]
    if max_hits is not None and max_hits <= BROADCAST_ROWS:
        return table.join(F.broadcast(hits), on).drop("block")
    return hits.join(table, on).drop("block")


def concat_passages(hits: DataFrame, by: str = "qid") -> DataFrame:
    """One context per question: its k passages joined by a space in rank order."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "text")))
    return hits.groupBy(by).agg(F.array_join(F.transform(ordered, lambda h: h["text"]), " ").alias("context"))


def scaled_by_global_max(hits: DataFrame) -> DataFrame:
    top = hits.agg(F.max("score")).scalar()
    return hits.withColumn("score", F.round(F.try_divide("score", top), SCORE_DIGITS))


def at_rank(hits: DataFrame, rank: int) -> DataFrame:
    return hits.filter(F.col("rank") == rank)


def features_per_example(features: DataFrame) -> DataFrame:
    return features.groupBy("example_id").agg(F.array_sort(F.collect_list("feature_id")).alias("feature_ids"))


def predictions_to_rows(mapping: DataFrame, col: str = "predictions") -> DataFrame:
    return mapping.select(F.explode(col).alias("id", "prediction_text"))


def length_summary(df: DataFrame, length: Column, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles and max of a length column. Exact
    quantiles cost one counter per distinct length, not one entry per row."""
    measured = df.select(*by, length.cast("double").alias("_n"))
    quartiles = F.percentile("_n", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        measured.groupBy(*by)
        .agg(
            F.count("_n").alias("count"),
            F.avg("_n").alias("mean"),
            F.stddev("_n").alias("std"),
            F.min("_n").alias("min"),
            quartiles.alias("_q"),
            F.max("_n").alias("max"),
        )
        .select(
            *by, "count", "mean", "std", "min",
            F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75"), "max",
        )
    )
