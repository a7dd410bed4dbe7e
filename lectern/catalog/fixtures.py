"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lectern.functions.text import cased_tokens, whitespace_tokens
from lectern.operators.corpus import dedup_in_order, gather
from lectern.operators.sizing import count_up_to
from lectern.operators.sparse import Bm25Index, IndexTables, TfidfIndex, build_index
from lectern.operators.windows import features
from lectern.session import shared_dir
from lectern.sources.index_store import TableStore


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _key(spark: SparkSession, sf_dir: str) -> dict:
    """Derived inputs are kept for one application: each run derives its own."""
    return {"application": spark.sparkContext.applicationId, "input": sf_dir}


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    return TableStore(spark).load_or_build(name, _key(spark, sf_dir), build)


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pid, text, block): the stored passages."""
    docs = table(spark, sf_dir, "documents")
    return TableStore(spark).load_or_build_passages(_key(spark, sf_dir), lambda: dedup_in_order(docs))


def index(spark: SparkSession, sf_dir: str, method: str) -> TfidfIndex | Bm25Index:
    tables = IndexTables(TableStore(spark), _key(spark, sf_dir))
    return build_index(method, passages(spark, sf_dir), tables=tables)


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("question")
    )


def qa_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "qa_examples", lambda: _qa_examples(spark, sf_dir))


def _qa_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, question, context, answers): benchmark texts with the first passage
    that holds them.

    A passage that holds a text holds its inner words as whole words, so the
    second to fourth word are the join key. Only ids meet on it; the texts of the
    candidates are fetched afterwards and ``contains`` decides."""
    items = questions(spark, sf_dir)
    keyed = items.select("qid", F.array_join(F.slice(cased_tokens(F.col("question")), 2, 3), " ").alias("anchor"))
    words = passages(spark, sf_dir).select("pid", cased_tokens(F.col("text")).alias("_t"))
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("_t") - 2, F.lit(1))),
        lambda i: F.array_join(F.slice("_t", i, 3), " "),
    )
    anchored = words.select("pid", F.explode_outer(F.array_distinct(runs)).alias("anchor"))
    # kept, so that they are counted: few go to the passages, which stay where they are
    candidates = stored(spark, sf_dir, "qa_candidates", lambda: anchored.join(keyed, "anchor").select("qid", "pid").distinct())
    near = gather(candidates, passages(spark, sf_dir), max_hits=count_up_to(candidates))
    found = near.join(items, "qid").filter(F.contains("text", "question"))
    first = found.groupBy("qid", "question").agg(F.min(F.struct("pid", "text")).alias("_p"))
    start = F.instr(F.col("context"), F.col("question")) + 39
    answers = F.struct(
        F.array(F.substring("question", 41, 20)).alias("text"), F.array(start.cast("int")).alias("answer_start")
    )
    return first.select(F.col("qid").alias("id"), "question", F.col("_p")["text"].alias("context")).withColumn(
        "answers", answers
    )


def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "qa_pairs", lambda: _qa_pairs(spark, sf_dir))


def _qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, prediction_text, golds): a conversation turn without its first words
    is the prediction, missing for turns under six words; the golds are the turn
    without its last words and, by role, the whole turn or all but two words."""
    turns = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"), "role", cased_tokens(F.col("text")).alias("w")
    )
    n = F.size("w")

    def words(first: int, count: Column) -> Column:
        return F.array_join(F.slice("w", F.lit(first), F.greatest(count, F.lit(0))), " ")

    whole_or_tail = F.when(F.col("role") == "user", F.array_join("w", " ")).otherwise(words(3, n - 2))
    return turns.select(
        "id",
        F.when(n >= 6, words(5, n - 4)).alias("prediction_text"),
        F.array(words(1, n - 4), whole_or_tail).alias("golds"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"), "label")


def vectors_by_cell(spark: SparkSession, sf_dir: str, build: Callable[[], DataFrame]) -> DataFrame:
    return TableStore(spark).load_or_build_cells(_key(spark, sf_dir), build)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder for a sink, in the folder all executors share."""
    return f"{shared_dir(spark)}/out/{name}-{uuid.uuid4().hex}"


def scored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reader features of every example with start and end logits by formula."""
    return stored(spark, sf_dir, "scored_features", lambda: _scored_features(spark, sf_dir))


def _scored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = features(qa_examples(spark, sf_dir)).withColumnRenamed("id", "example_id")
    at = F.sequence(F.lit(0), F.size("tokens") - 1)

    def logits(by_position: int, by_example: int) -> Column:
        return F.transform(
            at,
            lambda i: ((i * by_position + F.col("example_id") * by_example + F.col("window_no") * 53) % 1009) / 100.0 - 5,
        )

    return read.select(
        "feature_id", "example_id", "window_no", "tokens", "offsets",
        logits(37, 101).alias("start_logits"), logits(41, 211).alias("end_logits"),
    )


# ids of the special tokens in front of the vocabulary
UNKNOWN_ID, PAD_ID, SPECIAL_IDS = 2, 3, 4


def token_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vocab_id, token, special): special tokens, then the capped vocabulary in
    its order. The cap bounds the numbering to one small task."""
    terms = index(spark, sf_dir, "tfidf").vocabulary
    place = F.row_number().over(Window.orderBy(F.col("cf").desc(), F.col("term").asc())) + SPECIAL_IDS - 1
    named = terms.select(place.cast("int").alias("vocab_id"), F.col("term").alias("token"), F.lit(False).alias("special"))
    marks = spark.createDataFrame(
        [(0, "<s>", True), (1, "</s>", True), (2, "<unk>", True), (3, "<pad>", True)],
        "vocab_id int, token string, special boolean",
    )
    return marks.unionByName(named)


def label_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, ids): conversation turns as vocabulary ids, an end marker, and eight
    masked labels."""
    turns = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"),
        F.posexplode_outer(whitespace_tokens(F.col("text"))).alias("pos", "token"),
    )
    known = token_vocabulary(spark, sf_dir).filter(~F.col("special")).select("token", "vocab_id")
    numbered = turns.join(F.broadcast(known), "token", "left").withColumn(
        "vocab_id", F.coalesce("vocab_id", F.lit(UNKNOWN_ID))
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", "vocab_id")))
    tail = F.array(F.lit(1), *[F.lit(-100)] * 8)
    return numbered.groupBy("id").agg(F.concat(F.transform(ordered, lambda t: t["vocab_id"]), tail).alias("ids"))


def sequence_logits(hits: DataFrame) -> DataFrame:
    """(id, rank, pos, vocab_id, logit) by formula for each retrieved passage:
    30 positions over 16 vocabulary ids."""
    spread = hits.select(
        F.col("qid").alias("id"), "rank", F.explode(F.sequence(F.lit(0), F.lit(29))).alias("pos")
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("vocab_id"))
    value = (F.col("pos") * 7 + F.col("vocab_id") * 13 + F.col("id") * 29 + F.col("rank") * 3) % 17
    return spread.withColumn("logit", value / 4.0)
