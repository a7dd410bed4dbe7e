"""Score-weighted mixing, decoding and loss over sequence logits in long form,
(id, rank, pos, vocab_id, logit), or in blocks, (id, rank, positions, logits): all logits of a
passage in one array, position after position."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.operators.reader import softmax_over
from lectern.operators.sizing import BROADCAST_ROWS

END_ID = 1
PAD_ID = 3
DIGITS = 6


def retrieval_weights(hits: DataFrame) -> DataFrame:
    """(qid, rank, p): softmax of the scores of a question's passages."""
    return softmax_over(hits.select("qid", "rank", "score"), "qid", "score", "p").select("qid", "rank", "p")


def mixed_logits(logits: DataFrame, weights: DataFrame, max_hits: int | None = None) -> DataFrame:
    """(id, pos, vocab_id, logit): sum over the passages of weight times logit.

    The logits outnumber the weights by positions times vocabulary. With a known
    bound on the hits the weights travel, and the logits move once, to the sum."""
    p = weights.select(F.col("qid").alias("id"), "rank", "p")
    if max_hits is not None and max_hits <= BROADCAST_ROWS:
        p = F.broadcast(p)
    return (
        logits.join(p, ["id", "rank"])
        .groupBy("id", "pos", "vocab_id")
        .agg(F.sum(F.col("p") * F.col("logit")).alias("logit"))
    )


def _mixed_block(rows: pa.Table) -> tuple[int, np.ndarray]:
    """(id, positions times vocabulary): the weighted sum of the passages of a question, in the order of their ranks."""
    rows = rows.sort_by("rank")
    total = None
    for p, logits in zip(rows["p"].to_pylist(), rows["logits"]):
        own = p * np.asarray(logits.values, np.float64)
        total = own if total is None else total + own
    return rows["id"][0].as_py(), total.reshape(rows["positions"][0].as_py(), -1)


def mix_blocks(blocks: DataFrame, weights: DataFrame) -> DataFrame:
    """(id, positions, logits): the mixture of a question's passages as one block. A task holds the block of a passage
    and the sum; the passages of a question are k rows."""

    def mix(rows: pa.Table) -> pa.Table:
        of, total = _mixed_block(rows)
        return pa.table({"id": [of], "positions": pa.array([len(total)], pa.int32()), "logits": pa.array([total.reshape(-1)], pa.list_(pa.float64()))})

    weighted = blocks.join(weights.select(F.col("qid").alias("id"), "rank", "p"), ["id", "rank"])
    return weighted.groupBy("id").applyInArrow(mix, "id long, positions int, logits array<double>")


def decode_blocks(blocks: DataFrame, weights: DataFrame) -> DataFrame:
    """(id, ids): at every position of the mixture the likeliest entry; equal ones go to the smaller id."""

    def decode(rows: pa.Table) -> pa.Table:
        of, total = _mixed_block(rows)
        return pa.table({"id": [of], "ids": pa.array([np.round(total, DIGITS).argmax(axis=1)], pa.list_(pa.int64()))})

    weighted = blocks.join(weights.select(F.col("qid").alias("id"), "rank", "p"), ["id", "rank"])
    return weighted.groupBy("id").applyInArrow(decode, "id long, ids array<long>")


def greedy_decode(mixed: DataFrame) -> DataFrame:
    """(id, pos, vocab_id): the likeliest entry; equal ones go to the smaller id."""
    best = F.max(F.struct(F.round("logit", DIGITS).alias("x"), (-F.col("vocab_id")).alias("v")))
    return mixed.groupBy("id", "pos").agg(best.alias("b")).select("id", "pos", (-F.col("b.v")).alias("vocab_id"))


def as_sequence(decoded: DataFrame) -> DataFrame:
    """(id, ids): the decoded entries in order."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "vocab_id")))
    return decoded.groupBy("id").agg(F.transform(ordered, lambda t: t["vocab_id"]).alias("ids"))


def sequence_loss(mixed: DataFrame, targets: DataFrame, pad_id: int = PAD_ID) -> DataFrame:
    """(loss): mean negative log-likelihood of the targets that are not padding.
    ``targets`` is (id, pos, target)."""
    wanted = targets.filter(F.col("target") != pad_id)
    top = F.max("logit").over(Window.partitionBy("id", "pos"))
    per_position = (
        mixed.join(wanted, ["id", "pos"])
        .withColumn("m", top)
        .groupBy("id", "pos", "m")
        .agg(
            F.sum(F.exp(F.col("logit") - F.col("m"))).alias("s"),
            F.max(F.when(F.col("vocab_id") == F.col("target"), F.col("logit"))).alias("x"),
        )
    )
    nll = F.col("m") + F.log("s") - F.col("x")
    return per_position.agg(F.round(F.avg(nll), DIGITS).alias("loss"))


def pair_vectors(hits: DataFrame, queries: DataFrame, passages: DataFrame) -> DataFrame:
    """(qid, rank, pid, vec): question vector followed by passage vector."""
    q = queries.select("qid", F.col("vec").alias("_q"))
    p = passages.select("pid", F.col("vec").alias("_p"))
    return hits.join(q, "qid").join(p, "pid").select("qid", "rank", "pid", F.concat("_q", "_p").alias("vec"))


def until_end(ids: Column, end_id: int = END_ID) -> Column:
    """Ids before the first end marker; null without one."""
    at = F.array_position(ids, end_id)
    return F.when(at > 0, F.slice(ids, F.lit(1), (at - 1).cast("int")))


def sequence_exact_match(predicted: DataFrame, targets: DataFrame, end_id: int = END_ID) -> DataFrame:
    """(exact_match, total): share of sequences equal up to their end markers. A
    sequence without a marker does not match but counts in the total."""
    both = targets.select("id", F.col("ids").alias("_y")).join(
        predicted.select("id", F.col("ids").alias("_p")), "id", "left"
    )
    same = F.coalesce(until_end(F.col("_p"), end_id) == until_end(F.col("_y"), end_id), F.lit(False))
    return both.agg(
        F.round(F.avg(same.cast("double")), DIGITS).alias("exact_match"), F.count("*").alias("total")
    )
