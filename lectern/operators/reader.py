"""Answer spans from score tables.

A feature is a row (feature_id, example_id, window_no, offsets, start_logits,
end_logits). Candidates are formed and cut inside that row, so only the best of
each feature move to the ranking of their example."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.operators.sizing import top_k

N_BEST = 20
MAX_ANSWER_LENGTH = 30
NULL_THRESHOLD = 0.0
SCORE_DIGITS = 6
EMPTY = "empty"  # fixed value: stands in when an example has no candidate


def _candidate_order() -> list[Column]:
    return [F.col("score").desc(), F.col("window_no"), F.col("start_index"), F.col("end_index")]


def _largest(logits: str, n: int) -> Column:
    """The ``n`` largest logits of the row as (i, x), largest first, then by i."""
    keyed = F.transform(logits, lambda x, i: F.struct((-x).alias("m"), i.alias("i"), x.alias("x")))
    return F.slice(F.array_sort(keyed), 1, n)


def top_positions(features: DataFrame, logits: str, n_best: int = N_BEST) -> DataFrame:
    """(feature_id, n, i, logit): the ``n_best`` positions of every feature."""
    picked = features.select("feature_id", F.posexplode(_largest(logits, n_best)).alias("n", "t"))
    return picked.select("feature_id", (F.col("n") + 1).alias("n"), F.col("t")["i"].alias("i"), F.col("t")["x"].alias("logit"))


def candidate_spans(
    features: DataFrame,
    n_best: int = N_BEST,
    max_answer_length: int = MAX_ANSWER_LENGTH,
    max_context: str | None = None,
    keep: int | None = None,
) -> DataFrame:
    """Spans of every feature: best starts by best ends, in order, short enough
    and inside the context. ``max_context`` names an optional array of booleans
    that marks the positions allowed as a start. ``keep`` cuts each feature to
    its best spans before any of them leaves the row."""
    bound = features.withColumn("_s", _largest("start_logits", n_best)).withColumn("_e", _largest("end_logits", n_best))
    known = F.size("offsets")

    def pairs(s: Column) -> Column:
        fitting = F.filter(
            "_e",
            lambda e: (e["i"] >= s["i"])
            & (e["i"] < s["i"] + max_answer_length)
            & (e["i"] < known)
            & F.get("offsets", e["i"]).isNotNull(),
        )
        return F.transform(
            fitting,
            lambda e: F.struct(
                (-F.round(s["x"] + e["x"], SCORE_DIGITS)).alias("m"),
                s["i"].alias("start_index"),
                e["i"].alias("end_index"),
                s["x"].alias("start_logit"),
                e["x"].alias("end_logit"),
                F.get("offsets", s["i"])["s"].alias("s"),
                F.get("offsets", e["i"])["e"].alias("e"),
            ),
        )

    def allowed(s: Column) -> Column:
        ok = (s["i"] < known) & F.get("offsets", s["i"]).isNotNull()
        return ok & F.coalesce(F.get(max_context, s["i"]), F.lit(False)) if max_context else ok

    spans = F.flatten(F.transform(F.filter("_s", allowed), pairs))
    if keep is not None:
        spans = F.slice(F.array_sort(spans), 1, keep)
    return (
        bound.select("feature_id", "example_id", "window_no", F.inline(spans)).withColumn("score", -F.col("m")).drop("m")
    )


def null_scores(features: DataFrame) -> DataFrame:
    """(example_id, window_no, start_logit, end_logit, score): the smallest score
    of the first position over the windows of an example."""
    first = features.select(
        "example_id", "window_no",
        F.get("start_logits", 0).alias("start_logit"), F.get("end_logits", 0).alias("end_logit"),
    ).withColumn("score", F.round(F.col("start_logit") + F.col("end_logit"), SCORE_DIGITS))
    best = first.groupBy("example_id").agg(
        F.min(F.struct("score", "window_no", "start_logit", "end_logit")).alias("b")
    )
    return best.select("example_id", "b.window_no", "b.start_logit", "b.end_logit", "b.score")


def best_candidates(spans: DataFrame, n_best: int = N_BEST) -> DataFrame:
    return top_k(spans, "example_id", _candidate_order(), n_best)


def nbest(
    features: DataFrame, examples: DataFrame, n_best: int = N_BEST, with_null: bool = False, **limits
) -> DataFrame:
    """(example_id, rank, text, start_logit, end_logit, score, probability).

    ``with_null`` makes the null score a candidate with empty text, put back at
    the end when the cut removes it. An example without candidates, or with an
    empty one only, gets the fixed stand-in first."""
    columns = ["example_id", "window_no", "start_index", "end_index", "start_logit", "end_logit", "s", "e", "score"]
    pool = candidate_spans(features, n_best, keep=n_best, **limits).select(*columns)
    if not with_null:
        ranked = best_candidates(pool, n_best)
    else:
        marker = F.lit(-1)
        null = null_scores(features).select(
            "example_id", "window_no", marker.alias("start_index"), marker.alias("end_index"),
            "start_logit", "end_logit", F.lit(0).alias("s"), F.lit(0).alias("e"), "score",
        )
        place = F.row_number().over(Window.partitionBy("example_id").orderBy(*_candidate_order()))
        ranked = (
            pool.unionByName(null)
            .withColumn("rank", place)
            .filter((F.col("rank") <= n_best) | (F.col("start_index") == -1))
            .withColumn("rank", F.least("rank", F.lit(n_best + 1)))
        )
    return softmax_over(with_text(ranked, examples), "example_id", "score", "probability")


def with_text(ranked: DataFrame, examples: DataFrame) -> DataFrame:
    """Cut each answer out of its context and add the stand-in where it is due."""
    contexts = examples.select(F.col("id").alias("example_id"), "context")
    cut = F.substring(F.col("context"), F.col("s") + 1, F.col("e") - F.col("s"))
    found = contexts.join(ranked, "example_id", "left").withColumn("text", cut)
    count = F.count("rank").over(Window.partitionBy("example_id"))

    def entry(rank: Column, text: Column, start: Column, end: Column, score: Column) -> Column:
        return F.struct(
            rank.cast("int").alias("rank"), text.alias("text"), start.alias("start_logit"),
            end.alias("end_logit"), score.alias("score"),
        )

    def own(shift: int) -> Column:
        return entry(F.col("rank") + shift, F.col("text"), F.col("start_logit"), F.col("end_logit"), F.col("score"))

    zero = F.lit(0.0)
    stand_in = entry(F.lit(1), F.lit(EMPTY), zero, zero, zero)
    entries = (
        F.when(F.col("rank").isNull(), F.array(stand_in))
        .when((F.col("_n") == 1) & (F.col("text") == ""), F.array(stand_in, own(1)))
        .otherwise(F.array(own(0)))
    )
    return found.withColumn("_n", count).select("example_id", F.inline(entries))


def softmax_over(df: DataFrame, by: str, score: str, out: str) -> DataFrame:
    """Probability of each row within its group, shifted by the group's maximum."""
    w = Window.partitionBy(by)
    shifted = df.withColumn("_x", F.exp(F.col(score) - F.max(score).over(w)))
    return shifted.withColumn(out, F.col("_x") / F.sum("_x").over(w)).drop("_x")


def best_answers(candidates: DataFrame, null: DataFrame | None = None, threshold: float = NULL_THRESHOLD) -> DataFrame:
    """(id, prediction_text), and score_diff when ``null`` scores are given: then
    the best non-empty candidate loses to the empty answer if it scores less than
    the null score by more than ``threshold``."""
    if null is None:
        first = candidates.filter(F.col("rank") == 1)
        return first.select(F.col("example_id").alias("id"), F.col("text").alias("prediction_text"))
    best = (
        candidates.filter(F.col("text") != "")
        .groupBy("example_id")
        .agg(F.min(F.struct("rank", "text", "start_logit", "end_logit")).alias("b"))
    )
    judged = null.join(best, "example_id", "full").withColumn(  # an example without windows has no null score
        "score_diff", F.round(F.col("score") - F.col("b.start_logit") - F.col("b.end_logit"), SCORE_DIGITS)
    )
    answer = F.when(F.col("b").isNull() | (F.col("score_diff") > threshold), F.lit("")).otherwise(F.col("b.text"))
    return judged.select(F.col("example_id").alias("id"), answer.alias("prediction_text"), "score_diff")


def nbest_report(candidates: DataFrame) -> DataFrame:
    """(id, nbest): one ordered list of structs per example."""
    entry = F.struct("rank", "text", "start_logit", "end_logit", "probability")
    ordered = F.array_sort(F.collect_list(entry))
    return candidates.groupBy(F.col("example_id").alias("id")).agg(
        F.transform(
            ordered,
            lambda c: F.struct(c["text"].alias("text"), c["start_logit"].alias("start_logit"), c["end_logit"].alias("end_logit"), c["probability"].alias("probability")),
        ).alias("nbest")
    )
