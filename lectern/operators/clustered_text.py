"""Clustered retrieval over TF-IDF vectors.

Centres are postings like passages: assigning a passage is a join on its terms and a sum,
moving a centre is a sum over the postings of its passages. Neither vocabulary nor vectors visit
the driver. Distances come from the shared terms alone: for unit vectors L2 squared is 2 - 2 cos."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.operators.sizing import fits_broadcast, sized_join, top_k
from lectern.operators.sparse import TfidfIndex, question_terms
from lectern.session import shared_dir

SCORE_DIGITS = 6
CENTRE_DIGITS = 9


@dataclass
class TextCells:
    """Centres (cell, term, w) and the cell of every passage (pid, cell)."""

    centres: DataFrame
    assigned: DataFrame


def seeded_centres(weights: DataFrame, cells: int, seed: int = 2024) -> DataFrame:
    """(cell, term, w): the weights of ``cells`` passages with a known term, drawn by a hash of id and seed."""
    draw = F.md5(F.concat_ws(":", F.col("pid").cast("string"), F.lit(str(seed))))
    drawn = weights.select("pid").distinct().orderBy(draw, "pid").limit(cells)
    numbered = drawn.select("pid", (F.row_number().over(Window.orderBy(draw, "pid")) - 1).cast("int").alias("cell"))
    return weights.join(F.broadcast(numbered), "pid").select("cell", "term", "w")


def nearest_centres(weights: DataFrame, ids: DataFrame, centres: DataFrame, by: str) -> DataFrame:
    """(by, cell, d2) of every one of ``ids``: the centre at the smallest squared distance, equal ones by number.
    ``weights`` (by, term, w) are of unit length; an id without any is the zero vector.

    A term comes with its weights in all centres, which are few, as the columns of one row. A weight
    meets one row then and not one per cell, and the sums of an id are one row. Where the centres
    fit on every executor, weights that lie by id do not move."""
    cell = centres.schema["cell"].dataType
    lengths = centres.groupBy("cell").agg(F.sum(F.col("w") * F.col("w")).alias("c2")).orderBy("cell").collect()  # a row per cell
    numbers = [r["cell"] for r in lengths]
    if not numbers:
        return ids.select(by, F.lit(None).cast(cell).alias("cell"), F.lit(None).cast("double").alias("d2"))
    wide = centres.groupBy("term").pivot("cell", numbers).agg(F.sum("w"))
    terms = wide.select("term", *[F.col(f"`{n}`").alias(f"_{i}") for i, n in enumerate(numbers)])
    # left: an id whose terms no centre has is not the zero vector
    shared = sized_join(weights.select(by, "term", "w"), terms, ["term"], salt_by=by, fits=fits_broadcast(terms), how="left")
    dots = [F.coalesce(F.sum(F.col("w") * F.col(f"_{i}")), F.lit(0.0)).alias(f"_{i}") for i in range(len(numbers))]

    def nearest(own: int, dot: Callable[[int], Column]) -> Column:
        found = [
            F.struct(F.round(F.lit(own + r["c2"]) - 2 * dot(i), SCORE_DIGITS).alias("d2"), F.lit(r["cell"]).cast(cell).alias("cell"))
            for i, r in enumerate(lengths)
        ]
        return F.array_min(F.array(*found))

    met = shared.groupBy(by).agg(*dots).select(by, nearest(1, lambda i: F.col(f"_{i}")).alias("met"))
    best = F.coalesce("met", nearest(0, lambda i: F.lit(0.0)))
    return ids.select(by).join(met, by, "left").select(by, best.alias("best")).select(by, F.col("best.cell").alias("cell"), F.col("best.d2").alias("d2"))


def moved_centres(weights: DataFrame, assigned: DataFrame) -> DataFrame:
    """(cell, term, w): the rounded mean of the passages of each cell; one without passages or terms goes."""
    sizes = assigned.groupBy("cell").agg(F.count("*").alias("n"))
    sums = weights.join(assigned.select("pid", "cell"), "pid").groupBy("cell", "term").agg(F.sum("w").alias("w"))
    mean = F.round(F.col("w") / F.col("n"), CENTRE_DIGITS).alias("w")
    return sums.join(F.broadcast(sizes), "cell").select("cell", "term", mean).filter("w <> 0")


def fit_cells(index: TfidfIndex, cells: int = 64, seed: int = 2024, rounds: int = 10) -> TextCells:
    """Cells after ``rounds`` of k-means from a seeded start. The centres, at most cells times vocabulary
    rows, are written between the rounds, so that no round is computed twice."""
    shared_dir(index.passages.sparkSession)  # where checkpoints go
    centres = seeded_centres(index.weights, cells, seed).checkpoint()
    for _ in range(rounds):
        centres = moved_centres(index.weights, nearest_centres(index.weights, index.passages, centres, "pid").checkpoint()).checkpoint()
    assigned = index.tables.by_passage(
        f"tfidf_cells_{cells}_{seed}_{rounds}", index.passages,
        lambda n: nearest_centres(index.weights, index.passages, centres, "pid").select("pid", "cell"), sort_by="pid", placed=False,
    )
    return TextCells(centres, assigned)


def clustered_tfidf_topk(index: TfidfIndex, cells: TextCells, questions: DataFrame, k: int) -> DataFrame:
    """(qid, rank, pid, score): nearest passages by L2 squared within the cell of
    each question, ascending.

    A passage of the cell without a shared term is at distance 2, or 1 if it has
    no known term at all; a question without a known term is at distance 1 of the former and
    0 of the latter. The first k of each kind complete a short list."""
    lost = index.unknown_questions(questions).select("qid", F.lit(1.0).alias("_lost"))
    weights = index.question_weights(questions)
    question_cells = nearest_centres(weights, questions, cells.centres, "qid").select("qid", F.col("cell").alias("qcell"))
    fits = fits_broadcast(question_terms(questions, index.tokenizer, index.with_bigrams))
    # the cell is part of the key, so a question meets only postings of its cell
    asked_terms = weights.join(question_cells, "qid").select("qid", "term", F.col("w").alias("wq"), F.col("qcell").alias("cell"))
    placed = index.weights.join(cells.assigned, "pid")
    shared = (
        sized_join(placed, asked_terms, ["term", "cell"], salt_by="pid", fits=fits)
        .groupBy("pid", "qid")
        .agg(F.sum(F.col("w") * F.col("wq")).alias("cosine"))
        .select("qid", "pid", F.round(2 - 2 * F.col("cosine"), SCORE_DIGITS).alias("score"))
    )
    near = top_k(shared, "qid", [F.col("score"), F.col("pid")], k).drop("rank")
    known = index.weights.select("pid").distinct().withColumn("_known", F.lit(True))
    kinds = cells.assigned.join(known, "pid", "left").select("pid", "cell", F.coalesce("_known", F.lit(False)).alias("known"))
    # of 2k passages at most k are among the near ones
    first = top_k(kinds, ["cell", "known"], [F.col("pid").asc()], 2 * k, "_n").withColumnRenamed("cell", "qcell")
    far = (
        question_cells.join(first, "qcell")
        .join(near.select("qid", "pid"), ["qid", "pid"], "left_anti")
        .join(lost, "qid", "left")
        .select("qid", "pid", (F.when(F.col("known"), 2.0).otherwise(1.0) - F.coalesce("_lost", F.lit(0.0))).alias("score"))
    )
    return top_k(near.unionByName(far), "qid", [F.col("score"), F.col("pid")], k).select("qid", "rank", "pid", "score")
