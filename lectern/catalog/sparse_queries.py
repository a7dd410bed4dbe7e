"""Queries of the sparse retrieval operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.catalog import fixtures as fx
from lectern.catalog.registry import query
from lectern.operators import sparse
from lectern.operators.corpus import gather
from lectern.plans.retrieval import retrieve_for_dataset


@query(
    "p1_postings",
    "SELECT pid, dl, term, tf FROM postings",
    uses="postings",
)
def p1(spark: SparkSession, sf: str) -> DataFrame:
    return sparse.passage_terms(fx.passages(spark, sf))


@query("p2_capped_vocabulary", "SELECT term, CAST(cf AS BIGINT) AS cf, df FROM vocab", uses="vocab")
def p2(spark: SparkSession, sf: str) -> DataFrame:
    return fx.index(spark, sf, "tfidf").vocabulary.select("term", "cf", "df")


@query("p3_tfidf_weights", "SELECT pid, term, round(w, 6) AS w FROM pweights", uses="pweights")
def p3(spark: SparkSession, sf: str) -> DataFrame:
    weights = fx.index(spark, sf, "tfidf").weights
    return weights.select("pid", "term", F.round("w", 6).alias("w"))


@query("p4_tfidf_topk", "SELECT qid, rank, pid, score FROM tfidf_ranked WHERE rank <= 10", uses="tfidf_ranked")
def p4(spark: SparkSession, sf: str) -> DataFrame:
    index = fx.index(spark, sf, "tfidf")
    return sparse.retrieve(index, fx.questions(spark, sf), 10).withColumn("rank", F.col("rank").cast("bigint"))


@query("p7_bm25_fit", "SELECT term, df, round(idf, 6) AS idf FROM bm25_vocab", uses="bm25_vocab")
def p7(spark: SparkSession, sf: str) -> DataFrame:
    return fx.index(spark, sf, "bm25").vocabulary.select("term", "df", F.round("idf", 6).alias("idf"))


@query("p8_bm25_topk", "SELECT qid, rank, pid, score FROM bm25_ranked WHERE rank <= 10", uses="bm25_ranked")
def p8(spark: SparkSession, sf: str) -> DataFrame:
    index = fx.index(spark, sf, "bm25")
    return sparse.retrieve(index, fx.questions(spark, sf), 10).withColumn("rank", F.col("rank").cast("bigint"))


def longest_question(spark: SparkSession, sf: str) -> DataFrame:
    """One question: the longest of all, the smaller id on a tie."""
    best = F.max_by("question", F.struct(F.length("question"), -F.col("qid")))
    return fx.questions(spark, sf).agg(best.alias("question")).select(F.lit(0).cast("bigint").alias("qid"), "question")


_LONGEST = "(SELECT qid FROM questions ORDER BY len(question) DESC, qid LIMIT 1)"
_STRANGE = "SELECT qid + 1000000 AS qid FROM questions"


def with_strange_questions(spark: SparkSession, sf: str) -> DataFrame:
    """Every question, and beside it one made of a hash no passage holds."""
    known = fx.questions(spark, sf)
    strange = known.select((F.col("qid") + 1_000_000).alias("qid"), F.md5("question").alias("question"))
    return known.unionByName(strange)


@query(
    "p5_tfidf_one_question",
    f"SELECT rank, pid, score, text FROM tfidf_ranked JOIN passages USING (pid) WHERE rank <= 10 AND qid = {_LONGEST}",
    uses="tfidf_ranked passages questions",
)
def p5(spark: SparkSession, sf: str) -> DataFrame:
    hits = sparse.retrieve(fx.index(spark, sf, "tfidf"), longest_question(spark, sf), 10)
    found = gather(hits, fx.passages(spark, sf), max_hits=10)
    return found.select(F.col("rank").cast("bigint").alias("rank"), "pid", "score", "text")


@query("p6_unknown_questions", _STRANGE, uses="questions")
def p6(spark: SparkSession, sf: str) -> DataFrame:
    return fx.index(spark, sf, "tfidf").unknown_questions(with_strange_questions(spark, sf)).select("qid")


@query(
    "p9_bm25_one_question",
    f"SELECT rank, pid, score, text FROM bm25_ranked JOIN passages USING (pid) WHERE rank <= 10 AND qid = {_LONGEST}",
    uses="bm25_ranked passages questions",
)
def p9(spark: SparkSession, sf: str) -> DataFrame:
    hits = sparse.retrieve(fx.index(spark, sf, "bm25"), longest_question(spark, sf), 10)
    found = gather(hits, fx.passages(spark, sf), max_hits=10)
    return found.select(F.col("rank").cast("bigint").alias("rank"), "pid", "score", "text")


@query(
    "p10_zero_score_fill",
    f"""SELECT qid, rank, pid, score FROM tfidf_ranked WHERE rank <= 10
        UNION ALL SELECT qid, pid + 1, pid, 0.0 FROM ({_STRANGE}), passages WHERE pid < 10""",
    uses="tfidf_ranked passages questions",
)
def p10(spark: SparkSession, sf: str) -> DataFrame:
    hits = sparse.retrieve(fx.index(spark, sf, "tfidf"), with_strange_questions(spark, sf), 10, fill=True)
    return hits.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "p11_retriever_choice",
    """SELECT 'bm25' AS method, qid, rank, pid, score FROM bm25_ranked WHERE rank <= 5
       UNION ALL SELECT 'tfidf', qid, rank, pid, score FROM tfidf_ranked WHERE rank <= 5""",
    uses="bm25_ranked tfidf_ranked",
)
def p11(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        sparse.retrieve(fx.index(spark, sf, method), fx.questions(spark, sf), 5).select(
            F.lit(method).alias("method"), "qid", F.col("rank").cast("bigint").alias("rank"), "pid", "score"
        )
        for method in sorted(sparse.INDEXES)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "p12_dataset_retrieval",
    """SELECT x.answer AS answers, c.context, x.context AS original_context, CAST(x.id AS VARCHAR) AS id, x.question
       FROM examples x JOIN (SELECT qid, string_agg(text, ' ' ORDER BY rank) AS context
                             FROM tfidf_ranked JOIN passages USING (pid) WHERE rank <= 20 GROUP BY qid) c ON c.qid = x.id""",
    uses="examples tfidf_ranked passages",
)
def p12(spark: SparkSession, sf: str) -> DataFrame:
    return retrieve_for_dataset(
        fx.index(spark, sf, "tfidf"), fx.qa_examples(spark, sf), fx.passages(spark, sf), k=20, predict=False, first_only=True
    )
