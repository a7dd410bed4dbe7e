"""Queries of the sources, sinks and relational operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.catalog import fixtures as fx
from lectern.catalog.registry import query
from lectern.functions import text as tx
from lectern.operators import corpus, metrics
from lectern.operators.sizing import top_k
from lectern.operators.sparse import IndexTables, TfidfIndex, retrieve
from lectern.plans.retrieval import contexts_for, with_texts
from lectern.sources import readers, sinks
from lectern.sources.json_entries import write_json_value
from lectern.sources.index_store import TableStore, corpus_fingerprint

K = 10
_TOP_K = """(SELECT qid, string_agg(text, ' ' ORDER BY rank) AS context
             FROM bm25_ranked JOIN passages USING (pid) WHERE rank <= 10 GROUP BY qid)"""


# -- sources and sinks ----------------------------------------------------

@query("s1_corpus_scan", "SELECT doc_id, text FROM documents")
def s1(spark: SparkSession, sf: str) -> DataFrame:
    return readers.read_corpus(spark, f"{sf}/documents.parquet")


@query("s2_split_scan", "SELECT doc_id, text FROM documents WHERE lang = 'en'")
def s2(spark: SparkSession, sf: str) -> DataFrame:
    """The documents as a dataset with one split per language, read back by split."""
    path = fx.fresh_path(spark, "splits")
    docs = fx.table(spark, sf, "documents").select("doc_id", "text", F.col("lang").alias("split"))
    sinks.write_dataset(docs, path, split="split")
    return readers.read_split(spark, path, "en").select("doc_id", "text")


@query("s3_nested_flatten", "SELECT conv_id * 100 + turn AS id, role || ': ' || text AS answer FROM conversations")
def s3(spark: SparkSession, sf: str) -> DataFrame:
    """One article per conversation, one paragraph per role, one question per turn."""
    turns = fx.table(spark, sf, "conversations")
    qa = F.struct((F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.concat("role", F.lit(": "), "text").alias("answers"))
    paragraphs = turns.groupBy("conv_id", "role").agg(F.collect_list(qa).alias("qas"))
    articles = paragraphs.groupBy("conv_id").agg(F.collect_list(F.struct("qas")).alias("paragraphs"))
    return readers.flatten_articles(articles).select("id", F.col("answers").alias("answer"))


@query("s1_corpus_object", "SELECT doc_id, text FROM documents")
def s1_object(spark: SparkSession, sf: str) -> DataFrame:
    """The documents as one JSON object, written and read by many tasks."""
    path = fx.fresh_path(spark, "corpus-object")
    docs = fx.table(spark, sf, "documents")
    pair = F.create_map(F.col("doc_id").cast("string"), F.struct("text", "lang"))
    line = F.regexp_replace(F.to_json(pair), r"^\{|\}$", "")
    write_json_value(docs.select(F.col("doc_id").alias("at"), line.alias("line")), path, "{", "}")
    return readers.read_corpus_object(spark, path, parts=True)


@query(
    "s3_nested_file",
    "SELECT CAST(conv_id AS VARCHAR) AS title, role AS context, CAST(conv_id * 100 + turn AS VARCHAR) AS id, text AS question FROM conversations",
)
def s3_file(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as the articles of one ``{version, data[]}`` file, a paragraph per role and a question per turn."""
    path = fx.fresh_path(spark, "articles")
    turns = fx.table(spark, sf, "conversations")
    qa = F.struct((F.col("conv_id") * 100 + F.col("turn")).cast("string").alias("id"), F.col("text").alias("question"))
    paragraphs = turns.groupBy("conv_id", F.col("role").alias("context")).agg(F.collect_list(qa).alias("qas"))
    articles = paragraphs.groupBy("conv_id").agg(F.collect_list(F.struct("context", "qas")).alias("paragraphs"))
    sinks.write_articles(articles.withColumn("title", F.col("conv_id").cast("string")), path, "conv_id")
    return readers.read_questions(spark, path, parts=True).select("title", "context", "id", "question")


@query(
    "s5_predictions_object",
    "SELECT CAST(id AS VARCHAR) AS id, prediction AS prediction_text FROM pairs",
    uses="pairs",
)
def s5_object(spark: SparkSession, sf: str) -> DataFrame:
    """All answers, missing ones too, as one object of many parts."""
    path = fx.fresh_path(spark, "predictions-object")
    sinks.write_predictions_object(fx.qa_pairs(spark, sf).select("id", "prediction_text"), path)
    return readers.read_predictions_object(spark, path, parts=True)


ALL_TERMS = 1 << 30


@query(
    "s4_index_store",
    """SELECT 'all' AS vocabulary, pid, dl, count(*) AS terms, CAST(sum(tf) AS BIGINT) AS tokens FROM postings GROUP BY pid, dl
       UNION ALL
       SELECT 'first', pid, dl, count(*), CAST(sum(tf) AS BIGINT) FROM postings WHERE term IN (
         SELECT term FROM postings GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 100) GROUP BY pid, dl""",
    uses="postings",
)
def s4(spark: SparkSession, sf: str) -> DataFrame:
    """Two indexes with different parameters built on one store, then loaded: each has its own
    tables. Grouping a loaded table by passage shuffles nothing, as it is bucketed on it."""
    passages = fx.passages(spark, sf)
    tables = IndexTables(TableStore(spark), {"corpus": corpus_fingerprint(passages, ["pid", "text"]), "input": sf})

    def load(max_features: int) -> DataFrame:
        return TfidfIndex(passages, max_features=max_features, with_bigrams=False, tables=tables).known_postings()

    def counted(name: str, postings: DataFrame) -> DataFrame:
        by_passage = postings.groupBy("pid", "dl").agg(F.count("*").alias("terms"), F.sum("tf").alias("tokens"))
        return by_passage.select(F.lit(name).alias("vocabulary"), "pid", "dl", "terms", "tokens")

    for size in (ALL_TERMS, 100):
        load(size)
    return counted("all", load(ALL_TERMS)).unionByName(counted("first", load(100)))


@query(
    "s5_predictions_sink",
    """SELECT CAST(id AS VARCHAR) AS id, prediction AS prediction_text FROM pairs WHERE prediction IS NOT NULL""",
    uses="pairs",
)
def s5(spark: SparkSession, sf: str) -> DataFrame:
    path = fx.fresh_path(spark, "predictions")
    given = fx.qa_pairs(spark, sf).filter(F.col("prediction_text").isNotNull())
    sinks.write_predictions(given.withColumn("id", F.col("id").cast("string")), path)
    return sinks.read_predictions(spark, path)


@query(
    "s7_metrics_sink",
    """SELECT round(100 * avg(em), 6) AS exact_match, round(100 * avg(f1), 6) AS f1, count(*) AS total,
              (SELECT count(*) FROM pairs) AS eval_samples
       FROM scored WHERE gold_no = 0""",
    uses="scored pairs",
)
def s7(spark: SparkSession, sf: str) -> DataFrame:
    pairs = fx.qa_pairs(spark, sf)
    predictions = pairs.filter(F.col("prediction_text").isNotNull())
    result = sinks.with_sample_count(metrics.evaluate(pairs.select("id", "golds"), predictions), pairs)
    path = fx.fresh_path(spark, "metrics")
    sinks.write_metrics(result, path)
    return spark.read.schema("exact_match double, f1 double, total bigint, eval_samples bigint").json(path)


@query("s8_passage_store", "SELECT pid, text FROM passages", uses="passages")
def s8(spark: SparkSession, sf: str) -> DataFrame:
    return fx.passages(spark, sf).select("pid", "text")


@query(
    "s9_dataset_sink",
    r"SELECT doc_id, source, regexp_replace(text, '\\n|\*|\n|\|#', '', 'g') AS text FROM documents",
)
def s9(spark: SparkSession, sf: str) -> DataFrame:
    path = fx.fresh_path(spark, "cleaned")
    docs = fx.table(spark, sf, "documents").select("doc_id", "source", tx.rewrite_special(F.col("text")).alias("text"))
    sinks.write_dataset(docs, path)
    return spark.read.parquet(path)


# -- relational operators -------------------------------------------------

@query("r1_ordered_dedup", "SELECT pid, text FROM passages", uses="passages")
def r1(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.dedup_in_order(fx.table(spark, sf, "documents"))


@query("r2_distinct_texts", "SELECT DISTINCT text FROM documents")
def r2(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.distinct_texts(fx.table(spark, sf, "documents"))


@query(
    "r3_union_splits",
    """SELECT 'train' AS split, item_id AS id, text FROM benchmark
       UNION ALL SELECT 'validation', conv_id * 100 + turn, text FROM conversations""",
)
def r3(spark: SparkSession, sf: str) -> DataFrame:
    train = fx.table(spark, sf, "benchmark").select(F.lit("train").alias("split"), F.col("item_id").alias("id"), "text")
    validation = fx.table(spark, sf, "conversations").select(
        F.lit("validation").alias("split"), (F.col("conv_id") * 100 + F.col("turn")).alias("id"), "text"
    )
    return corpus.union_splits(train, validation)


@query("r4_select_ids", "SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def r4(spark: SparkSession, sf: str) -> DataFrame:
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    return corpus.select_ids(docs, fx.table(spark, sf, "labels"), "doc_id")


def retrieval_results(spark: SparkSession, sf: str, first_only: bool = False) -> DataFrame:
    """(id, question, context, original_context, answers) for every question."""
    questions = fx.questions(spark, sf)
    hits = retrieve(fx.index(spark, sf, "bm25"), questions, K)
    asked = questions.withColumnRenamed("qid", "id")
    contexts = contexts_for(hits, asked, fx.passages(spark, sf), K)
    return corpus.carry_gold(contexts, fx.qa_examples(spark, sf), first_only)


@query(
    "r5_predict_schema",
    f"SELECT c.context, CAST(q.qid AS VARCHAR) AS id, q.question FROM questions q JOIN {_TOP_K} c USING (qid)",
    uses="questions bm25_ranked passages",
)
def r5(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.to_predict_schema(retrieval_results(spark, sf))


@query(
    "r5_eval_schema",
    f"""SELECT x.answer AS answers, c.context, x.context AS original_context, CAST(q.qid AS VARCHAR) AS id, q.question
        FROM questions q JOIN {_TOP_K} c USING (qid) LEFT JOIN examples x ON x.id = q.qid""",
    uses="questions bm25_ranked passages examples",
)
def r5_eval(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.to_eval_schema(retrieval_results(spark, sf, first_only=True))


@query(
    "r6_gold_carry",
    """SELECT q.qid AS id, x.context AS original_context, x.answer, x.answer_start
       FROM questions q LEFT JOIN examples x ON x.id = q.qid""",
    uses="questions examples",
)
def r6(spark: SparkSession, sf: str) -> DataFrame:
    asked = fx.questions(spark, sf).withColumnRenamed("qid", "id")
    carried = corpus.carry_gold(asked, fx.qa_examples(spark, sf))
    return carried.select(
        "id", "original_context", corpus.first_answer(F.col("answers")).alias("answer"),
        F.get("answers.answer_start", 0).cast("bigint").alias("answer_start"),
    )


@query(
    "r7_gather",
    "SELECT qid, rank, pid, text FROM bm25_ranked JOIN passages USING (pid) WHERE rank <= 10",
    uses="bm25_ranked passages",
)
def r7(spark: SparkSession, sf: str) -> DataFrame:
    questions = fx.questions(spark, sf)
    hits = retrieve(fx.index(spark, sf, "bm25"), questions, K)
    return with_texts(hits, questions, fx.passages(spark, sf), K).select("qid", F.col("rank").cast("bigint").alias("rank"), "pid", "text")


@query("r8_passage_concat", f"SELECT qid, context FROM {_TOP_K}", uses="bm25_ranked passages")
def r8(spark: SparkSession, sf: str) -> DataFrame:
    questions = fx.questions(spark, sf)
    hits = retrieve(fx.index(spark, sf, "bm25"), questions, K)
    return corpus.concat_passages(with_texts(hits, questions, fx.passages(spark, sf), K))


@query(
    "r9_topk_per_key",
    """SELECT source, rank, doc_id, n_chars FROM (
         SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank
         FROM documents) WHERE rank <= 10""",
)
def r9(spark: SparkSession, sf: str) -> DataFrame:
    docs = fx.table(spark, sf, "documents").select("source", "doc_id", "n_chars")
    best = top_k(docs, "source", [F.col("n_chars").desc(), F.col("doc_id").asc()], K)
    return best.withColumn("rank", F.col("rank").cast("bigint"))


@query("r13_first_answer", "SELECT id, gold1 AS answer FROM pairs", uses="pairs")
def r13(spark: SparkSession, sf: str) -> DataFrame:
    answers = F.struct(F.col("golds").alias("text")).alias("answers")
    return fx.qa_pairs(spark, sf).select("id", answers).select("id", corpus.first_answer(F.col("answers")).alias("answer"))


@query(
    "r14_ranked_split",
    """SELECT qid, rank, pid, text, round(score / (SELECT max(score) FROM bm25_ranked WHERE rank <= 10), 6) AS score
       FROM bm25_ranked JOIN passages USING (pid) WHERE rank <= 10""",
    uses="bm25_ranked passages",
)
def r14(spark: SparkSession, sf: str) -> DataFrame:
    questions = fx.questions(spark, sf)
    hits = retrieve(fx.index(spark, sf, "bm25"), questions, K)
    scaled = corpus.scaled_by_global_max(hits)
    return with_texts(scaled, questions, fx.passages(spark, sf), K).select(
        "qid", F.col("rank").cast("bigint").alias("rank"), "pid", "text", "score"
    )


_SUMMARY = """count(*) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std, min(n) AS min,
              quantile_cont(n, 0.25) AS p25, quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.75) AS p75, max(n) AS max"""


@query(
    "r15_length_summary",
    f"""SELECT 'chars' AS unit, {_SUMMARY} FROM (SELECT CAST(len(text) AS DOUBLE) AS n FROM passages)
        UNION ALL SELECT 'tokens', {_SUMMARY} FROM (SELECT CAST(len(toks) AS DOUBLE) AS n FROM ptoks)""",
    uses="passages ptoks",
)
def r15(spark: SparkSession, sf: str) -> DataFrame:
    passages = fx.passages(spark, sf)
    chars = corpus.length_summary(passages, F.length("text")).withColumn("unit", F.lit("chars"))
    tokens = corpus.length_summary(passages, F.size(tx.whitespace_tokens(F.col("text")))).withColumn("unit", F.lit("tokens"))
    both = chars.unionByName(tokens)
    return both.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))
