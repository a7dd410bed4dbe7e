"""TF-IDF and BM25 retrieval as joins on an inverted index.

Postings stay partitioned by passage from the moment they are built: term
counts, passage norms and scores are all sums within a passage, so none of them
shuffles again, and a term found in most passages is no hot key. A TF-IDF index keeps
and moves a row for each passage and not for each posting (``terms.py``). The questions
travel to the postings instead; retrieval goes through posting blocks (``blocks.py``),
and only k passages per question and shard move to the final ranking."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.functions.text import Tokenizer, unigrams_and_bigrams, whitespace_tokens
from lectern.operators.blocks import posting_blocks, search_blocks
from lectern.operators.corpus import rank_hits
from lectern.operators.sizing import BROADCAST_ROWS, first_rows, fits_broadcast, least_kept, sized_join, spread, top_k
from lectern.operators.terms import (
    TERM_TEXTS, Codes, coded_blocks, coded_weights, counts_of, exploded, known_terms, posting_rows, term_sketch, texts_terms, weights_by_bucket,
)
from lectern.sources.index_store import TableStore

MAX_FEATURES = 50_000
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25
PUSHED_TERMS = 500
BUCKET_BYTES = 16 << 20  # of passage text
SHARD_BYTES = 16 << 20
LEAST_BUCKETS = 8


class IndexTables:
    """Where the parts of an index live: recomputed on use, or kept in a store
    under the corpus key and the parameters of the index. Tables by passage are bucketed
    on pid, so scoring a stored index shuffles nothing but the final top-k. Those with a row for each
    posting are sorted by term."""

    def __init__(self, store: TableStore | None = None, key: dict | None = None, buckets: int | None = None):
        self.store, self.key = store, key or {}
        self.buckets = buckets

    def of_index(self, **parameters) -> IndexTables:
        """The same place for an index with these parameters."""
        return IndexTables(self.store, self.key | parameters, self.buckets)

    def plain(self, name: str, build: Callable[[], DataFrame], sort_by: str | None = None) -> DataFrame:
        return self.store.load_or_build(name, self.key, build, sort_by) if self.store else build()

    def by_passage(
        self, name: str, passages: DataFrame, build: Callable[[int | None], DataFrame], sort_by: str | None = "term", placed: bool = True
    ) -> DataFrame:
        """A table by pid. ``build`` gets the number of buckets to partition by."""
        if not self.store:
            return build(None)
        return self.store.load_or_build_bucketed(
            name, self.key, build, "pid", lambda: self.buckets or buckets_for(passages), sort_by, placed
        )

    def by_shard(self, name: str, passages: DataFrame, build: Callable[[int], DataFrame]) -> DataFrame:
        """Posting blocks. ``build`` gets the number of shards, which are the buckets of a stored table."""
        if not self.store:
            return build(int(passages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        return self.store.load_or_build_bucketed(
            name, self.key, build, "shard", lambda: self.buckets or buckets_for(passages, SHARD_BYTES), "term", placed=True
        )

    def asked_only(self, stored: list[DataFrame], terms: DataFrame) -> list[DataFrame]:
        """Rows of stored tables for a short list of question terms. The filter
        reaches the files, which are sorted by term: one question reads the pages
        of its terms and not the index."""
        if not self.store:
            return stored
        listed = [r["term"] for r in terms.select("term").distinct().limit(PUSHED_TERMS + 1).collect()]
        if len(listed) > PUSHED_TERMS:
            return stored
        return [df.filter(F.col("term").isin(listed)) for df in stored]


# -- index ----------------------------------------------------------------

def buckets_for(passages: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of an index over ``passages``: by the bytes of the texts, not by the session."""
    size = passages.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(LEAST_BUCKETS, -(-size // bucket_bytes))


def tokenizer_key(tokenizer: Tokenizer) -> str:
    """What tells tokenizers apart in the key of a stored index: name and expression."""
    name = f"{getattr(tokenizer, '__module__', '')}.{getattr(tokenizer, '__qualname__', repr(tokenizer))}"
    return f"{name} {tokenizer(F.col('text'))}"


def passage_terms(
    passages: DataFrame, tokenizer: Tokenizer = whitespace_tokens, with_bigrams: bool = False, partitions: int | None = None
) -> DataFrame:
    """(pid, dl, term, tf), dealt by pid. ``dl`` counts single tokens. A passage is one row, so its
    terms are counted where it lies, some passages at a time: no task holds the counts of all its passages."""
    own = passages.select("pid", "text")
    placed = own.repartition(partitions, "pid") if partitions else spread(own, "pid")
    tokens = placed.select("pid", tokenizer(F.col("text")).alias("tokens"))
    schema = f"pid {own.schema['pid'].dataType.simpleString()}, dl long, term string, tf long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, TERM_TEXTS):
                yield _term_counts(batch.slice(i, TERM_TEXTS), with_bigrams)

    return tokens.select("pid", F.size("tokens").cast("long").alias("dl"), "tokens").mapInArrow(count, schema)


def _term_counts(texts: pa.RecordBatch, with_bigrams: bool) -> pa.RecordBatch:
    """(pid, dl, term, tf) of some texts (pid, dl, tokens)."""
    rows, words = texts_terms(texts, with_bigrams)
    counts = pa.table({"row": rows, "term": words}).group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    counts = counts.combine_chunks()
    row, term, tf = (counts[c].combine_chunks() if isinstance(counts[c], pa.ChunkedArray) else counts[c] for c in ("row", "term", "count_all"))
    return pa.RecordBatch.from_arrays([texts["pid"].take(row), texts["dl"].take(row), term, tf], names=["pid", "dl", "term", "tf"])


def corpus_stats(passages: DataFrame, tokenizer: Tokenizer = whitespace_tokens) -> DataFrame:
    """One row (n, avgdl). Counted on the passages, as one without any token has
    no postings but is part of both figures."""
    return passages.select(F.size(tokenizer(F.col("text"))).alias("dl")).agg(
        F.count("*").alias("n"), F.avg("dl").alias("avgdl")
    )


def question_terms(
    questions: DataFrame, tokenizer: Tokenizer = whitespace_tokens, with_bigrams: bool = False
) -> DataFrame:
    """(qid, term, qtf)"""
    tokens = questions.select("qid", tokenizer(F.col("question")).alias("tokens"))
    terms = unigrams_and_bigrams(F.col("tokens")) if with_bigrams else F.col("tokens")
    return (
        tokens.select("qid", F.explode_outer(terms).alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("qid", "term")
        .agg(F.count("*").alias("qtf"))
    )


# -- TF-IDF ---------------------------------------------------------------

def term_counts(postings: DataFrame) -> DataFrame:
    """(term, cf, df) of every term."""
    return postings.groupBy("term").agg(F.sum("tf").alias("cf"), F.count("*").alias("df"))


def capped_vocabulary(counts: DataFrame, n_passages: Column, max_features: int = MAX_FEATURES) -> DataFrame:
    """(term, cf, df, idf) of the most frequent terms out of (term, cf, df); ties go to the smaller
    term. Never more than ``max_features`` rows."""
    kept = first_rows(counts, -F.col("cf"), [F.col("term").asc()], max_features)
    return kept.withColumn("idf", F.log((n_passages + 1) / (F.col("df") + 1)) + 1.0)


def unit_weights(terms: DataFrame, vocabulary: DataFrame, by: str, tf: str, fits: bool = True) -> DataFrame:
    """(by, term, w): tf-idf weights with every row of unit length. ``fits``: the
    cap of the vocabulary is small enough to send it to every executor."""
    known = sized_join(terms, vocabulary.select("term", "idf"), ["term"], salt_by=by, fits=fits)
    raw = known.withColumn("_w", F.col(tf) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(by)))
    return raw.select(by, "term", (F.col("_w") / norm).alias("w"))


def tfidf_scores(passage_weights: DataFrame, question_weights: DataFrame, fits: bool) -> DataFrame:
    """(qid, pid, score) of every pair that shares a term. ``fits``: the question
    side was measured to fit on every executor."""
    asked = question_weights.select("qid", "term", F.col("w").alias("wq"))
    shared = sized_join(passage_weights, asked, ["term"], salt_by="pid", fits=fits)
    return shared.groupBy("pid", "qid").agg(F.sum(F.col("w") * F.col("wq")).alias("score"))


class TfidfIndex:
    """Vocabulary, unit weights and posting blocks of one corpus. Each is built when it is first asked for."""

    name = "tfidf"

    def __init__(
        self,
        passages: DataFrame,
        tokenizer: Tokenizer = whitespace_tokens,
        max_features: int = MAX_FEATURES,
        with_bigrams: bool = True,
        tables: IndexTables | None = None,
    ):
        self.passages = passages
        self.tokenizer = tokenizer
        self.with_bigrams = with_bigrams
        self.max_features = max_features
        # postings and counts of all terms do not depend on the cap
        self.uncapped = (tables or IndexTables()).of_index(tokenizer=tokenizer_key(tokenizer), with_bigrams=with_bigrams)
        self.tables = self.uncapped.of_index(max_features=max_features)
        self.small = max_features <= BROADCAST_ROWS
        n = passages.agg(F.count("*")).scalar()
        self.vocabulary = self.tables.plain("tfidf_vocabulary", lambda: capped_vocabulary(self._counts(), n, max_features))

    def _counts(self) -> DataFrame:
        """(term, cf, df) of all terms that the cap can keep, and of some others. The cap goes over them
        twice, so they are kept."""
        if not self.small:
            return self.uncapped.plain("tfidf_counts", lambda: term_counts(self.postings))
        sketch = term_sketch(self.passages, self.tokenizer, self.with_bigrams)
        floor = sketch.floor(2 * self.max_features)
        while True:
            heavy = sketch.heavy(floor)
            counts = self.tables.plain(f"tfidf_counts_{floor}", lambda: counts_of(self.passages, self.tokenizer, self.with_bigrams, heavy))
            # a term of a slot under the floor occurs less often than the last that is kept, or the floor was too high
            cut = least_kept(counts, F.col("cf"), self.max_features)
            if cut >= floor:
                return counts
            floor = cut

    @cached_property
    def posting_rows(self) -> DataFrame:
        """(pid, dl, terms, tfs): a row for each passage."""

        def build(buckets: int | None) -> DataFrame:
            placed = self.passages.repartition(buckets, "pid") if buckets else self.passages
            return posting_rows(placed, self.tokenizer, self.with_bigrams)

        return self.uncapped.by_passage("tfidf_posting_rows", self.passages, build, sort_by="pid")

    @property
    def postings(self) -> DataFrame:
        """(pid, dl, term, tf)"""
        return exploded(self.posting_rows, terms="term", tfs="tf")

    @cached_property
    def _codes(self) -> Codes:
        return Codes(self.vocabulary)

    def _coded(self) -> DataFrame:
        return self._codes.counts(self.passages, self.tokenizer, self.with_bigrams)

    @cached_property
    def weight_rows(self) -> DataFrame:
        """(pid, terms, ws): a row for each passage with a known term."""

        def build(buckets: int | None) -> DataFrame:
            if self.small:
                return coded_weights(self._coded().repartition(buckets, "pid") if buckets else self._coded(), self._codes)
            parts = buckets or int(self.passages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            return weights_by_bucket(self.posting_rows, self.vocabulary, parts)

        return self.tables.by_passage("tfidf_weight_rows", self.passages, build, sort_by="pid")

    @property
    def weights(self) -> DataFrame:
        """(pid, term, w): every passage of unit length."""
        return exploded(self.weight_rows, terms="term", ws="w")

    def known_postings(self) -> DataFrame:
        """(pid, dl, term, tf) of the terms that have a weight. Both tables are bucketed on pid and stay where they are."""
        known = self.weight_rows.select("pid", F.col("terms").alias("known"))
        met = self.posting_rows.join(known, "pid").select("pid", "dl", F.explode(known_terms("terms", "tfs", "known")).alias("_k"))
        return met.select("pid", "dl", F.col("_k")["term"].alias("term"), F.col("_k")["tf"].alias("tf"))

    def question_weights(self, questions: DataFrame) -> DataFrame:
        terms = question_terms(questions, self.tokenizer, self.with_bigrams)
        return unit_weights(terms, self.vocabulary, "qid", "qtf", self.small)

    def scores(self, questions: DataFrame) -> DataFrame:
        """(qid, pid, score) of every pair that shares a term."""
        terms = question_terms(questions, self.tokenizer, self.with_bigrams)
        (weights,) = self.tables.asked_only([self.weights], terms)
        return tfidf_scores(weights, self.question_weights(questions), fits_broadcast(terms))

    def blocks(self) -> DataFrame:
        """Posting blocks of the unit weights."""

        def build(shards: int) -> DataFrame:
            if self.small:
                return coded_blocks(self._coded(), self._codes, shards)
            return posting_blocks(self.weights.withColumnRenamed("w", "impact"), shards)

        return self.tables.by_shard("tfidf_blocks", self.passages, build)

    def search(self, questions: DataFrame, k: int) -> DataFrame:
        """(qid, pid, score): the k best of every shard, of passages that share a term."""
        terms = question_terms(questions, self.tokenizer, self.with_bigrams)
        (blocks,) = self.tables.asked_only([self.blocks()], terms)
        return search_blocks(blocks, self.question_weights(questions).withColumnRenamed("w", "wq"), k, fits_broadcast(terms))

    def unknown_questions(self, questions: DataFrame) -> DataFrame:
        """Questions without a single vocabulary term."""
        terms = question_terms(questions, self.tokenizer, self.with_bigrams)
        vocabulary = self.vocabulary.select("term")
        known = terms.join(F.broadcast(vocabulary) if self.small else vocabulary, "term", "left_semi").select("qid")
        return questions.join(known, "qid", "left_anti")


# -- BM25 -----------------------------------------------------------------

def bm25_vocabulary(postings: DataFrame, n_passages: Column) -> DataFrame:
    """(term, df, idf): Okapi idf. A term in more than half of the passages would
    weigh negative; it gets a share of the mean idf instead."""
    raw = (
        postings.groupBy("term")
        .agg(F.count("*").alias("df"))
        .withColumn("_idf", F.log(n_passages - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    )
    floor = raw.agg(F.avg("_idf") * BM25_EPSILON).scalar()
    return raw.select("term", "df", F.when(F.col("_idf") < 0, floor).otherwise(F.col("_idf")).alias("idf"))


def bm25_scores(
    postings: DataFrame,
    weighted_terms: DataFrame,
    avgdl: Column,
    fits: bool,
    k1: float = BM25_K1,
    b: float = BM25_B,
) -> DataFrame:
    """(qid, pid, score) of every pair that shares a term. ``weighted_terms`` is
    (qid, term, wq) with wq = repeats in the question times idf."""
    shared = sized_join(postings, weighted_terms, ["term"], salt_by="pid", fits=fits)
    return shared.groupBy("pid", "qid").agg(F.sum(F.col("wq") * bm25_saturation(avgdl, k1, b)).alias("score"))


def bm25_saturation(avgdl: Column, k1: float = BM25_K1, b: float = BM25_B) -> Column:
    """What a term adds to a passage, before its weight in the question."""
    return F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / avgdl))


class Bm25Index:
    """Postings, document frequencies and corpus figures of one corpus."""

    name = "bm25"

    def __init__(
        self,
        passages: DataFrame,
        tokenizer: Tokenizer = whitespace_tokens,
        k1: float = BM25_K1,
        b: float = BM25_B,
        tables: IndexTables | None = None,
    ):
        self.passages = passages
        self.tokenizer = tokenizer
        self.k1, self.b = k1, b
        self.tables = keep = (tables or IndexTables()).of_index(tokenizer=tokenizer_key(tokenizer))
        self.postings = keep.by_passage(
            "bm25_postings", passages, lambda n: passage_terms(passages, tokenizer, partitions=n)
        )
        self.stats = keep.plain("bm25_stats", lambda: corpus_stats(passages, tokenizer))
        n = self.stats.select("n").scalar()
        self.vocabulary = keep.plain("bm25_vocabulary", lambda: bm25_vocabulary(self.postings, n), sort_by="term")

    def _weighted(self, terms: DataFrame, fits: bool) -> DataFrame:
        (vocabulary,) = self.tables.asked_only([self.vocabulary], terms)
        found = sized_join(vocabulary.select("term", "idf"), terms, ["term"], salt_by="term", fits=fits)
        return found.select("qid", "term", (F.col("qtf") * F.col("idf")).alias("wq"))

    def scores(self, questions: DataFrame) -> DataFrame:
        """(qid, pid, score) of every pair that shares a term."""
        terms = question_terms(questions, self.tokenizer)
        fits = fits_broadcast(terms)
        (postings,) = self.tables.asked_only([self.postings], terms)
        avgdl = self.stats.select("avgdl").scalar()
        return bm25_scores(postings, self._weighted(terms, fits), avgdl, fits, self.k1, self.b)

    def blocks(self) -> DataFrame:
        """Posting blocks of the saturated counts."""
        impact = bm25_saturation(self.stats.select("avgdl").scalar(), self.k1, self.b).alias("impact")
        tables = self.tables.of_index(k1=self.k1, b=self.b)
        return tables.by_shard("bm25_blocks", self.passages, lambda n: posting_blocks(self.postings.select("pid", "term", impact), n))

    def search(self, questions: DataFrame, k: int) -> DataFrame:
        """(qid, pid, score): the k best of every shard, of passages that share a term."""
        terms = question_terms(questions, self.tokenizer)
        fits = fits_broadcast(terms)
        (blocks,) = self.tables.asked_only([self.blocks()], terms)
        return search_blocks(blocks, self._weighted(terms, fits), k, fits)


INDEXES = {TfidfIndex.name: TfidfIndex, Bm25Index.name: Bm25Index}


def build_index(method: str, passages: DataFrame, **options) -> TfidfIndex | Bm25Index:
    if method not in INDEXES:
        raise ValueError(f"retrieval method must be one of {sorted(INDEXES)}, not {method!r}")
    return INDEXES[method](passages, **options)


# -- retrieval ------------------------------------------------------------

def retrieve(index: TfidfIndex | Bm25Index, questions: DataFrame, k: int, fill: bool = False) -> DataFrame:
    """(qid, rank, pid, score): the k best passages of every question.

    A passage that shares no term scores 0 and is left out, unless ``fill`` asks
    for k rows whenever the corpus has them. Tasks send k passages a question to the last ranking."""
    hits = rank_hits(index.search(questions, k), k)
    return fill_with_zeros(hits, questions, index.passages, k) if fill else hits.select("qid", "rank", "pid", "score")


def fill_with_zeros(hits: DataFrame, questions: DataFrame, passages: DataFrame, k: int) -> DataFrame:
    """Complete short hit lists with the first passages not hit, scored 0.

    A short list has fewer than k hits, so the first 2k passages hold all the
    fill it can need: no question is paired with the corpus."""
    n = passages.agg(F.count("*")).scalar()
    first = (
        questions.select("qid")
        .withColumn("_last", F.least(n, F.lit(2 * k)) - 1)
        .filter(F.col("_last") >= 0)
        .select("qid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))).alias("pid"))
    )
    pool = hits.select(
        "qid", "pid", F.lit(0).alias("fill"), F.col("rank").cast("long").alias("place"), "score"
    ).unionByName(first.select("qid", "pid", F.lit(1).alias("fill"), F.col("pid").alias("place"), F.lit(0.0).alias("score")))
    # a passage that is hit and among the first keeps its hit
    distinct = pool.groupBy("qid", "pid").agg(F.min(F.struct("fill", "place", "score")).alias("r")).select("qid", "pid", "r.*")
    return top_k(distinct, "qid", [F.col("fill"), F.col("place")], k).select("qid", "rank", "pid", "score")
