"""Queries of the vector, sampling and mixture operators."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern.catalog import fixtures as fx
from lectern.catalog.registry import query
from lectern.functions.vectors import l2_normalize
from lectern.operators import clustered_text, dense, mixture, sampling
from lectern.operators.sizing import count_up_to
from lectern.operators.sparse import retrieve

BITS = 4


def _rank() -> Column:
    return F.col("rank").cast("bigint").alias("rank")


def _passages(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").alias("pid"), "vec")


def _queries(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").alias("qid"), "vec")


def _scaled(vectors: DataFrame) -> DataFrame:
    """Vectors of unequal length: each times one plus its label."""
    return vectors.withColumn("vec", F.transform("vec", lambda x: x.cast("double") * (F.col("label") + 1)))


@query(
    "d1_batch_embedding",
    """SELECT pid, d, CAST(len(text) - len(replace(text, chr(CAST(97 + d AS INTEGER)), '')) AS DOUBLE) AS x
       FROM passages, range(26) r(d)""",
    uses="passages",
)
def d1(spark: SparkSession, sf: str) -> DataFrame:
    """The model is a stand-in that counts the letters of a text."""

    def make_encoder() -> Callable[[np.ndarray], np.ndarray]:
        def encode(texts: np.ndarray) -> np.ndarray:
            counts = [[str(text).count(chr(97 + d)) for d in range(26)] for text in texts]
            return np.asarray(counts, dtype=np.float32)

        return encode

    rows = dense.embed(fx.passages(spark, sf), make_encoder).select("pid", F.posexplode("vec").alias("d", "x"))
    return rows.select("pid", F.col("d").cast("bigint").alias("d"), F.col("x").cast("double").alias("x"))


@query(
    "d2_l2_normalise",
    """SELECT vec_id, d, round(x / n, 6) AS x FROM (
         SELECT vec_id, d, x * (label + 1) AS x, sqrt(sum(x * (label + 1) * x * (label + 1)) OVER (PARTITION BY vec_id)) AS n
         FROM dims)""",
    uses="dims",
)
def d2(spark: SparkSession, sf: str) -> DataFrame:
    unit = _scaled(fx.vectors(spark, sf)).select("vec_id", F.posexplode(l2_normalize(F.col("vec"))).alias("d", "x"))
    return unit.select("vec_id", F.col("d").cast("bigint").alias("d"), F.round("x", 6).alias("x"))


@query("d3_inner_product_topk", "SELECT qid, rank, pid, score FROM ip_ranked WHERE rank <= 10", uses="ip_ranked")
def d3(spark: SparkSession, sf: str) -> DataFrame:
    vectors = fx.vectors(spark, sf)
    return dense.vector_topk(_queries(vectors), _passages(vectors), 10).select("qid", _rank(), "pid", "score")


@query(
    "d4_inner_product_one_vector",
    """SELECT rank, pid, score FROM (
         SELECT vec_id AS pid, score, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM (
           SELECT vec_id, round(sum(x * m), 6) AS score
           FROM dims JOIN (SELECT d, round(avg(x), 6) AS m FROM dims GROUP BY d) USING (d) GROUP BY vec_id))
       WHERE rank <= 10""",
    uses="dims",
)
def d4(spark: SparkSession, sf: str) -> DataFrame:
    """One question vector: the mean of all vectors."""
    vectors = fx.vectors(spark, sf)
    mean = dense.label_centroids(vectors.withColumn("label", F.lit(0).cast("bigint")))
    return dense.vector_topk(mean.select(F.col("cell").alias("qid"), "vec"), _passages(vectors), 10).select(_rank(), "pid", "score")


@query(
    "d5_cosine_topk",
    """SELECT qid, rank, pid, score FROM (
         SELECT qid, pid, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, pid) AS rank FROM (
           SELECT a.vec_id AS qid, b.vec_id AS pid,
                  round((a.label + 1) * list_inner_product(a.v, b.v) / sqrt(list_inner_product(b.v, b.v)), 6) AS score
           FROM vecs a, vecs b)) WHERE rank <= 10""",
    uses="vecs",
)
def d5(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _scaled(fx.vectors(spark, sf))
    return dense.cosine_topk(_queries(vectors), _passages(vectors), 10).select("qid", _rank(), "pid", "score")


@query(
    "d6_given_centres",
    """SELECT vec_id AS pid, cell, d2 FROM (
         SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cell) AS n FROM (
           SELECT vec_id, cell, round(list_sum([(v[i] - c[i]) * (v[i] - c[i]) for i in range(1, len(v) + 1)]), 6) AS d2
           FROM vecs, (SELECT cell, list(round(m, 6) ORDER BY d) AS c FROM (
             SELECT cell, d, avg(x) AS m FROM cells JOIN dims USING (vec_id) GROUP BY cell, d) GROUP BY cell))) WHERE n = 1""",
    uses="cells dims vecs",
)
def d6_given(spark: SparkSession, sf: str) -> DataFrame:
    """Cells after a round of k-means from given centres."""
    vectors = fx.vectors(spark, sf)
    moved = dense.moved_centroids(_passages(vectors), dense.label_centroids(vectors), rounds=1)
    return dense.nearest_cells(_passages(vectors), moved, "pid").select("pid", "cell", "d2")


KMEANS_CELLS, KMEANS_ROUNDS = 16, 3


def _kmeans_sql() -> str:
    """Rounds of k-means, one after the other."""
    steps = [
        f"""c0 AS (SELECT row_number() OVER (ORDER BY md5(vec_id || ':2024'), vec_id) - 1 AS cell, v AS c FROM vecs
                   ORDER BY md5(vec_id || ':2024'), vec_id LIMIT {KMEANS_CELLS})"""
    ]
    for n in range(KMEANS_ROUNDS + 1):
        steps.append(f"""a{n} AS (SELECT vec_id, cell, d2 FROM (
            SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cell) AS n FROM (
              SELECT vec_id, cell, round(list_sum([(v[i] - c[i]) * (v[i] - c[i]) for i in range(1, len(v) + 1)]), 6) AS d2
              FROM vecs, c{n})) WHERE n = 1)""")
        steps.append(f"""c{n + 1} AS (SELECT cell, list(round(m, 6) ORDER BY d) AS c FROM (
            SELECT cell, d, avg(x) AS m FROM a{n} JOIN dims USING (vec_id) GROUP BY cell, d) GROUP BY cell)""")
    return f"SELECT * FROM (WITH {', '.join(steps)} SELECT vec_id AS pid, cell, d2 FROM a{KMEANS_ROUNDS})"


@query("d6_kmeans_cells", _kmeans_sql(), uses="vecs dims")
def d6(spark: SparkSession, sf: str) -> DataFrame:
    passages = _passages(fx.vectors(spark, sf))
    centres = dense.seeded_kmeans(passages, cells=KMEANS_CELLS, rounds=KMEANS_ROUNDS)
    return dense.nearest_cells(passages, centres, "pid").select("pid", "cell", "d2")


@query("d7_cell_assignment", "SELECT vec_id AS pid, cell, d2 FROM cells", uses="cells")
def d7(spark: SparkSession, sf: str) -> DataFrame:
    vectors = fx.vectors(spark, sf)
    return dense.nearest_cells(_passages(vectors), dense.label_centroids(vectors), "pid").select("pid", "cell", "d2")


_IN_CELLS = """SELECT qid, rank, pid, score FROM (
         SELECT qid, pid, score, row_number() OVER (PARTITION BY qid ORDER BY score, pid) AS rank FROM (
           SELECT a.vec_id AS qid, b.vec_id AS pid,
                  round(list_sum([(x.v[i] - y.v[i]) * (x.v[i] - y.v[i]) for i in range(1, len(x.v) + 1)]), 6) AS score
           FROM cells a JOIN cells b USING (cell) JOIN vecs x ON x.vec_id = a.vec_id JOIN vecs y ON y.vec_id = b.vec_id))
       WHERE rank <= 10"""


@query("d8_stored_cells", _IN_CELLS, uses="cells vecs")
def d8_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The same from vectors stored by cell, which is built once and then loaded."""
    vectors = fx.vectors(spark, sf)
    centroids = dense.label_centroids(vectors)
    stored = fx.vectors_by_cell(spark, sf, lambda: dense.nearest_cells(_passages(vectors), centroids, "pid"))
    return dense.clustered_topk(_queries(vectors), stored, centroids, 10).select("qid", _rank(), "pid", "score")


@query("d8_clustered_topk", _IN_CELLS, uses="cells vecs")
def d8(spark: SparkSession, sf: str) -> DataFrame:
    vectors = fx.vectors(spark, sf)
    centroids = dense.label_centroids(vectors)
    assigned = dense.nearest_cells(_passages(vectors), centroids, "pid")
    return dense.clustered_topk(_queries(vectors), assigned, centroids, 10).select("qid", _rank(), "pid", "score")


@query(
    "d9_scalar_quantisation",
    """SELECT vec_id, d, code, round(lo + (code + 0.5) * (hi - lo) / 16, 6) AS decoded FROM (
         SELECT vec_id, d, lo, hi, least(CAST(floor((x - lo) / (hi - lo) * 16) AS BIGINT), 15) AS code
         FROM dims JOIN (SELECT d, min(x) AS lo, max(x) AS hi FROM dims GROUP BY d) USING (d))""",
    uses="dims",
)
def d9(spark: SparkSession, sf: str) -> DataFrame:
    vectors = fx.vectors(spark, sf)
    ranges = dense.scalar_ranges(vectors)
    encoded = dense.scalar_encode(vectors, ranges, BITS)
    both = dense.scalar_decode(encoded.withColumn("kept", F.col("code")), ranges, BITS)
    pairs = both.select("vec_id", F.posexplode(F.arrays_zip("kept", "vec")).alias("d", "z"))
    return pairs.select(
        "vec_id", F.col("d").cast("bigint").alias("d"), F.col("z.kept").cast("bigint").alias("code"),
        F.round("z.vec", 6).alias("decoded"),
    )


@query("d10_product_quantisation")
def d10(spark: SparkSession, sf: str) -> DataFrame:
    passages = _passages(fx.vectors(spark, sf))
    books = dense.product_codebooks(passages, parts=8, codes=16)
    decoded = dense.product_decode(dense.product_encode(passages, books), books)
    return dense.vector_topk(passages.withColumnRenamed("pid", "qid"), decoded, 10, "l2")


TEXT_CELLS, TEXT_ROUNDS = 16, 2


def _text_cells_sql(body: str) -> str:
    """Rounds of k-means over the weights, one after the other: ``a`` (pid, cell, d2) and the centres ``c`` of the last."""

    def nearest(vectors: str, ids: str, n: int, by: str, weight: str) -> str:
        return f"""SELECT {by}, cell, d2 FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY d2, cell) AS n FROM (
            SELECT i.{by}, m.cell, round(CASE WHEN i.{by} IN (SELECT {by} FROM {vectors}) THEN 1 ELSE 0 END + c2 - 2 * coalesce(dot, 0), 6) AS d2
            FROM {ids} i CROSS JOIN (SELECT cell, sum(w * w) AS c2 FROM c{n} GROUP BY cell) m
            LEFT JOIN (SELECT v.{by}, c.cell, sum(v.{weight} * c.w) AS dot FROM {vectors} v JOIN c{n} c USING (term) GROUP BY v.{by}, c.cell) d
            ON d.{by} = i.{by} AND d.cell = m.cell)) WHERE n = 1"""

    steps = [
        f"""c0 AS (SELECT cell, term, w FROM pweights JOIN (
              SELECT pid, row_number() OVER (ORDER BY md5(pid || ':2024'), pid) - 1 AS cell FROM (SELECT DISTINCT pid FROM pweights)
              ORDER BY md5(pid || ':2024'), pid LIMIT {TEXT_CELLS}) USING (pid))"""
    ]
    for n in range(TEXT_ROUNDS + 1):
        steps.append(f"a{n} AS ({nearest('pweights', 'passages', n, 'pid', 'w')})")
        steps.append(f"""c{n + 1} AS (SELECT cell, term, w FROM (SELECT cell, term, round(sum(w) / any_value(n), 9) AS w
            FROM pweights JOIN a{n} USING (pid) JOIN (SELECT cell, count(*) AS n FROM a{n} GROUP BY cell) USING (cell)
            GROUP BY cell, term) WHERE w <> 0)""")
    steps.append(f"a AS (SELECT * FROM a{TEXT_ROUNDS}), q AS ({nearest('qweights', 'questions', TEXT_ROUNDS, 'qid', 'wq')})")
    return f"SELECT * FROM (WITH {', '.join(steps)} {body})"


@query(
    "d11_clustered_tfidf",
    _text_cells_sql(
        """SELECT qid, rank, pid, score FROM (
             SELECT qid, pid, score, row_number() OVER (PARTITION BY qid ORDER BY score, pid) AS rank FROM (
               SELECT q.qid, a.pid, round(CASE WHEN a.pid IN (SELECT pid FROM pweights) THEN 2 ELSE 1 END
                        - CASE WHEN q.qid IN (SELECT qid FROM qweights) THEN 0 ELSE 1 END - 2 * coalesce(dot, 0), 6) AS score
               FROM q JOIN a USING (cell) LEFT JOIN (
                 SELECT qid, pid, sum(w * wq) AS dot FROM qweights JOIN pweights USING (term) GROUP BY qid, pid) s
               ON s.qid = q.qid AND s.pid = a.pid)) WHERE rank <= 10"""
    ),
    uses="pweights qweights passages questions",
)
def d11(spark: SparkSession, sf: str) -> DataFrame:
    index = fx.index(spark, sf, "tfidf")
    clusters = clustered_text.fit_cells(index, cells=TEXT_CELLS, rounds=TEXT_ROUNDS)
    return clustered_text.clustered_tfidf_topk(index, clusters, fx.questions(spark, sf), 10).select("qid", _rank(), "pid", "score")


@query("d11_text_cells", _text_cells_sql("SELECT pid, cell, d2 FROM a"), uses="pweights qweights passages questions")
def d11_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The cell of every passage."""
    index = fx.index(spark, sf, "tfidf")
    clusters = clustered_text.fit_cells(index, cells=TEXT_CELLS, rounds=TEXT_ROUNDS)
    found = clustered_text.nearest_centres(index.weights, index.passages, clusters.centres, "pid")
    return found.select("pid", F.col("cell").cast("bigint").alias("cell"), "d2")


# -- sampling -------------------------------------------------------------

@query(
    "n1_fixed_sample",
    "SELECT doc_id, text FROM documents ORDER BY md5(doc_id || ':2024'), doc_id LIMIT 1000",
)
def n1(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.fixed_sample(fx.table(spark, sf, "documents").select("doc_id", "text"), "doc_id", 1000)


_DRAWS = """(SELECT id AS qid, slot, CASE WHEN slot = 0 THEN pid WHEN draw >= pid THEN draw + 1 ELSE draw END AS pid
             FROM (SELECT id, pid, slot, ('0x' || substr(md5(id || ':' || slot || ':2024'), 1, 15))::BIGINT % ((SELECT count(*) FROM passages) - 1) AS draw
                   FROM examples JOIN passages ON text = context, range(3) r(slot)))"""


def _positives(spark: SparkSession, sf: str) -> DataFrame:
    """(qid, question, pid): every example with the passage that holds it."""
    examples = fx.qa_examples(spark, sf).select(F.col("id").alias("qid"), "question", F.col("context").alias("text"))
    return examples.join(fx.passages(spark, sf), "text").select("qid", "question", "pid")


@query("n2_negative_sampling", f"SELECT qid, slot, pid FROM {_DRAWS}", uses="examples passages")
def n2(spark: SparkSession, sf: str) -> DataFrame:
    drawn = sampling.draw_negatives(_positives(spark, sf), fx.passages(spark, sf))
    return drawn.select("qid", F.col("slot").cast("bigint").alias("slot"), "pid")


@query(
    "n3_triplets",
    f"""SELECT qid, question, max(text) FILTER (WHERE slot = 0) AS positive, max(text) FILTER (WHERE slot = 1) AS negative1,
               max(text) FILTER (WHERE slot = 2) AS negative2
        FROM {_DRAWS} JOIN passages USING (pid) JOIN examples ON id = qid GROUP BY qid, question""",
    uses="examples passages",
)
def n3(spark: SparkSession, sf: str) -> DataFrame:
    positives, passages = _positives(spark, sf), fx.passages(spark, sf)
    rows = sampling.triplets(sampling.draw_negatives(positives, passages), positives, passages)
    names = ("positive", "negative1", "negative2")
    return rows.select("qid", "question", *(F.col("passages")[i].alias(n) for i, n in enumerate(names)))


@query(
    "n4_contrastive_loss",
    """SELECT round(avg(m + ln(s) - x0), 6) AS loss FROM (
         SELECT qid, any_value(m) AS m, sum(exp(x - m)) AS s, max(x) FILTER (WHERE slot = 0) AS x0 FROM (
           SELECT qid, slot, x, max(x) OVER (PARTITION BY qid) AS m FROM (
             SELECT qid, slot, list_inner_product(q.v, p.v) AS x FROM (
               SELECT vec_id AS qid, slot, CASE WHEN slot = 0 THEN vec_id WHEN draw >= vec_id THEN draw + 1 ELSE draw END AS pid
               FROM (SELECT vec_id, slot, ('0x' || substr(md5(vec_id || ':' || slot || ':2024'), 1, 15))::BIGINT % ((SELECT count(*) FROM vecs) - 1) AS draw
                     FROM vecs, range(3) r(slot)))
             JOIN vecs q ON q.vec_id = qid JOIN vecs p ON p.vec_id = pid)) GROUP BY qid)""",
    uses="vecs",
)
def n4(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector with itself as the positive."""
    vectors = fx.vectors(spark, sf)
    drawn = sampling.draw_negatives(vectors.select(F.col("vec_id").alias("qid"), F.col("vec_id").alias("pid")), vectors)
    return sampling.contrastive_loss(drawn, _queries(vectors), _passages(vectors))


@query(
    "n5_shuffled_batches",
    "SELECT doc_id, (row_number() OVER (ORDER BY md5(doc_id || ':2024'), doc_id) - 1) // 8 AS batch_id FROM documents",
)
def n5(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.shuffled_batches(fx.table(spark, sf, "documents").select("doc_id"), "doc_id", 8)


# -- mixtures -------------------------------------------------------------

_HITS = "(SELECT qid, rank, pid, score FROM bm25_ranked WHERE rank <= 10)"
_WEIGHTS = f"""(SELECT qid, rank, x / sum(x) OVER (PARTITION BY qid) AS p FROM (
                SELECT qid, rank, exp(score - max(score) OVER (PARTITION BY qid)) AS x FROM {_HITS}))"""
_LOGITS = f"""(SELECT qid AS id, rank, pos, v AS vocab_id, ((pos * 7 + v * 13 + qid * 29 + rank * 3) % 17) / 4.0 AS logit
               FROM {_HITS}, range(30) a(pos), range(16) b(v))"""
_MIXED = f"""(SELECT id, pos, vocab_id, sum(p * logit) AS logit
              FROM {_LOGITS} l JOIN {_WEIGHTS} w ON w.qid = l.id AND w.rank = l.rank GROUP BY id, pos, vocab_id)"""
_DECODED = f"""(SELECT id, pos, vocab_id FROM (
                 SELECT id, pos, vocab_id, row_number() OVER (PARTITION BY id, pos ORDER BY round(logit, 6) DESC, vocab_id) AS n
                 FROM {_MIXED}) WHERE n = 1)"""
_TARGETS = f"""(SELECT id, pos, vocab_id AS target FROM (
                 SELECT id, pos, vocab_id, row_number() OVER (PARTITION BY id, pos ORDER BY logit DESC, vocab_id) AS n
                 FROM {_LOGITS} WHERE rank = 1) WHERE n = 1)"""


def _hits(spark: SparkSession, sf: str) -> DataFrame:
    return fx.stored(
        spark, sf, "bm25_hits", lambda: retrieve(fx.index(spark, sf, "bm25"), fx.questions(spark, sf), 10)
    )


def _mixed(spark: SparkSession, sf: str) -> DataFrame:
    hits = _hits(spark, sf)
    asked = count_up_to(fx.questions(spark, sf))
    bound = None if asked is None else asked * 10
    return mixture.mixed_logits(fx.sequence_logits(hits), mixture.retrieval_weights(hits), bound)


def _targets(spark: SparkSession, sf: str) -> DataFrame:
    """(id, pos, vocab_id): what the first passage alone would say."""
    first = fx.sequence_logits(_hits(spark, sf)).filter(F.col("rank") == 1)
    return mixture.greedy_decode(first.select("id", "pos", "vocab_id", "logit"))


def _ids(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


@query("a10_score_softmax", f"SELECT qid, rank, round(p, 6) AS p FROM {_WEIGHTS}", uses="bm25_ranked")
def a10(spark: SparkSession, sf: str) -> DataFrame:
    return mixture.retrieval_weights(_hits(spark, sf)).select("qid", _rank(), F.round("p", 6).alias("p"))


@query("a11_score_mixture", f"SELECT id, pos, vocab_id, round(logit, 6) AS logit FROM {_MIXED}", uses="bm25_ranked")
def a11(spark: SparkSession, sf: str) -> DataFrame:
    return _mixed(spark, sf).select("id", *_ids("pos", "vocab_id"), F.round("logit", 6).alias("logit"))


@query("a12_greedy_decode", f"SELECT id, pos, vocab_id FROM {_DECODED}", uses="bm25_ranked")
def a12(spark: SparkSession, sf: str) -> DataFrame:
    return mixture.greedy_decode(_mixed(spark, sf)).select("id", *_ids("pos", "vocab_id"))


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same logits as one array of a passage."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "vocab_id", "logit")))
    long = fx.sequence_logits(_hits(spark, sf)).groupBy("id", "rank").agg(ordered.alias("all"), F.countDistinct("pos").alias("n"))
    return long.select("id", "rank", F.col("n").cast("int").alias("positions"), F.transform("all", lambda x: x["logit"].cast("float")).alias("logits"))


@query("a11_block_mixture", f"SELECT id, pos, vocab_id, round(logit, 6) AS logit FROM {_MIXED}", uses="bm25_ranked")
def a11_blocks(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixture.mix_blocks(_blocks(spark, sf), mixture.retrieval_weights(_hits(spark, sf)))
    width = (F.size("logits") / F.col("positions")).cast("int")
    each = mixed.select("id", width.alias("width"), F.posexplode("logits").alias("at", "logit"))
    return each.select(
        "id", F.expr("at div width").cast("bigint").alias("pos"), (F.col("at") % F.col("width")).cast("bigint").alias("vocab_id"),
        F.round("logit", 6).alias("logit"),
    )


@query("a12_block_decode", f"SELECT id, pos, vocab_id FROM {_DECODED}", uses="bm25_ranked")
def a12_blocks(spark: SparkSession, sf: str) -> DataFrame:
    decoded = mixture.decode_blocks(_blocks(spark, sf), mixture.retrieval_weights(_hits(spark, sf)))
    return decoded.select("id", F.posexplode("ids").alias("pos", "vocab_id")).select("id", *_ids("pos", "vocab_id"))


@query(
    "a13_pair_vectors",
    """SELECT qid, rank, pid, len(a.v) + len(b.v) AS width, round(list_sum(a.v), 6) AS head, round(list_sum(b.v), 6) AS tail
       FROM ip_ranked JOIN vecs a ON a.vec_id = qid JOIN vecs b ON b.vec_id = pid WHERE rank <= 10""",
    uses="ip_ranked vecs",
)
def a13(spark: SparkSession, sf: str) -> DataFrame:
    vectors = fx.vectors(spark, sf)
    queries, passages = _queries(vectors), _passages(vectors)
    pairs = mixture.pair_vectors(dense.vector_topk(queries, passages, 10), queries, passages)

    def total(first: Column) -> Column:
        half = F.slice(F.col("vec").cast("array<double>"), first, (F.size("vec") / 2).cast("int"))
        return F.round(F.aggregate(half, F.lit(0.0), lambda a, x: a + x), 6)

    return pairs.select(
        "qid", _rank(), "pid", F.size("vec").cast("bigint").alias("width"),
        total(F.lit(1)).alias("head"), total((F.size("vec") / 2 + 1).cast("int")).alias("tail"),
    )


@query(
    "a14_sequence_loss",
    f"""SELECT round(avg(m + ln(s) - x), 6) AS loss FROM (
          SELECT id, pos, any_value(m) AS m, sum(exp(logit - m)) AS s, max(logit) FILTER (WHERE vocab_id = target) AS x
          FROM (SELECT id, pos, vocab_id, logit, target, max(logit) OVER (PARTITION BY id, pos) AS m
                FROM {_MIXED} JOIN {_TARGETS} USING (id, pos) WHERE target <> 3) GROUP BY id, pos)""",
    uses="bm25_ranked",
)
def a14(spark: SparkSession, sf: str) -> DataFrame:
    return mixture.sequence_loss(_mixed(spark, sf), _targets(spark, sf).withColumnRenamed("vocab_id", "target"))


_PREFIX = """SELECT id, list({0} ORDER BY pos) FILTER (WHERE pos < stop) AS ids, any_value(stop) AS stop FROM (
               SELECT id, pos, {0}, min(CASE WHEN {0} = 1 THEN pos END) OVER (PARTITION BY id) AS stop FROM {1})
             GROUP BY id"""


@query(
    "e8_sequence_exact_match",
    f"""SELECT round(avg(CASE WHEN p.stop IS NOT NULL AND y.stop IS NOT NULL
                               AND coalesce(p.ids, []) = coalesce(y.ids, []) THEN 1.0 ELSE 0.0 END), 6) AS exact_match,
               count(*) AS total
        FROM ({_PREFIX.format('target', _TARGETS)}) y LEFT JOIN ({_PREFIX.format('vocab_id', _DECODED)}) p USING (id)""",
    uses="bm25_ranked",
)
def e8(spark: SparkSession, sf: str) -> DataFrame:
    predicted = mixture.as_sequence(mixture.greedy_decode(_mixed(spark, sf)))
    return mixture.sequence_exact_match(predicted, mixture.as_sequence(_targets(spark, sf)))
