"""Queries of the window and answer-span operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern.catalog import fixtures as fx
from lectern.catalog.registry import query
from lectern.functions import text as tx
from lectern.operators import reader, windows
from lectern.operators.corpus import features_per_example, predictions_to_rows
from lectern.sources import sinks


def _long(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


@query(
    "t9_token_offsets",
    "SELECT id, pos, s, e, tok FROM tok_spans",
    uses="tok_spans",
)
def t9(spark: SparkSession, sf: str) -> DataFrame:
    examples = fx.qa_examples(spark, sf)
    spans = examples.select(
        "id", F.arrays_zip(tx.token_spans(F.col("context")).alias("o"), tx.cased_tokens(F.col("context")).alias("t")).alias("z")
    )
    rows = spans.select("id", F.posexplode("z").alias("pos", "z"))
    return rows.select(
        "id", F.col("pos").cast("bigint").alias("pos"), F.col("z.o.s").cast("bigint").alias("s"),
        F.col("z.o.e").cast("bigint").alias("e"), F.col("z.t").alias("tok"),
    )


@query(
    "c1_feature_windows",
    """SELECT example_id, window_no, nq + 3 + last - first + 1 AS n_tokens,
              '[CLS] ' || (SELECT array_to_string(q, ' ') FROM ex_spans x WHERE x.id = example_id) || ' [SEP] '
              || (SELECT string_agg(tok, ' ' ORDER BY pos) FROM window_toks t
                  WHERE t.example_id = w.example_id AND t.window_no = w.window_no) || ' [SEP]' AS tokens
       FROM windows w""",
    uses="windows window_toks ex_spans",
)
def c1(spark: SparkSession, sf: str) -> DataFrame:
    return windows.features(fx.qa_examples(spark, sf)).select(
        F.col("id").alias("example_id"),
        F.col("window_no").cast("bigint").alias("window_no"),
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.array_join("tokens", " ").alias("tokens"),
    )


@query(
    "c2_context_mask",
    """SELECT example_id, window_no, i, coalesce(s, -1) AS s, coalesce(e, -1) AS e
       FROM (SELECT example_id, window_no, unnest(range(nq + 3 + last - first + 1)) AS i FROM windows)
       LEFT JOIN window_toks USING (example_id, window_no, i)""",
    uses="windows window_toks",
)
def c2(spark: SparkSession, sf: str) -> DataFrame:
    rows = windows.features(fx.qa_examples(spark, sf)).select(
        F.col("id").alias("example_id"), "window_no", F.posexplode("offsets").alias("i", "o")
    )
    return rows.select(
        "example_id", *_long("window_no", "i"),
        F.coalesce("o.s", F.lit(-1)).cast("bigint").alias("s"), F.coalesce("o.e", F.lit(-1)).cast("bigint").alias("e"),
    )


@query(
    "c3_answer_labels",
    """SELECT w.example_id, w.window_no,
              CASE WHEN lo <= answer_start AND hi >= answer_end THEN a ELSE 0 END AS start_position,
              CASE WHEN lo <= answer_start AND hi >= answer_end THEN b ELSE 0 END AS end_position
       FROM (SELECT example_id, window_no, min(s) AS lo, max(e) AS hi,
                    max(i) FILTER (WHERE s <= answer_start) AS a, min(i) FILTER (WHERE e >= answer_end) AS b,
                    any_value(answer_start) AS answer_start, any_value(answer_end) AS answer_end
             FROM window_toks JOIN ex_spans ON id = example_id GROUP BY example_id, window_no) w""",
    uses="window_toks ex_spans",
)
def c3(spark: SparkSession, sf: str) -> DataFrame:
    labelled = windows.label_answers(windows.features(fx.qa_examples(spark, sf)))
    return labelled.select(F.col("id").alias("example_id"), *_long("window_no", "start_position", "end_position"))


@query(
    "c4_fixed_chunks",
    r"""SELECT pid, c AS chunk_no, array_to_string(toks[c * 250 + 1:c * 250 + 300], ' ') AS chunk
        FROM (SELECT pid, toks, unnest(range(CASE WHEN len(toks) <= 300 THEN 1
                ELSE 1 + CAST(ceil((len(toks) - 300) / 250) AS BIGINT) END)) AS c
              FROM (SELECT pid, [x for x in string_split_regex(text, '\s+') if x <> ''] AS toks FROM passages))""",
    uses="passages",
)
def c4(spark: SparkSession, sf: str) -> DataFrame:
    return windows.fixed_chunks(fx.passages(spark, sf)).select(
        "pid", *_long("chunk_no"), F.array_join("tokens", " ").alias("chunk")
    )


def _subwords():
    """The pieces of a public vocabulary; the file is not part of this library."""
    import public_tokenizers

    return tx.subwords(public_tokenizers.path("byte_bpe_50k.json"))


@query("c4_subword_chunks", "SELECT pid, md5(text) AS digest FROM passages", uses="passages")
def c4_subwords(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of 300 pieces that do not overlap: one after the other, what they cover is the passage."""
    chunks = windows.fixed_chunks(fx.passages(spark, sf), 300, 0, _subwords())
    ordered = F.array_sort(F.collect_list(F.struct("chunk_no", "text")))
    whole = chunks.groupBy("pid").agg(F.array_join(F.transform(ordered, lambda c: c["text"]), "").alias("text"))
    return whole.select("pid", F.md5("text").alias("digest"))


@query("c3_subword_labels", "SELECT id AS example_id, answer, TRUE AS held FROM examples", uses="examples")
def c3_subwords(spark: SparkSession, sf: str) -> DataFrame:
    """Windows over pieces: neighbours share more than an answer, so some window holds it, and the labelled pieces cover it."""
    examples = fx.qa_examples(spark, sf)
    labelled = windows.label_answers(windows.features(examples.withColumn("read", F.col("context")), reader=_subwords()))
    first = F.get("offsets", F.col("start_position"))["s"]
    span = F.substring("read", first + 1, F.get("offsets", F.col("end_position"))["e"] - first)
    answer = F.get("answers.text", 0)
    return labelled.groupBy(F.col("id").alias("example_id"), answer.alias("answer")).agg(
        F.max((F.col("start_position") > 0) & F.contains(span, answer)).alias("held")
    )


WORDS_SQL = r"len([w FOR w IN string_split_regex({}, '\s+') IF w <> ''])"


def chunk_sql(size: int, overlap: int, length: str) -> str:
    """Chunks at separators as one recursive query; ``length`` is an SQL form with ``{}`` for the text. What one cut gives has a
    path, and lies in one run with its neighbours as far as no piece that is too long is between them. In a run the end of a chunk
    follows from its first piece, and the next first piece from that end, so there is a step per chunk."""
    levels, source = [], "whole"
    for i, separator in enumerate(("chr(10) || chr(10)", "chr(10)", "' '", "''")):
        parts = f"string_split(t, {separator})" if i < 3 else "regexp_extract_all(t, '(?s).')"
        cut = f"(n >= {size} AND contains(t, {separator}))"
        levels.append(
            f"""cut{i} AS (
              SELECT pid, path || [j] AS path, t, n, path || [coalesce(sum(CASE WHEN n >= {size} THEN 1 ELSE 0 END) OVER (
                       PARTITION BY pid, path ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT] AS run
              FROM (SELECT pid, path, j, t, CAST({length.format("t")} AS BIGINT) AS n
                    FROM (SELECT pid, path, j, CASE WHEN j > 1 THEN {separator} ELSE '' END || part AS t
                          FROM (SELECT pid, path, unnest(parts) AS part, generate_subscripts(parts, 1)::BIGINT AS j
                                FROM (SELECT pid, path, {parts} AS parts FROM {source} WHERE {cut}))) WHERE t <> '')
              UNION ALL SELECT pid, path, t, n, run FROM {source} WHERE NOT {cut})"""
        )
        source = f"cut{i}"
    fits = f"len([c FOR c IN sums IF c <= sums[{{0}} + 1] + {size}]) - 1"
    return rf"""WITH RECURSIVE
      whole AS (SELECT pid, [0::BIGINT] AS path, coalesce(text, '') AS t, {size}::BIGINT AS n, [0::BIGINT] AS run FROM passages),
      {", ".join(levels)},
      runs AS (SELECT pid, min(path) AS place, list(t ORDER BY path) AS ts, [0::HUGEINT] || list(c ORDER BY path) AS sums
               FROM (SELECT *, sum(n) OVER (PARTITION BY pid, run ORDER BY path) AS c FROM {source}) GROUP BY pid, run),
      chunks AS (
        SELECT pid, place, ts, sums, 0::BIGINT AS k, 0::BIGINT AS lo, {fits.format("0")} AS hi FROM runs
        UNION ALL
        SELECT pid, place, ts, sums, k, lo, {fits.format("lo")} AS hi
        FROM (SELECT pid, place, ts, sums, k + 1 AS k, list_min([j FOR j IN range(lo, hi + 1)
                     IF sums[hi + 1] - sums[j + 1] <= {overlap} AND sums[hi + 2] - sums[j + 1] <= {size}]) AS lo
              FROM chunks WHERE hi < len(ts))),
      texts AS (SELECT pid, place, k, regexp_replace(array_to_string(ts[lo + 1:hi], ''),
                       '^[\s-\p{{Z}}]+|[\s-\p{{Z}}]+$', '', 'g') AS text FROM chunks)
      SELECT pid, row_number() OVER (PARTITION BY pid ORDER BY place, k) - 1 AS chunk_no, text FROM texts WHERE text <> ''"""


@query("c5_recursive_chunks", f"SELECT * FROM ({chunk_sql(300, 50, 'length({})')})", uses="passages")
def c5(spark: SparkSession, sf: str) -> DataFrame:
    return windows.recursive_chunks(fx.passages(spark, sf)).select("pid", *_long("chunk_no"), "text")


@query(
    "c5_word_chunks",
    f"SELECT * FROM ({chunk_sql(40, 10, WORDS_SQL)})",
    uses="passages",
)
def c5_words(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks measured by their words."""
    chunks = windows.recursive_chunks(fx.passages(spark, sf), 40, 10, length=lambda piece: len(piece.split()))
    return chunks.select("pid", *_long("chunk_no"), "text")


@query(
    "r10_features_per_example",
    """SELECT example_id, string_agg(example_id || '-' || window_no, ',' ORDER BY example_id || '-' || window_no)
              AS feature_ids
       FROM windows GROUP BY example_id""",
    uses="windows",
)
def r10(spark: SparkSession, sf: str) -> DataFrame:
    grouped = features_per_example(fx.scored_features(spark, sf))
    return grouped.select("example_id", F.array_join("feature_ids", ",").alias("feature_ids"))


@query(
    "a1_top_positions",
    """SELECT example_id || '-' || window_no AS feature_id, n, i AS i, CAST(logit AS DOUBLE) AS logit, side FROM (
         SELECT example_id, window_no, n, si AS i, start_logit AS logit, 'start' AS side FROM starts
         UNION ALL SELECT example_id, window_no, n, ei, end_logit, 'end' FROM ends)""",
    uses="starts ends",
)
def a1(spark: SparkSession, sf: str) -> DataFrame:
    scored = fx.scored_features(spark, sf)
    starts = reader.top_positions(scored, "start_logits").withColumn("side", F.lit("start"))
    ends = reader.top_positions(scored, "end_logits").withColumn("side", F.lit("end"))
    return starts.unionByName(ends).select("feature_id", *_long("n", "i"), "logit", "side")


_SPAN_SQL = """SELECT example_id, window_no, si AS start_index, ei AS end_index FROM spans"""


@query("r12_candidate_pairs", _SPAN_SQL, uses="spans")
def r12(spark: SparkSession, sf: str) -> DataFrame:
    spans = reader.candidate_spans(fx.scored_features(spark, sf))
    return spans.select("example_id", *_long("window_no", "start_index", "end_index"))


@query(
    "a2_candidate_filter",
    """SELECT example_id, count(*) AS n, count(*) FILTER (WHERE ei = si + 29) AS longest,
              count(*) FILTER (WHERE ei = si) AS single FROM spans GROUP BY example_id""",
    uses="spans",
)
def a2(spark: SparkSession, sf: str) -> DataFrame:
    spans = reader.candidate_spans(fx.scored_features(spark, sf))
    width = F.col("end_index") - F.col("start_index")
    return spans.groupBy("example_id").agg(
        F.count("*").alias("n"),
        F.count_if(width == reader.MAX_ANSWER_LENGTH - 1).alias("longest"),
        F.count_if(width == 0).alias("single"),
    )


@query(
    "a3_candidate_text",
    """SELECT example_id, window_no, si AS start_index, ei AS end_index, CAST(score AS DOUBLE) AS score, text FROM spans""",
    uses="spans",
)
def a3(spark: SparkSession, sf: str) -> DataFrame:
    spans = reader.candidate_spans(fx.scored_features(spark, sf))
    contexts = fx.qa_examples(spark, sf).select(F.col("id").alias("example_id"), "context")
    text = F.substring(F.col("context"), F.col("s") + 1, F.col("e") - F.col("s"))
    return spans.join(contexts, "example_id").select(
        "example_id", *_long("window_no", "start_index", "end_index"), "score", text.alias("text")
    )


@query(
    "a4_nbest",
    "SELECT example_id, rank, text, CAST(score AS DOUBLE) AS score FROM nbest",
    uses="nbest",
)
def a4(spark: SparkSession, sf: str) -> DataFrame:
    best = reader.nbest(fx.scored_features(spark, sf), fx.qa_examples(spark, sf))
    return best.select("example_id", *_long("rank"), "text", "score")


@query(
    "a5_null_scores",
    """SELECT example_id, rank, text, CAST(score AS DOUBLE) AS score FROM nbest_null""",
    uses="nbest_null",
)
def a5(spark: SparkSession, sf: str) -> DataFrame:
    best = reader.nbest(fx.scored_features(spark, sf), fx.qa_examples(spark, sf), with_null=True)
    return best.select("example_id", *_long("rank"), "text", "score")


@query(
    "a6_empty_fallback",
    "SELECT id AS example_id, 1 AS rank, 'empty' AS text, CAST(0 AS DOUBLE) AS score FROM examples",
    uses="examples",
)
def a6(spark: SparkSession, sf: str) -> DataFrame:
    """With a length limit of zero no span is left, so every example falls back."""
    best = reader.nbest(fx.scored_features(spark, sf), fx.qa_examples(spark, sf), max_answer_length=0)
    return best.select("example_id", *_long("rank"), "text", "score")


@query(
    "a7_nbest_softmax",
    """SELECT example_id, rank, round(x / sum(x) OVER (PARTITION BY example_id), 6) AS probability
       FROM (SELECT example_id, rank, exp(score - max(score) OVER (PARTITION BY example_id)) AS x FROM nbest)""",
    uses="nbest",
)
def a7(spark: SparkSession, sf: str) -> DataFrame:
    best = reader.nbest(fx.scored_features(spark, sf), fx.qa_examples(spark, sf))
    return best.select("example_id", *_long("rank"), F.round("probability", 6).alias("probability"))


@query(
    "a8_best_answer",
    """SELECT n.example_id AS id,
              CASE WHEN b.text IS NULL OR n.score - b.start_logit - b.end_logit > 0 THEN '' ELSE b.text END
                AS prediction_text,
              CAST(round(n.score - b.start_logit - b.end_logit, 6) AS DOUBLE) AS score_diff,
              p.text AS answer_without_null
       FROM null_scores n
       LEFT JOIN (SELECT example_id, arg_min(text, rank) AS text, arg_min(start_logit, rank) AS start_logit,
                         arg_min(end_logit, rank) AS end_logit
                  FROM nbest_null WHERE text <> '' GROUP BY example_id) b ON b.example_id = n.example_id
       JOIN nbest p ON p.example_id = n.example_id AND p.rank = 1""",
    uses="null_scores nbest_null nbest",
)
def a8(spark: SparkSession, sf: str) -> DataFrame:
    scored, examples = fx.scored_features(spark, sf), fx.qa_examples(spark, sf)
    with_null = reader.best_answers(reader.nbest(scored, examples, with_null=True), reader.null_scores(scored))
    plain = reader.best_answers(reader.nbest(scored, examples)).withColumnRenamed(
        "prediction_text", "answer_without_null"
    )
    return with_null.join(plain, "id")


@query(
    "a9_nbest_report",
    """SELECT example_id AS id, n AS place, text, CAST(start_logit AS DOUBLE) AS start_logit,
              CAST(end_logit AS DOUBLE) AS end_logit, round(x / sum(x) OVER (PARTITION BY example_id), 6) AS probability
       FROM (SELECT *, rank - 1 AS n, exp(score - max(score) OVER (PARTITION BY example_id)) AS x FROM nbest)""",
    uses="nbest",
)
def a9(spark: SparkSession, sf: str) -> DataFrame:
    report = reader.nbest_report(reader.nbest(fx.scored_features(spark, sf), fx.qa_examples(spark, sf)))
    rows = report.select("id", F.posexplode("nbest").alias("place", "c"))
    return rows.select(
        "id", *_long("place"), F.col("c.text").alias("text"), F.col("c.start_logit").alias("start_logit"),
        F.col("c.end_logit").alias("end_logit"), F.round("c.probability", 6).alias("probability"),
    )


@query(
    "r16_prediction_rows",
    "SELECT CAST(id AS VARCHAR) AS id, prediction AS prediction_text FROM pairs WHERE prediction IS NOT NULL",
    uses="pairs",
)
def r16(spark: SparkSession, sf: str) -> DataFrame:
    """Each conversation has one id -> text map; the rows come out of the maps."""
    given = fx.qa_pairs(spark, sf).filter(F.col("prediction_text").isNotNull())
    entry = F.struct(F.col("id").cast("string"), F.col("prediction_text"))
    maps = given.groupBy(F.floor(F.col("id") / 100).alias("conv_id")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("predictions")
    )
    return predictions_to_rows(maps)


@query(
    "s6_nbest_sink",
    """SELECT n.example_id AS id, (SELECT count(*) FROM nbest_null m WHERE m.example_id = n.example_id) AS entries,
              CAST(round(n.score - b.start_logit - b.end_logit, 6) AS DOUBLE) AS score_diff
       FROM null_scores n
       JOIN (SELECT example_id, arg_min(start_logit, rank) AS start_logit, arg_min(end_logit, rank) AS end_logit
             FROM nbest_null WHERE text <> '' GROUP BY example_id) b ON b.example_id = n.example_id""",
    uses="null_scores nbest_null",
)
def s6(spark: SparkSession, sf: str) -> DataFrame:
    scored, examples = fx.scored_features(spark, sf), fx.qa_examples(spark, sf)
    best = reader.nbest(scored, examples, with_null=True)
    odds = reader.best_answers(best, reader.null_scores(scored)).select("id", "score_diff")
    path = fx.fresh_path(spark, "nbest")
    sinks.write_nbest(reader.nbest_report(best), path + "/nbest")
    sinks.write_null_odds(odds, path + "/null_odds")
    return sinks.read_nbest(spark, path + "/nbest").join(sinks.read_null_odds(spark, path + "/null_odds"), "id").select(
        "id", F.size("nbest").cast("bigint").alias("entries"), "score_diff"
    )
