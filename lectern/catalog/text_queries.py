"""Queries of the cleaning, tokenising and formatting operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.catalog import fixtures as fx
from lectern.catalog.registry import query
from lectern.functions import text as tx
from lectern.operators import cleaning, sequences, windows
from lectern.operators.sampling import shuffled_batches
from lectern.operators.sparse import retrieve
from lectern.plans.retrieval import with_texts

ALNUM = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
WIDE = "".join(chr(ord(c) + 0xFEE0) for c in ALNUM)
# letters of the corpus stand in for the special characters it does not hold
PLAIN_MARKS, SPECIAL_MARKS = "bdfghklmpqvwxz", "“”‘’〈＜「≪《〉＞」≫》"

_SPECIAL_SQL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '[“”‘’]', '''', 'g'),
  '[〈<＜「≪《『]', '<', 'g'), '[〉>＞」≫》』]', '>', 'g'), '\\n|\*|\n|\|#', '', 'g')"""


def special_sql(column: str) -> str:
    return _SPECIAL_SQL.format(column)


_PROMPT_SQL = r"""regexp_replace(replace(replace(replace(replace(replace(replace(replace({0},
  '\n', ''), chr(10), ''), '\', ''), 'context', ''), ':', ''), '.', ''), '"', ''), '^\s+|\s+$', '', 'g')"""


def prompt_sql(column: str) -> str:
    return _PROMPT_SQL.format(column)


@query(
    "t1_full_width_fold",
    f"SELECT pid, translate(translate(text, '{ALNUM}', '{WIDE}'), '{WIDE}', '{ALNUM}') AS folded FROM passages",
    uses="passages",
)
def t1(spark: SparkSession, sf: str) -> DataFrame:
    wide = fx.passages(spark, sf).withColumn("text", F.translate("text", ALNUM, WIDE))
    return wide.select("pid", tx.fold_full_width(F.col("text")).alias("folded"))


@query(
    "t1_nfkc",
    f"SELECT pid, translate(translate(text, '{ALNUM}', '{WIDE}'), '{WIDE}', '{ALNUM}') AS normal FROM passages",
    uses="passages",
)
def t1_nfkc(spark: SparkSession, sf: str) -> DataFrame:
    wide = fx.passages(spark, sf).withColumn("text", F.translate("text", ALNUM, WIDE))
    return wide.select("pid", tx.nfkc("text").alias("normal"))


@query(
    "t2_special_characters",
    f"SELECT pid, {special_sql(f'''translate(text, '{PLAIN_MARKS}', '{SPECIAL_MARKS}')''')} AS cleaned FROM passages",
    uses="passages",
)
def t2(spark: SparkSession, sf: str) -> DataFrame:
    marked = fx.passages(spark, sf).withColumn("text", F.translate("text", PLAIN_MARKS, SPECIAL_MARKS))
    return marked.select("pid", tx.rewrite_special(F.col("text")).alias("cleaned"))


@query(
    "t3_offset_remap",
    f"""SELECT id, len({special_sql('substr(context, 1, answer_start)')}) AS answer_start,
               {special_sql('context')} AS context FROM examples""",
    uses="examples",
)
def t3(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = cleaning.remap_answers(fx.qa_examples(spark, sf), tx.rewrite_special)
    return cleaned.select("id", F.get("answers.answer_start", 0).cast("bigint").alias("answer_start"), "context")


@query(
    "t4_cleaning",
    f"""SELECT id, question, {special_sql('context')} AS context, answer,
               len({special_sql('substr(context, 1, answer_start)')}) AS answer_start FROM examples""",
    uses="examples",
)
def t4(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = cleaning.clean_examples(fx.qa_examples(spark, sf))
    return cleaned.select(
        "id", "question", "context", F.get("answers.text", 0).alias("answer"),
        F.get("answers.answer_start", 0).cast("bigint").alias("answer_start"),
    )


@query("t5_prompt_cleaning", f"SELECT pid, {prompt_sql('text')} AS cleaned FROM passages", uses="passages")
def t5(spark: SparkSession, sf: str) -> DataFrame:
    return fx.passages(spark, sf).select("pid", tx.clean_prompt(F.col("text")).alias("cleaned"))


@query(
    "t6_prompts",
    f"""SELECT id, 'question: ' || {prompt_sql('question')} || '  context: ' || {prompt_sql('context')} || ' </s>' AS input,
               {prompt_sql('answer')} || ' </s>' AS target FROM examples""",
    uses="examples",
)
def t6(spark: SparkSession, sf: str) -> DataFrame:
    return fx.qa_examples(spark, sf).select(
        "id",
        tx.prompt(F.col("question"), F.col("context")).alias("input"),
        tx.target(F.get("answers.text", 0)).alias("target"),
    )


@query(
    "t7_answer_normalisation",
    r"""SELECT conv_id, turn, array_to_string([x for x in string_split_regex(
          regexp_replace(lower(text), '[!-/:-@\[-`{-~]', '', 'g'), '\s+') if x not in ('', 'a', 'an', 'the')], ' ')
          AS normal FROM conversations""",
)
def t7(spark: SparkSession, sf: str) -> DataFrame:
    turns = fx.table(spark, sf, "conversations")
    return turns.select("conv_id", "turn", tx.normalize_answer(F.col("text")).alias("normal"))


@query(
    "t8_tokens",
    """SELECT pid, array_to_string(toks, '|') AS tokens, len(toks) AS n_tokens,
              len(string_split(text, ' ')) AS n_space_tokens
       FROM ptoks JOIN passages USING (pid)""",
    uses="ptoks",
)
def t8(spark: SparkSession, sf: str) -> DataFrame:
    tokens = fx.passages(spark, sf).select("pid", "text", tx.whitespace_tokens(F.col("text")).alias("t"))
    return tokens.select(
        "pid", F.array_join("t", "|").alias("tokens"), F.size("t").cast("bigint").alias("n_tokens"),
        F.size(tx.space_tokens(F.col("text"))).cast("bigint").alias("n_space_tokens"),
    )


@query(
    "t10_bigrams",
    """SELECT pid, array_to_string([toks[i] || ' ' || toks[i + 1] for i in range(1, len(toks))], '|') AS bigrams
       FROM ptoks""",
    uses="ptoks",
)
def t10(spark: SparkSession, sf: str) -> DataFrame:
    tokens = fx.passages(spark, sf).select("pid", tx.whitespace_tokens(F.col("text")).alias("t"))
    return tokens.select("pid", F.array_join(tx.bigrams(F.col("t")), "|").alias("bigrams"))


@query(
    "t11_truncation",
    """SELECT pid, array_to_string(toks[1:512], ' ') AS passage, array_to_string(toks[1:384], ' ') AS input,
              array_to_string(toks[1:30], ' ') AS answer FROM ptoks""",
    uses="ptoks",
)
def t11(spark: SparkSession, sf: str) -> DataFrame:
    tokens = fx.passages(spark, sf).select("pid", tx.whitespace_tokens(F.col("text")).alias("t"))
    cut = [
        F.array_join(tx.truncate(F.col("t"), n), " ").alias(name)
        for n, name in ((512, "passage"), (384, "input"), (30, "answer"))
    ]
    return tokens.select("pid", *cut)


@query(
    "t12_padding",
    """SELECT 'max' AS mode, example_id || '-' || window_no AS id, n AS real, 384 - n AS padding,
              384 AS width FROM (SELECT example_id, window_no, nq + 4 + last - first AS n FROM windows)
       UNION ALL
       SELECT 'batch', CAST(id AS VARCHAR), n, width - n, width FROM (
         SELECT id, n, CAST(ceil(max(n) OVER (PARTITION BY b) / 8) * 8 AS BIGINT) AS width FROM (
           SELECT id, n, (row_number() OVER (ORDER BY md5(id || ':2024'), id) - 1) // 8 AS b FROM pairs))""",
    uses="windows pairs",
)
def t12(spark: SparkSession, sf: str) -> DataFrame:
    fixed = windows.with_padding(windows.features(fx.qa_examples(spark, sf))).select(
        F.lit("max").alias("mode"), F.col("feature_id").alias("id"), "tokens", "attention_mask"
    )
    turns = fx.table(spark, sf, "conversations").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"), tx.cased_tokens(F.col("text")).alias("tokens")
    )
    batched = sequences.pad_to_batch(shuffled_batches(turns, "id")).select(
        F.lit("batch").alias("mode"), F.col("id").cast("string"), "tokens", "attention_mask"
    )
    both = fixed.unionByName(batched)
    return both.select(
        "mode",
        "id",
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint").alias("real"),
        F.size(F.filter("tokens", lambda t: t == "[PAD]")).cast("bigint").alias("padding"),
        F.size("tokens").cast("bigint").alias("width"),
    )


@query(
    "t13_label_decoding",
    """SELECT id, coalesce(string_agg(w, ' ' ORDER BY pos) FILTER (WHERE w IN (SELECT term FROM vocab)), '') AS text
       FROM (SELECT id, unnest([lower(x) for x in words]) AS w, unnest(range(n)) AS pos FROM pairs) GROUP BY id""",
    uses="pairs vocab",
)
def t13(spark: SparkSession, sf: str) -> DataFrame:
    labels = fx.label_sequences(spark, sf)
    return sequences.decode(sequences.unmask_labels(labels, fx.PAD_ID), fx.token_vocabulary(spark, sf))


@query(
    "t14_question_passage_pairs",
    r"""SELECT qid, rank, pid, array_to_string(list_concat(
            [x for x in string_split_regex(question, '\s+') if x <> ''],
            [x for x in string_split_regex(text, '\s+') if x <> ''])[1:512], ' ') AS pair
        FROM bm25_ranked JOIN questions USING (qid) JOIN passages USING (pid) WHERE rank <= 10""",
    uses="bm25_ranked questions passages",
)
def t14(spark: SparkSession, sf: str) -> DataFrame:
    questions = fx.questions(spark, sf)
    hits = retrieve(fx.index(spark, sf, "bm25"), questions, 10)
    pairs = sequences.question_passage_pairs(with_texts(hits, questions, fx.passages(spark, sf), 10), questions)
    return pairs.select("qid", F.col("rank").cast("bigint").alias("rank"), "pid", F.array_join("tokens", " ").alias("pair"))


@query(
    "t15_decoder_pairs",
    """SELECT id, gold1 AS question, '<s>' || prediction || '</s>' AS decoder_input, prediction || '</s>' AS decoder_label
       FROM pairs""",
    uses="pairs",
)
def t15(spark: SparkSession, sf: str) -> DataFrame:
    answer = F.col("prediction_text")
    return fx.qa_pairs(spark, sf).select(
        "id", F.get("golds", 0).alias("question"), tx.decoder_input(answer).alias("decoder_input"),
        tx.decoder_label(answer).alias("decoder_label"),
    )
