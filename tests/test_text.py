import re
import string
import unicodedata

import pytest
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators import cleaning, sequences

SAMPLES = [
    "", " ", "The  A an\tCat", "a.b the-end", "naïve the été", "a\u0301 the", "…the… “a” an",
    "ABC１２３ｘｙｚ　！", "\u00a0leading", "tail\n", "x_the_y the", "한국의 the 수도", "\x1cstrip\x1f", "İstanbul",
]


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("x")).collect()]


def python_normal(s):
    s = "".join(c for c in s.lower() if c not in string.punctuation)
    return " ".join(re.sub(r"\b(a|an|the)\b", " ", s).split())


def test_answer_normalisation(spark):
    assert column(spark, SAMPLES, tx.normalize_answer) == [python_normal(s) for s in SAMPLES]


def test_strip_is_python_strip(spark):
    assert column(spark, SAMPLES, tx.strip) == [s.strip() for s in SAMPLES]


def test_nfkc_and_fold(spark):
    assert column(spark, SAMPLES, tx.nfkc) == [unicodedata.normalize("NFKC", s) for s in SAMPLES]
    wide = ["ＡＢＣ～！", "ａ　ｂ", "plain"]
    assert column(spark, wide, tx.fold_full_width) == [unicodedata.normalize("NFKC", s) for s in wide]


MARKED = ["“a” ‘b’", "〈x＜「≪《『y", "x〉>＞」≫》』", r"line\nbreak", "a*b\nc|#d", "|\\n#", "\\|#n", "|*#", "a|b#c\\d", "\\*n"]


def test_special_characters(spark):
    def expected(s):
        for chars, to in ((tx.QUOTE_CHARS, "'"), (tx.OPEN_BRACKET_CHARS, "<"), (tx.CLOSE_BRACKET_CHARS, ">")):
            s = re.sub(f"[{chars}]", to, s)
        return re.sub(r"\\n|\*|\n|\|#", "", s)

    assert column(spark, MARKED, tx.rewrite_special) == [expected(s) for s in MARKED]


def test_prompt_cleaning(spark):
    given = [' context: "x". \\n y\n ', "con:text", "a\\b", "c.ontext", "  "]

    def expected(s):
        for noise in tx.PROMPT_NOISE:
            s = s.replace(noise, "")
        return s.strip()

    assert column(spark, given, tx.clean_prompt) == [expected(s) for s in given]


def test_token_spans(spark):
    texts = ["", "  a bc\n\nd ", "é ü😀x y"]
    spans = column(spark, texts, tx.token_spans)
    for text, found in zip(texts, spans):
        assert [text[s.s : s.e] for s in found] == text.split()


def test_bigrams_and_padding(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    rows = df.select(
        tx.bigrams(F.col("t")).alias("b"), tx.pad(F.col("t"), 4).alias("p"), tx.attention_mask(F.col("t"), 4).alias("m")
    ).collect()
    assert [r.b for r in rows] == [["a b", "b c"], [], []]
    assert [len(r.p) for r in rows] == [4, 4, 4]
    assert [sum(r.m) for r in rows] == [3, 1, 0]


def test_offsets_follow_the_answer(spark):
    context = "“ﬁrst”\n*line*: ①２ the answer|# is here"
    start = context.index("answer")
    df = spark.createDataFrame(
        [(1, "ｑ？", context, (["answer"], [start]))],
        "id long, question string, context string, answers struct<text:array<string>,answer_start:array<int>>",
    )
    row = cleaning.clean_examples(df).first()
    at = row.answers.answer_start[0]
    assert row.context[at : at + 6] == "answer"
    assert row.question == "q?"


def test_label_decoding(spark):
    vocabulary = spark.createDataFrame(
        [(0, "<pad>", True), (1, "</s>", True), (2, "hello", False), (3, "world", False)],
        "vocab_id int, token string, special boolean",
    )
    ids = spark.createDataFrame([(1, [2, 3, 2, 1, -100]), (2, [-100, 1]), (3, [])], "id long, ids array<int>")
    out = sequences.decode(sequences.unmask_labels(ids, 0), vocabulary)
    assert {r.id: r.text for r in out.collect()} == {1: "hello world hello", 2: "", 3: ""}


@pytest.mark.parametrize("limit", [1, 2, 5])
def test_truncate(spark, limit):
    df = spark.createDataFrame([(["a", "b", "c"],)], "t array<string>")
    assert df.select(tx.truncate(F.col("t"), limit)).first()[0] == ["a", "b", "c"][:limit]
