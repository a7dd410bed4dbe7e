"""Rule bitmask ledger: every quality rule is evaluated once.

The ledger holds a document's measurements and one failure bit per rule. A policy is
a version name and a set of bits, so policies are applied, compared and taken apart
on the ledger alone, without the texts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_GAP = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"
_SYMBOL = r"[#*$%&|<>]"
WINDOW = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_capitals", "n_echoes")


@dataclass(frozen=True)
class Rule:
    """Fails where ``broken`` holds for the measurements. The bit never changes."""

    name: str
    bit: int
    broken: Callable[[], Column]


def _c(name: str) -> Column:
    return F.col(name)


RULES = (
    Rule("few_words", 0, lambda: _c("n_words") < 10),
    Rule("repeated_words", 1, lambda: _c("n_repeat_words") * 100 > _c("n_words") * 20),
    Rule("repeated_lines", 2, lambda: _c("n_dup_lines") * 2 > _c("n_lines")),
    Rule("symbols", 3, lambda: _c("n_symbols") * 10 > _c("n_words")),
    Rule("short_words", 4, lambda: _c("word_chars") < _c("n_words") * 2),
    Rule("long_words", 5, lambda: _c("word_chars") > _c("n_words") * 25),
    Rule("few_letters", 6, lambda: _c("n_letters") * 2 < _c("word_chars")),
    Rule("capitals", 7, lambda: _c("n_capitals") * 10 > _c("n_letters") * 6),
    Rule("echoes", 8, lambda: _c("n_echoes") * 100 > _c("n_words") * 30),
)
BITS = {rule.name: 1 << rule.bit for rule in RULES}
BASE = BITS["few_words"] | BITS["repeated_words"]

POLICIES = {
    "base": BASE,
    "v1": BASE | BITS["repeated_lines"] | BITS["symbols"],
    "v2": sum(BITS.values()),
}


def _repeat_words(n: Column) -> Column:
    """Words inside windows that occur twice: places of such windows in order, each
    adding what the one before does not cover."""
    places = F.col("_places")
    step = F.transform(places, lambda p, k: F.least(F.lit(WINDOW), F.get(places, k + 1) - p))
    total = F.aggregate(F.slice(step, 1, F.greatest(F.size(places) - 1, F.lit(0))), F.lit(0), lambda a, b: a + b)
    return F.when(F.size(places) > 0, total + WINDOW).otherwise(0)


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, the measurements, fail_bits) for every row; ``key`` may be any column.

    Words are runs without white space. ``n_repeat_words`` counts the words that lie in a
    five-word window found twice or more in the text, ``n_echoes`` those equal to the word before. A null text is empty: no words, no lines
    with a word. Repeated rows are judged as often as they occur. All work is in the row: windows
    are compared by 64-bit hashes, sorted only in texts that repeat one, so a long text
    costs n log n and nothing is shuffled."""
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), _GAP), "")
    line = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda v: v.rlike(_WORD))
    read = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"), words.alias("_words"), line.alias("_lines"))
    counted = read.select(
        key,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(_SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("_text", r"\P{L}+", "")).cast("long").alias("n_letters"),
        F.length(F.regexp_replace("_text", r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    h = F.col("_h")
    window = F.transform(
        F.sequence(F.lit(0), F.size("_h") - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW)])
    )
    echoes = F.size(F.filter(h, lambda v, i: F.get(h, i - 1).eqNullSafe(v))).cast("long")
    windowed = counted.withColumn("n_echoes", echoes).withColumn("_w", F.when(F.size("_h") >= WINDOW, window).otherwise(F.array().cast("array<bigint>"))).drop("_h")
    repeats = F.size(F.array_distinct("_w")) < F.size("_w")
    by_hash = F.sort_array(F.transform("_w", lambda v, i: F.struct(v.alias("h"), i.alias("i"))))
    ordered = windowed.withColumn("_s", F.when(repeats, by_hash)).drop("_w")
    s = F.col("_s")
    twice = F.filter(
        F.transform(
            F.col("_s"),
            lambda v, k: F.when(
                F.get(s, k - 1)["h"].eqNullSafe(v["h"]) | F.get(s, k + 1)["h"].eqNullSafe(v["h"]), v["i"]
            ),
        ),
        lambda v: v.isNotNull(),
    )
    placed = ordered.withColumn("_places", F.coalesce(F.sort_array(twice), F.array().cast("array<int>"))).drop("_s")
    measured = placed.withColumn("n_repeat_words", _repeat_words(F.col("n_words")).cast("long"))
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(rule.broken(), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    # a generator is a wall for filters: pushed below it they would evaluate the rules again
    return measured.select(key, F.inline(F.array(F.struct(*MEASURES, bits.alias("fail_bits")))))


def fails(policy: str | int, bits: str = "fail_bits") -> Column:
    """The bits of a ledger row that count under a policy, by name or as a mask."""
    return F.col(bits).bitwiseAND(F.lit(POLICIES[policy] if isinstance(policy, str) else policy))


def judged(book: DataFrame, policy: str | int) -> DataFrame:
    """The ledger with ``base_failed``, ``kept`` and ``sole_bit``: the one bit without
    which the policy would keep the row, 0 where there is none or several."""
    failed = fails(policy)
    return book.withColumns(
        {
            "base_failed": fails(BASE) != 0,
            "kept": (failed == 0) & (fails(BASE) == 0),
            "sole_bit": F.when(F.bit_count(failed) == 1, failed).otherwise(F.lit(0).cast("long")),
        }
    )


def ablation(book: DataFrame, policy: str | int) -> DataFrame:
    """(rule, failed, only, kept_without): per rule of the policy the rows and words it
    fails, those it alone fails, and the rows kept if it were taken out.

    Rows are first counted per combination of bits, of which there are at most two to
    the number of rules; everything else is arithmetic on those few counts."""
    by_bits = book.select(fails(policy).alias("bits")).groupBy("bits").agg(F.count("*").alias("n"))
    named = [F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in RULES]
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    crossed = by_bits.select("bits", "n", F.explode(F.array(*named)).alias("r")).select("bits", "n", "r.*")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return (
        crossed.filter(F.col("bit").bitwiseAND(F.lit(mask)) != 0)
        .groupBy("rule")
        .agg(
            F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("failed"),
            F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n"))), F.lit(0)).alias("only"),
            F.coalesce(F.sum(F.when((F.col("bits") == 0) | (F.col("bits") == F.col("bit")), F.col("n"))), F.lit(0)).alias("kept_without"),
        )
    )


def kept_documents(docs: DataFrame, policy: str | int, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that a policy keeps, all columns as they are. Rows are carried
    through the ledger whole, so neither ids nor the names of other columns matter."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"))
    return judged(ledger(whole, "row", "text"), policy).filter("kept").select("row.*")
