"""URL filters from association rules.

FP-growth finds combinations of URL tokens that are common and mostly carry the label;
rules are kept by support, confidence and whether a shorter one says as much. An
inverted index by each rule's rarest token finds the rules that match a URL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.tables import written
from lectern.llm.wrappers import host_of

BAD = "label:bad"
# (verdict, host, start of the path)
Rule = tuple[str, str, str]


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: scheme, words of the host and of the path by what they
    are, and names of query fields; a fragment is left out. Digits count as one sign."""
    url = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), "(?s)#.*$", ""), "[0-9]+", "0")
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)

    def named(kind: str, words: Column) -> Column:
        return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(f"{kind}:"), w))

    path = F.split(F.regexp_extract(url, r"(?s)^.*?://[^/?]*(/[^?]*)", 1), r"[/._-]")
    query = F.transform(F.split(F.regexp_extract(url, r"(?s)\?(.*)$", 1), "&"), lambda v: F.regexp_extract(v, "^[^=]*", 0))
    words = F.split(host, r"[.-]")
    return F.array_distinct(F.concat(
        named("scheme", F.array(F.regexp_extract(url, r"^([a-z]+)://", 1))),
        named("host", words), named("end", F.array(F.element_at(words, -1))), named("path", path), named("field", query),
    ))


def mine(
    labelled: DataFrame, url: str = "url", bad: str = "bad", min_rows: int = 30, min_support: float = 0.0005, min_confidence: float = 0.6,
    min_lift: float = 1.5,
) -> DataFrame:
    """(antecedent, confidence, lift, support): rules from URL tokens to the label, from
    rows of ``url`` and a boolean ``bad``; a null label teaches nothing.

    A rule holds in ``min_support`` of the rows and in ``min_rows`` of them at least,
    which also bounds how many there are, and of the rows that match,
    ``min_confidence`` are bad, ``min_lift`` times the share of all rows. A rule goes if another with part of its tokens is as
    confident. Too few rows, an empty table or one class give no rules; other columns are not read."""
    rows = labelled.filter(F.col(bad).isNotNull()).select(tokens(F.col(url)).alias("t"), F.col(bad).alias("bad"))
    rows = written(rows.select(F.when(F.col("bad"), F.concat("t", F.array(F.lit(BAD)))).otherwise(F.col("t")).alias("items")), "url-tokens")
    total = rows.count()
    empty = rows.sparkSession.createDataFrame([], "antecedent array<string>, confidence double, lift double, support double")
    if total < min_rows:
        return empty
    model = FPGrowth(
        itemsCol="items", minSupport=max(min_support, min_rows / total), minConfidence=min_confidence,
        numPartitions=max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))),
    ).fit(rows)
    found = model.associationRules.filter((F.col("consequent") == F.array(F.lit(BAD))) & (F.col("lift") >= min_lift))
    rules = written(found.select(F.array_sort("antecedent").alias("antecedent"), "confidence", "lift", "support"), "url-rules")
    shorter = rules.select(
        F.col("antecedent").alias("part"), F.col("confidence").alias("sure"), F.col("antecedent")[0].alias("token")
    )
    longer = rules.select("antecedent", "confidence", F.explode("antecedent").alias("token"))
    implied = longer.join(shorter, "token").filter(
        (F.size("part") < F.size("antecedent")) & (F.size(F.array_except("part", "antecedent")) == 0) & (F.col("sure") >= F.col("confidence"))
    )
    return rules.join(implied.select("antecedent").distinct(), "antecedent", "left_anti")


def matches(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """(url tokens ``t``, mined, confidence): the surest rule of every different set of
    tokens that has one, ties by the rule's text.

    Token sets are few beside URLs. An empty table or no rules give no rows, and other columns are not read. Each rule is indexed under its rarest token,
    so that a token that is in every URL leads to few rules."""
    sets = urls.select(tokens(F.col(url)).alias("t")).distinct()
    often = sets.select(F.explode("t").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    indexed = (
        rules.withColumn("rule", F.array_join("antecedent", " "))
        .select("rule", "antecedent", "confidence", F.explode("antecedent").alias("token"))
        .join(often, "token")
        .groupBy("rule", "antecedent", "confidence")
        .agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    )
    hits = sets.select("t", F.explode("t").alias("token")).join(indexed, "token").filter(F.size(F.array_except("antecedent", "t")) == 0)
    best = hits.groupBy("t").agg(F.max(F.struct("confidence", "rule")).alias("best"))
    return best.select("t", F.col("best.rule").alias("mined"), F.col("best.confidence").alias("confidence"))


def judge(
    pages: DataFrame, rules: Sequence[Rule], mined: DataFrame, key: str = "page_id", url: str = "url"
) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined, confidence) of every row.

    The longest of the given rules that fits decides: one fits its host and all its
    subdomains where the path starts with the rule's. Where none fits, a mined rule
    blocks, and all else is allowed. A null URL, or one without ``://``, has an empty host and
    path and fits no rule; repeated rows are judged as often."""
    own = pages.select(
        F.col(key).cast("long").alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
        tokens(F.col(url)).alias("t"), given(rules, F.col(url)).alias("given"),
    )
    joined = own.join(matches(pages, mined, url), "t", "left")
    method = F.when(F.col("mined").isNotNull(), "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", F.col("given.rule").alias("rule"), F.coalesce("given.verdict", method).alias("verdict"), "mined", "confidence"
    )


def given(rules: Sequence[Rule], url: Column) -> Column:
    """(rule, verdict) of the longest of the given rules that fits a URL; null fields where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (F.concat(F.lit("."), host_of(url)).endswith(f".{host}")) & path_of(url).startswith(path)
        name, verdict = F.when(fits, host + path).otherwise(name), F.when(fits, says).otherwise(verdict)
    return F.struct(name.alias("rule"), verdict.alias("verdict"))


def taught(pages: DataFrame, rules: Sequence[Rule], labels: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, url, bad): what rules are mined from. Where a given rule decides, its verdict is the label, which does
    speak about URLs; elsewhere it is that of ``labels`` (page_id, bad). Pages with neither teach nothing."""
    own = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), given(rules, F.col(url))["verdict"].alias("verdict"))
    known = own.join(labels, "page_id", "left")
    bad = F.when(F.col("verdict").isNotNull(), F.col("verdict") == "block").otherwise(F.col("bad"))
    return known.select("page_id", "url", bad.alias("bad")).filter("bad is not null")
