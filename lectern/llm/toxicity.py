"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features are rates of a text: words of fixed and learned lexicons, second-person
words near them, capitals, punctuation and obfuscated spellings. Three disjoint sets
of labelled rows are used: one learns the lexicons, one grows the trees, and one
calibrates their margin to a probability."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.kernels import chunks, text_bytes
from lectern.llm.ngram_lm import fold
from lectern.llm.tables import written

# fixed values: common insults, and words that address a reader
INSULTS = frozenset(
    "asshole bastard bitch crap cretin damn disgusting dumb fool freak garbage hate hell idiot idiots imbecile jerk kill "
    "loser losers lunatic moron morons nasty pathetic pig rat scum shit shut stupid sucker trash ugly vermin worthless".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi vous votre usted ti tus".split())

NEAR = 5
STEM = 4
_MARKS = ".,!?;:\"()"
FEATURES = (
    "insults", "learned", "learned_weight", "stems", "stem_weight", "strongest", "near_you", "you", "capitals", "exclaims",
    "questions", "punctuation", "digits", "obfuscated", "log_words",
)
_TERMS = "term string, toxic long, clean long"
_LEAST_TOXIC = 4

LETTER, OBFUSCATING, CAPITAL, PUNCTUATION = (np.zeros(256, bool) for _ in range(4))
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
CAPITAL[65:91] = True
for _mark in b"0123456789@$*#!|+":
    OBFUSCATING[_mark] = True
for _mark in b"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~":
    PUNCTUATION[_mark] = True


def plain_words(text: str) -> list[str]:
    """Lower-cased words without the usual marks at their ends."""
    text = text.lower()
    for mark in _MARKS:
        text = text.replace(mark, " ")
    return text.split()


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: tuple[Counter, Counter] = (Counter(), Counter())

    def table() -> pa.RecordBatch:
        terms = list(seen[0].keys() | seen[1].keys())
        columns = [pa.array(terms, pa.string()), *(pa.array([seen[i][t] for t in terms], pa.int64()) for i in (1, 0))]
        return pa.RecordBatch.from_arrays(columns, names=["term", "toxic", "clean"])

    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            words = set(plain_words(text.as_py() or ""))
            seen[toxic].update(words)
            seen[toxic].update({w[:STEM] + "*" for w in words if len(w) > STEM})
            if sum(map(len, seen)) > 1_000_000:
                yield table()
                for counts in seen:
                    counts.clear()
    if any(seen):
        yield table()


def learn_lexicon(labelled: DataFrame, size: int = 5000) -> dict[str, float]:
    """term → log odds of the ``size`` words and stems (``abcd*``) that tell toxic rows of
    ``labelled`` (text, toxic) best: those in four toxic rows or more and with odds of
    three to one at least, by their smoothed log odds over the number of rows."""
    n = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    counts = labelled.select("text", "toxic").mapInArrow(_count_terms, _TERMS)
    summed = counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    best = (
        summed.filter(F.col("toxic") >= _LEAST_TOXIC)
        .withColumn("weight", odds)
        .filter(F.col("weight") >= math.log(3))
        .orderBy(F.col("weight").desc(), F.col("toxic").desc(), "term")
        .limit(size)
    )
    return {r["term"]: float(r["weight"]) for r in best.collect()}


def _byte_counts(texts: pa.Array) -> np.ndarray:
    """Per text: capitals, exclamation marks, question marks, punctuation, digits,
    letters split by an obfuscating sign, letters."""
    raw, offsets = text_bytes(texts)
    letter, odd = LETTER[raw], OBFUSCATING[raw]
    split = np.zeros(len(raw), bool)
    if len(raw) > 2:
        split[1:-1] = letter[:-2] & odd[1:-1] & letter[2:]
        seams = offsets[1:-1]  # the letters are of one text
        split[seams[seams < len(raw)]] = split[seams[seams > 0] - 1] = False
    masks = (CAPITAL[raw], raw == 33, raw == 63, PUNCTUATION[raw], (raw >= 48) & (raw <= 57), split, letter)
    sums = (np.concatenate([[0], np.cumsum(m)]) for m in masks)
    return np.stack([s[offsets[1:]] - s[offsets[:-1]] for s in sums], axis=1)


def _features(words: dict[str, float], stems: dict[str, float]):
    bad = INSULTS | words.keys()

    def one(text: str) -> list[float]:
        tokens = plain_words(text)
        n = max(len(tokens), 1)
        kinds = Counter(tokens)
        hits = {w: kinds[w] for w in kinds.keys() & bad}
        stemmed = {w: c for w, c in kinds.items() if w[:STEM] in stems and len(w) > STEM}
        learned = {w: c for w, c in hits.items() if w in words}
        near = you = 0
        if not SECOND_PERSON.isdisjoint(kinds):
            at = [i for i, w in enumerate(tokens) if w in SECOND_PERSON]
            you = len(at)
            if hits or stemmed:
                spots = np.array([i for i, w in enumerate(tokens) if w in hits or w in stemmed])
                gaps = np.abs(np.array(at)[:, None] - spots[_around(spots, at)]).min(axis=1)
                near = int((gaps <= NEAR).sum())
        weights = [words[w] for w in learned] + [stems[w[:STEM]] for w in stemmed]
        return [
            sum(c for w, c in hits.items() if w in INSULTS) / n,
            sum(learned.values()) / n,
            sum(words[w] * c for w, c in learned.items()) / n,
            sum(stemmed.values()) / n,
            sum(stems[w[:STEM]] * c for w, c in stemmed.items()) / n,
            max(weights, default=0.0), near / n, you / n, len(tokens),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in chunks(batch.column(1)):
                lexical = np.array([one(t or "") for t in part.to_pylist()]).reshape(-1, 9)
                counts = _byte_counts(part)
                letters, n = np.maximum(counts[:, 6], 1), np.maximum(lexical[:, 8], 1)
                rates = [
                    *lexical[:, :8].T, counts[:, 0] / letters, *(counts[:, 1:6] / n[:, None]).T, np.log1p(lexical[:, 8]),
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), *(pa.array(np.asarray(r, np.float64)) for r in rates)],
                    names=["doc_id", *FEATURES],
                )

    return run


def _around(spots: np.ndarray, at: list[int]) -> np.ndarray:
    """Indices of the places before and after each of ``at``."""
    after = np.searchsorted(spots, at)
    return np.stack([np.maximum(after - 1, 0), np.minimum(after, len(spots) - 1)], axis=1)


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    prior: float

    def features(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """(doc_id, one column per feature) of every row."""
        words = {t: w for t, w in self.lexicon.items() if not t.endswith("*")}
        stems = {t[:-1]: w for t, w in self.lexicon.items() if t.endswith("*")}
        own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
        return own.mapInArrow(_features(words, stems), ", ".join(["doc_id long", *(f"{f} double" for f in FEATURES)]))

    def margin(self, features: DataFrame) -> DataFrame:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features)
        scored = self.trees.transform(vectors)
        return scored.withColumn("margin", vector_to_array("rawPrediction")[1])

    def score(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """(doc_id, score) of every row; a null text scores as an empty one, repeated rows alike, a long text as a
        whole, and an empty table gives no rows."""
        found = self.features(docs, key, text)
        if self.trees is None or self.calibration is None:
            return found.select("doc_id", F.lit(self.prior).alias("score"))
        calibrated = self.calibration.transform(self.margin(found).select("doc_id", "margin"))
        return calibrated.select("doc_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "calibrated")).alias("score"))


def _sample(labels: DataFrame, seed: int, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, by a hash of the id."""
    return labels.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "toxic").limit(rows)


def fit(
    docs: DataFrame, labels: DataFrame, part: Column, max_rows: int = 20_000, lexicon_size: int = 5000, trees: int = 30,
    depth: int = 4, seed: int = 11, key: str = "doc_id", text: str = "text",
) -> ToxicityModel:
    """Learn from ``labels`` (doc_id, toxic), of which ``part``, a column over
    ``doc_id``, says the set: 0 for the lexicons, 1 for the trees, 2 for the
    calibration, others are not read.

    Every set is cut to ``max_rows`` rows drawn by a hash, which is the documented bound of
    what is fitted on; the sample of ids is therefore small enough to meet the documents by
    broadcast. Rows without a label or without a document teach nothing; an id that is
    repeated counts as often. With only one class in a set there are no trees, and every
    text scores the share of toxic rows (0 without any)."""
    known = labels.select(F.col(key).cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    parts = [_sample(known.filter(part == i), seed, max_rows).withColumn("part", F.lit(i)) for i in range(3)]
    drawn = parts[0].unionByName(parts[1]).unionByName(parts[2])
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = own.join(F.broadcast(written(drawn, "labels")), "doc_id")
    taught = written(rows, "labelled")
    prior = taught.agg(F.avg("toxic")).first()[0] or 0.0
    model = ToxicityModel(learn_lexicon(taught.filter("part = 0"), lexicon_size), None, None, float(prior))
    measured = model.features(taught.filter("part > 0").select("doc_id", "text").distinct())
    table = written(measured.join(taught.filter("part > 0").select("doc_id", "toxic", "part").distinct(), "doc_id"), "features")
    grow, tune = (table.filter(F.col("part") == i).withColumn("label", F.col("toxic").cast("double")) for i in (1, 2))
    if any(t.select("label").distinct().count() < 2 for t in (grow, tune)):
        return model
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(grow).select("features", "label")
    classifier = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, minInstancesPerNode=5, seed=seed)
    model.trees = classifier.fit(vectors.coalesce(8))
    points = model.margin(tune).select("margin", "label")
    model.calibration = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="calibrated").fit(points)
    return model


def production_part(key: str = "doc_id") -> Column:
    """The sets of the registered query: remainder 0 learns words, remainder 2 is divided into trees
    and calibration by another checksum, remainder 1 is held out."""
    again = F.crc32(F.concat(F.col(key).cast("string"), F.lit(":tune")).cast("binary")) % 10
    rest = fold(key, 3)
    return F.when(rest == 0, 0).when(rest == 2, F.when(again < 7, 1).otherwise(2)).otherwise(3)
