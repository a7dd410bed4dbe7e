import math
import random

import pytest
from pyspark.sql import functions as F

from lectern.llm import toxicity
from lectern.llm.ngram_lm import fold


@pytest.fixture(scope="module")
def corpus(spark):
    """Toxic texts hold words of a made-up language of insults; labels only for some."""
    rng = random.Random(4)
    plain, bad = [f"word{i}" for i in range(400)], ["gralk", "snorvig", "blethak", "grenchel"]
    docs, labels = [], []
    for i in range(3000):
        toxic = rng.random() < 0.15
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 80))]
        for _ in range(rng.randrange(2, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    model = toxicity.fit(docs, labels, toxicity.production_part(), trees=10)
    assert {"gralk", "snorvig", "blethak", "grenchel"} <= model.lexicon.keys()
    held = model.score(docs).filter(fold("doc_id", 3) == 1).join(labels, "doc_id").collect()
    caught = [r.score >= 0.7 for r in held if r.toxic]
    wrong = [r.score >= 0.7 for r in held if not r.toxic]
    assert sum(caught) > 0.95 * len(caught) and sum(wrong) < 0.02 * len(wrong)
    assert all(0 <= r.score <= 1 for r in held)


def test_held_out_labels_teach_nothing(corpus):
    docs, labels = corpus
    turned = labels.withColumn("toxic", F.when(fold("doc_id", 3) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(docs, given, toxicity.production_part(), trees=3) for given in (labels, turned))
    assert a.lexicon == b.lexicon
    assert sorted(a.score(docs).collect()) == sorted(b.score(docs).collect())


def test_awkward_rows(corpus, awkward, nothing):
    docs, labels = corpus
    model = toxicity.fit(docs, labels, toxicity.production_part(), trees=3)
    got = model.score(awkward).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 for r in got)
    assert model.score(nothing).count() == 0
    for some in (labels.limit(0), labels.filter("toxic = 0")):
        flat = toxicity.fit(docs, some, toxicity.production_part())
        assert {r.score for r in flat.score(awkward).collect()} == {0.0}


def test_bytes_are_counted_per_text():
    import pyarrow as pa

    got = toxicity._byte_counts(pa.array(["Ab! c?", "", None, "s@d 1d10t x2"]))
    assert got[0].tolist() == [1, 1, 1, 2, 0, 0, 3]
    assert got[1].tolist() == got[2].tolist() == [0] * 7
    assert got[3].tolist()[4:] == [4, 1, 5]  # one sign between letters, as in s@d


def plain_features(text, words, stems):
    """The features by their definitions."""
    tokens = text.lower()
    for mark in ".,!?;:\"()":
        tokens = tokens.replace(mark, " ")
    tokens = tokens.split()
    n, letters = max(len(tokens), 1), [c for c in text.encode() if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128]
    learned = [t for t in tokens if t in words]
    stemmed = [t for t in tokens if len(t) > 4 and t[:4] in stems]
    spots = [i for i, t in enumerate(tokens) if t in words or t in toxicity.INSULTS or (len(t) > 4 and t[:4] in stems)]
    you = [i for i, t in enumerate(tokens) if t in toxicity.SECOND_PERSON]
    data = text.encode()
    split = sum(data[i] in b"0123456789@$*#!|+" and toxicity.LETTER[data[i - 1]] and toxicity.LETTER[data[i + 1]] for i in range(1, len(data) - 1))
    punctuation = sum(c in b"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~" for c in data)
    return [
        sum(t in toxicity.INSULTS for t in tokens) / n, len(learned) / n, sum(words[t] for t in learned) / n, len(stemmed) / n,
        sum(stems[t[:4]] for t in stemmed) / n, max([words[t] for t in learned] + [stems[t[:4]] for t in stemmed], default=0.0),
        sum(any(abs(i - j) <= 5 for j in spots) for i in you) / n, len(you) / n, sum(65 <= c <= 90 for c in data) / max(len(letters), 1),
        data.count(b"!") / n, data.count(b"?") / n, punctuation / n, sum(48 <= c <= 57 for c in data) / n, split / n, math.log1p(len(tokens)),
    ]


def test_features_by_definition(spark):
    rng = random.Random(8)
    words, stems = {"gralk": 1.5, "ugly": 2.0, "du": 0.7}, {"snor": 1.2, "idio": 3.0}
    parts = ["you", "DU", "ugly", "Gralk!", "snorvig", "snor", "idiot,", "idiotic", "plain", "w0rd", "f@ol", "ÜBER", "a", "(you)", "?", "!!", "1|2", "your"]
    texts = [" ".join(rng.choices(parts, k=rng.randrange(0, 40))) for _ in range(150)] + ["", "x!y", "!", "@a@"]
    model = toxicity.ToxicityModel({**words, **{f"{t}*": w for t, w in stems.items()}}, None, None, 0.0)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in model.features(docs).collect():
        assert [r[f] for f in toxicity.FEATURES] == pytest.approx(plain_features(texts[r.doc_id], words, stems)), texts[r.doc_id]
