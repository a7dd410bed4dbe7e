import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lectern.llm import ngram_lm as lm


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w] + [None]


def brute(train, texts):
    """Interpolated modified Kneser-Ney of bigrams with dictionaries."""
    pairs, words = Counter(), Counter()
    for t in train:
        w = tokens(t)
        words.update(w)
        pairs.update(zip(["<s>", *w], w))
    before = Counter(w for _, w in pairs)
    of = lambda counts: lm.discounts(Counter(min(c, 5) for c in counts.values()))
    d2, d1 = of(pairs), of(before)
    followers = defaultdict(list)
    for (v, _), c in pairs.items():
        followers[v].append(c)
    n_words, total = len(words), sum(words.values())
    left1 = sum(d1[min(k, 3)] for k in before.values())

    def p1(w):
        if not pairs:
            return 1 / (n_words + 1)
        k = before.get(w, 0)
        return (max(k - d1[min(k, 3)], 0) + left1 / (n_words + 1)) / len(pairs)

    def p2(v, w):
        if v not in followers:
            return p1(w)
        c, own = pairs.get((v, w), 0), followers[v]
        return (max(c - d2[min(c, 3)], 0) + sum(d2[min(x, 3)] for x in own) * p1(w)) / sum(own)

    out = []
    for t in texts:
        w = tokens(t)
        base = sum(math.log10((words.get(x, 0) + 0.5) / (total + 0.5 * (n_words + 1))) for x in w)
        out.append((len(w), sum(x in words for x in w), base, sum(math.log10(p2(v, x)) for v, x in zip(["<s>", *w], w))))
    if pairs:  # a distribution, unknown word and all
        for v in [*list(followers)[:5], "never seen"]:
            assert sum(p2(v, x) for x in words) + p2(v, "unknown") == pytest.approx(1)
    return out


def check(spark, train, texts):
    model = lm.fit(spark.createDataFrame([(t,) for t in train], "text string"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(lm.score(docs, model).collect())
    want = brute(train, texts)
    assert model.tokens == sum(len(tokens(t)) for t in train)
    assert [(r.n_tokens, r.n_known) for r in got] == [w[:2] for w in want]
    assert [r.base_score for r in got] == pytest.approx([w[2] for w in want])
    assert [r.score for r in got] == pytest.approx([w[3] for w in want])
    return model


def test_against_brute_force(spark, documents):
    texts = [r.text for r in documents.collect()]
    assert len(check(spark, texts[:120], texts).hot) > 1  # hot contexts are part of what is compared


def test_awkward_rows(spark, awkward, nothing):
    texts = [r.text for r in awkward.collect()]
    check(spark, texts, [*texts, "never seen words", "one never two"])
    check(spark, [], ["some words", None, ""])
    model = lm.fit(nothing)
    assert lm.score(nothing, model).count() == 0
    assert lm.score(awkward, model).count() == awkward.count()


def test_only_mounted_folders():
    assert lm.local_folder("file:///a/b") == "/a/b"
    with pytest.raises(ValueError):
        lm.local_folder("hdfs://name/a")


def test_many_parts(spark, monkeypatch):
    """Parts and rows of every size: contexts over several rows, a pair of many times, empty parts."""
    monkeypatch.setattr(lm, "PART_TOKENS", 2000)
    monkeypatch.setattr(lm, "PART_TYPES", 100)
    wide = " ".join(f"a w{i} b w{i % 70}" for i in range(1000))
    texts = [wide, "again " * 70_000, None, "", *[f"rare{i} a w{i} c{i % 7}" for i in range(300)]]
    model = check(spark, texts, [*texts, "a w3 never", "never a w3"])
    assert model.parts > 30 and model.word_parts > 10


@pytest.fixture(scope="module")
def long_batch():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60_000)]
    texts = [" ".join(rng.choices(words, k=500)) for _ in range(4000)]
    return pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])


HOT = np.array([lm.BEGIN], np.uint64)


def peak(run):
    tracemalloc.start()
    n = sum(out.num_rows for out in run)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n
    return most


def test_counting_holds_little_next_to_its_batch(long_batch):
    assert peak(lm._count_words(iter([long_batch]))) < 64 << 20
    assert peak(lm._count_pairs(HOT, 8)(iter([long_batch]))) < 80 << 20


def test_a_batch_of_pairs_is_small(long_batch):
    """Spark puts up to 10,000 rows in a batch, for the JVM and for Python."""
    out = [*lm._count_pairs(HOT, 8)(iter([long_batch]))]
    sizes = [sum(len(r[c]) for c in ("contexts", "lengths", "words", "counts")) for b in out for r in b.to_pylist()]
    assert 10_000 * max(sizes) < 16 << 20


def test_storing_a_part_holds_little(long_batch, tmp_path):
    """A part of about ``PART_TOKENS`` tokens, in batches as Spark makes them."""
    rows = pa.Table.from_batches([*lm._count_pairs(HOT, 1)(iter([long_batch]))]).combine_chunks()
    assert peak(lm._store_pairs(str(tmp_path), HOT)(iter(rows.to_batches(10_000)))) < 165 << 20


def test_parts_never_share_a_task(long_batch, tmp_path):
    with pytest.raises(ValueError, match="parts"):
        [*lm._store_pairs(str(tmp_path), HOT)(lm._count_pairs(HOT, 2)(iter([long_batch])))]
    words = pa.RecordBatch.from_pydict({"h": [1, 2], "n": [1, 1], "kinds": [1, 1], "part": pa.array([0, 1], pa.int32())})
    with pytest.raises(ValueError, match="parts"):
        [*lm._store_words(str(tmp_path))(iter([words]))]
