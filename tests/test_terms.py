"""Terms counted where their passage lies, against plain counting."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.functions.text import whitespace_tokens
from lectern.operators import sparse, terms
from lectern.operators.blocks import posting_blocks
from lectern.operators.corpus import dedup_in_order
from lectern.sources.index_store import TableStore

ALL = 1 << 30


def texts_of(n, rare):
    """Some common words, ``rare`` words of its own for each text, a missing text and an empty one."""
    rng = random.Random(5)
    common = [f"w{i}" for i in range(30)]
    made = [" ".join(rng.choices(common, weights=range(30, 0, -1), k=25) + [f"r{i}x{j}" for j in range(rare)]) for i in range(n)]
    return [*made, None, "", "Lone"]


def grams(text):
    words = (text or "").lower().split()
    return words + [" ".join(p) for p in zip(words, words[1:])]


def corpus(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "pid long, text string").repartition(3)


def best_terms(texts, k):
    counts = Counter(w for t in texts for w in grams(t))
    return sorted(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k])


def found_terms(index):
    return sorted((r.term, r.cf) for r in index.vocabulary.collect())


def stored_tables(root):
    return {re.sub(r"_[0-9a-f]{16}-.*", "", p.name) for p in (root / "tables").iterdir() if p.is_dir()}


def test_a_search_stores_neither_postings_nor_weights_nor_rare_counts(spark, tmp_path):
    texts = texts_of(200, 40)
    passages = corpus(spark, texts)
    questions = spark.createDataFrame([(0, "w1 w2 w3"), (1, "w0 r3x1 r3x2"), (2, "zebra")], "qid long, question string")
    tables = sparse.IndexTables(TableStore(spark, str(tmp_path)), {"corpus": "rare"}, buckets=3)
    index = sparse.TfidfIndex(passages, max_features=40, tables=tables)
    assert found_terms(index) == best_terms(texts, 40)
    hits = {(r.qid, r.rank, r.pid, round(r.score, 6)) for r in sparse.retrieve(index, questions, 5).collect()}
    plain = sparse.rank_hits(index.scores(questions), 5)
    assert hits == {(r.qid, r.rank, r.pid, round(r.score, 6)) for r in plain.collect()} and len(hits) == 10
    (counts,) = [p for p in (tmp_path / "tables").iterdir() if p.is_dir() and p.name.startswith("tfidf_counts")]
    assert spark.read.parquet(str(counts)).count() < 1000 < len({w for t in texts for w in grams(t)})


def test_a_search_needs_no_table_by_passage(spark, tmp_path):
    tables = sparse.IndexTables(TableStore(spark, str(tmp_path)), {"corpus": "some"}, buckets=3)
    questions = spark.createDataFrame([(0, "w1 w2 w3")], "qid long, question string")
    assert sparse.retrieve(sparse.TfidfIndex(corpus(spark, texts_of(20, 3)), tables=tables), questions, 5).count() == 5
    assert {re.sub(r"_\d+$", "", t) for t in stored_tables(tmp_path)} == {"tfidf_vocabulary", "tfidf_counts", "tfidf_blocks"}


@pytest.mark.parametrize("slots", [1, 16, 300])
def test_terms_that_share_slots_do_not_move_the_cut(spark, slots, monkeypatch):
    monkeypatch.setattr(terms, "slot", lambda t: F.pmod(F.xxhash64(t), F.lit(slots)).cast("int"))
    texts = texts_of(60, 5)
    for k in (1, 7, 40):
        assert found_terms(sparse.TfidfIndex(corpus(spark, texts), max_features=k)) == best_terms(texts, k)


def test_sketch_counts_every_term(spark):
    texts = texts_of(30, 4)
    passages = corpus(spark, texts)
    sketch = terms.term_sketch(passages, whitespace_tokens, True)
    want = Counter()
    slots = {r.term: r.slot for r in spark.createDataFrame([(w,) for w in {w for t in texts for w in grams(t)}], "term string").withColumn("slot", terms.slot(F.col("term"))).collect()}
    for t in texts:
        want.update(slots[w] for w in grams(t))
    got = {(p << terms.PART_BITS) + int(i): int(sums[i]) for p in sketch.parts for sums in [sketch.sums(p)] for i in np.flatnonzero(sums)}
    assert got == want
    ranked = sorted(want.values(), reverse=True)
    assert [sketch.floor(k) for k in (1, 9, len(want), len(want) + 1 << 20)] == [ranked[0], ranked[8], ranked[-1], 0]


def weights_of(index):
    return {(r.pid, r.term): round(r.w, 9) for r in index.weights.collect()}


@pytest.mark.parametrize("bigrams", [False, True])
def test_weights_are_the_same_for_a_vocabulary_of_any_size(spark, tmp_path, bigrams):
    texts = texts_of(40, 3)
    passages = corpus(spark, texts)
    kinds = [grams(t) if bigrams else (t or "").lower().split() for t in texts]
    df = Counter(w for k in kinds for w in set(k))
    want = {}
    for pid, k in enumerate(kinds):
        raw = {w: n * (math.log((len(texts) + 1) / (df[w] + 1)) + 1) for w, n in Counter(k).items()}
        want |= {(pid, w): round(x / math.sqrt(sum(y * y for y in raw.values())), 9) for w, x in raw.items()}
    tables = sparse.IndexTables(TableStore(spark, str(tmp_path)), {"corpus": "any"}, buckets=3)
    for cap in (50_000, ALL):
        for place in (None, tables):
            assert weights_of(sparse.TfidfIndex(passages, max_features=cap, with_bigrams=bigrams, tables=place)) == pytest.approx(want)


def test_blocks_are_those_of_the_weights(spark):
    index = sparse.TfidfIndex(corpus(spark, texts_of(300, 2)), max_features=200)

    def plain(blocks):
        return sorted((r.shard, r.term, r.block, round(r.bound, 9), tuple(r.pids), tuple(round(x, 9) for x in r.impacts)) for r in blocks.collect())

    made = plain(terms.coded_blocks(index._coded(), index._codes, 2))
    assert made == plain(posting_blocks(index.weights.withColumnRenamed("w", "impact"), 2)) and max(b[2] for b in made) > 0


def test_postings_are_stored_once_and_meet_their_weights_in_place(spark, tmp_path):
    texts = texts_of(40, 3)
    passages = corpus(spark, texts)
    tables = sparse.IndexTables(TableStore(spark, str(tmp_path)), {"corpus": "twice"}, buckets=3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for cap in (ALL, 6):
            index = sparse.TfidfIndex(passages, max_features=cap, with_bigrams=False, tables=tables)
            kept = {r.term for r in index.vocabulary.collect()}
            want = Counter((pid, w) for pid, t in enumerate(texts) for w in (t or "").lower().split() if w in kept)
            got = index.known_postings()
            assert {(r.pid, r.term): r.tf for r in got.collect()} == want
            assert {r.dl for r in got.filter("pid = 3").collect()} == {28}
            assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(p.name.startswith("tfidf_posting") and p.is_dir() for p in (tmp_path / "tables").iterdir()) == 1


def test_texts_move_once_to_meet_their_number(spark):
    rows = [(7, "b"), (7, "b"), (7, "a"), (3, None), (3, None), (9, "a"), (12, "c"), (1, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = dedup_in_order(docs)
    assert [r.text for r in found.orderBy("pid").collect()][:2] == ["c", None]
    assert sorted(map(tuple, found.collect()))[2:] in ([(2, "a"), (3, "b")], [(2, "b"), (3, "a")])
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", found._jdf.queryExecution().executedPlan().toString())
    assert not any("pid#" in keys for keys in moved)
