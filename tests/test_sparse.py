import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lectern.operators import blocks, sparse
from lectern.sources.index_store import TableStore

TEXTS = ["the cat sat", "the dog sat on the cat", "a bird", "", "the the the", "cat bird dog bird"]
QUESTIONS = ["cat cat bird", "the", "zebra", "dog sat"]


@pytest.fixture()
def given(spark):
    passages = spark.createDataFrame(list(enumerate(TEXTS)), "pid long, text string")
    questions = spark.createDataFrame(list(enumerate(QUESTIONS)), "qid long, question string")
    return passages, questions


def python_bm25(question):
    docs = [t.split() for t in TEXTS]
    n, avgdl = len(docs), sum(map(len, docs)) / len(docs)
    df = Counter(w for d in docs for w in set(d))
    idf = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {w: floor if v < 0 else v for w, v in idf.items()}
    out = {}
    for pid, d in enumerate(docs):
        tf = Counter(d)
        if any(w in tf for w in question.split()):
            out[pid] = sum(
                idf.get(w, 0) * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(d) / avgdl)) for w in question.split()
            )
    return out


def ranked(scores, k):
    return sorted(((round(s, 6), p) for p, s in scores.items()), key=lambda t: (-t[0], t[1]))[:k]


def rows(df):
    out = {}
    for r in df.orderBy("qid", "rank").collect():
        out.setdefault(r.qid, []).append((r.score, r.pid))
    return out


def test_bm25(given):
    passages, questions = given
    got = rows(sparse.retrieve(sparse.Bm25Index(passages), questions, 3))
    for qid, question in enumerate(QUESTIONS):
        assert got.get(qid, []) == ranked(python_bm25(question), 3)


@pytest.mark.parametrize("method", ["bm25", "tfidf"])
def test_large_question_tables_give_the_same(given, method, monkeypatch):
    passages, questions = given
    small = rows(sparse.retrieve(sparse.build_index(method, passages), questions, 4))
    monkeypatch.setattr(sparse, "fits_broadcast", lambda df: False)
    assert rows(sparse.retrieve(sparse.build_index(method, passages), questions, 4)) == small


def test_stored_index_gives_the_same_without_shuffling_postings(spark, given, tmp_path):
    passages, questions = given
    tables = sparse.IndexTables(TableStore(spark, str(tmp_path)), {"corpus": "test"}, buckets=3)
    fresh = sparse.retrieve(sparse.Bm25Index(passages), questions, 3)
    stored = sparse.retrieve(sparse.Bm25Index(passages, tables=tables), questions, 3)
    assert rows(stored) == rows(fresh)
    plan = sparse.Bm25Index(passages, tables=tables).scores(questions)._jdf.queryExecution().executedPlan().toString()
    head = plan.split("FileScan")[0]
    assert "Exchange hashpartitioning(pid" not in head


def test_parameters_have_their_own_tables(spark, given, tmp_path):
    passages, questions = given
    tables = sparse.IndexTables(TableStore(spark, str(tmp_path)), {"corpus": "test"})
    for size, bigrams in ((50_000, True), (5, False)):
        stored = sparse.TfidfIndex(passages, max_features=size, with_bigrams=bigrams, tables=tables)
        fresh = sparse.TfidfIndex(passages, max_features=size, with_bigrams=bigrams)
        assert sorted(stored.vocabulary.collect()) == sorted(fresh.vocabulary.collect())
        assert rows(sparse.retrieve(stored, questions, 3)) == rows(sparse.retrieve(fresh, questions, 3))


def test_nested_topk(given):
    passages, questions = given
    index = sparse.TfidfIndex(passages)
    two, four = rows(sparse.retrieve(index, questions, 2)), rows(sparse.retrieve(index, questions, 4))
    assert all(four[q][: len(h)] == h for q, h in two.items())


def test_fill_completes_every_list(given):
    passages, questions = given
    index = sparse.Bm25Index(passages)
    bare, full = rows(sparse.retrieve(index, questions, 4)), rows(sparse.retrieve(index, questions, 4, fill=True))
    for qid in range(len(QUESTIONS)):
        hits = bare.get(qid, [])
        unused = [p for p in range(len(TEXTS)) if p not in {p for _, p in hits}]
        assert full[qid] == hits + [(0.0, p) for p in unused][: 4 - len(hits)]
    everything = rows(sparse.retrieve(index, questions, 50, fill=True))
    assert all(sorted(p for _, p in r) == list(range(len(TEXTS))) for r in everything.values())


def test_unknown_method(given):
    with pytest.raises(ValueError):
        sparse.build_index("dense", given[0])


def test_vocabulary_cap(given):
    vocabulary = sparse.TfidfIndex(given[0], max_features=2).vocabulary
    assert sorted((r.term, r.cf) for r in vocabulary.collect()) == [("bird", 3), ("the", 6)]  # bird before cat: equal counts go by term


def lists_of(rng, n, terms, weights):
    """Posting lists over ``n`` places in blocks of four, and the plain sums of a question."""
    lists, sums, held = [], np.zeros(n), np.zeros(n, bool)
    for _ in range(terms):
        places = np.flatnonzero(rng.random(n) < rng.choice([0.02, 0.3, 0.9]))
        if not len(places):
            continue
        impacts = np.round(rng.random(len(places)) ** 3, 2) + (0.01 if weights else 0)
        starts = np.append(np.arange(0, len(places), 4), len(places))
        bounds = np.array([impacts[a:b].max() for a, b in zip(starts, starts[1:])])
        weight = rng.choice([0.1, 1.0, 5.0]) if weights else rng.choice([-1.0, 1.0])
        lists.append((weight, blocks.PostingList(places, impacts, starts, places[starts[1:] - 1], bounds)))
        sums[places] += weight * impacts
        held[places] = True
    return lists, sums, held


@pytest.mark.parametrize("weights", [True, False])
def test_pruned_search_equals_all_sums(weights):
    rng = np.random.default_rng(4)
    visited, postings = [0], 0
    for _ in range(300):
        n, k = int(rng.integers(1, 400)), int(rng.integers(1, 12))
        lists, sums, held = lists_of(rng, n, int(rng.integers(1, 9)), weights)
        if not lists:
            continue
        places, scores = blocks.best_passages(lists, n, k, visited)
        postings += sum(len(x.places) for _, x in lists)
        want = sorted(((-round(s, 6), p) for p, s in enumerate(sums) if held[p]))[:k]
        assert sorted((-round(s, 6), p) for p, s in zip(places, scores))[:k] == want
    assert visited[0] < (0.8 if weights else 1.01) * postings


def test_search_sends_k_passages_a_question_and_shard(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(80)]
    texts = [(i, " ".join(rng.choices(words, [1 / (j + 1) for j in range(80)], k=rng.randrange(1, 60)))) for i in range(600)]
    passages = spark.createDataFrame(texts, "pid long, text string")
    questions = spark.createDataFrame([(i, " ".join(rng.sample(words, 6))) for i in range(40)], "qid long, question string")
    for method in ("bm25", "tfidf"):
        index = sparse.build_index(method, passages)
        hits = index.search(questions, 5)
        per_shard = hits.groupBy("qid").count().agg({"count": "max"}).first()[0]
        assert per_shard <= 5 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        plan = sparse.retrieve(index, questions, 5)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"HashAggregate\(keys=\[pid#\d+L?, qid", plan) and "FlatMapGroupsInArrow" in plan
        plain = sparse.rank_hits(index.scores(questions), 5).select("qid", "rank", "pid", "score")
        assert rows(sparse.retrieve(index, questions, 5)) == rows(plain)


def test_stored_blocks_stay_where_they_are(spark, given, tmp_path):
    passages, questions = given
    tables = sparse.IndexTables(TableStore(spark, str(tmp_path)), {"corpus": "blocks"}, buckets=3)
    for method in ("bm25", "tfidf"):
        index = sparse.build_index(method, passages, tables=tables)
        fresh = rows(sparse.retrieve(sparse.build_index(method, passages), questions, 3))
        assert rows(sparse.retrieve(index, questions, 3)) == fresh
        plan = index.search(questions, 3)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(shard" not in plan and "Bucketed: true" in plan
