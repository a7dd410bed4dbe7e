import random
import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

from lectern.llm import minhash
from lectern.llm.components import components
from lectern.llm.kernels import WordHasher
from lectern.llm.minhash import band_keys, near_duplicates, shingle_set, signatures
from lectern.session import shared_dir

import pyarrow as pa


def shingles(text, k=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if None not in (i, j) and x and y and 100 * len(x & y) >= 75 * len(x | y):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


def edited(rng, words, share):
    return [f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    """Copies, chains of edits, near misses, and many documents that only share a passage."""
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 8, 60, 200]))]
        rows += [(n + i, " ".join(edited(rng, base, rng.choice([0, 0.01, 0.03, 0.06])))) for i in range(8)]
        n += 8
    chain = [f"c{i}" for i in range(120)]
    for i in range(12):
        chain = chain[3:] + [f"c{n}_{i}_{j}" for j in range(3)]
        rows.append((n + i, " ".join(chain)))
    n += 12
    passage = [f"p{i}" for i in range(60)]
    rows += [(n + i, " ".join([*passage, *(f"q{i}_{j}" for j in range(40))])) for i in range(40)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("own, linked", [(10, False), (6, False), (5, True)])
def test_no_pair_is_compared_twice(spark, monkeypatch, own, linked):
    """Documents of shared paragraphs: with 30 of 40 or 34 of 40 they are too far apart, with 35 of 40 linked."""
    seen = []
    compared = minhash._compared
    monkeypatch.setattr(minhash, "_compared", lambda p, *a: seen.extend((min(r.p, r.x), max(r.p, r.x)) for r in p.collect()) or compared(p, *a))
    shared = [" ".join(f"s{i}_{j}" for j in range(12)) for i in range(40 - own)]
    docs = [(d, "\n".join(shared + [" ".join(f"o{d}_{i}_{j}" for j in range(12)) for i in range(own)])) for d in range(400)]
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == ({0} if linked else set(range(400)))
    assert len(seen) == len(set(seen)) and len(seen) < 400 * 60


def test_only_the_result_is_left(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    folder = Path(shared_dir(spark)) / "llm"
    before = {p.name for p in folder.glob("*")}
    assert near_duplicates(docs).count() == docs.count()
    assert sorted(p.name.split("-")[0] for p in folder.iterdir() if p.name not in before) == ["classes", "signatures"]


def test_awkward_rows(awkward, nothing):
    got = near_duplicates(awkward).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute([(r.doc_id, r.text) for r in awkward.collect()])
    assert all(r.kept for r in got if r.doc_id is None)
    assert near_duplicates(nothing).count() == 0


def test_coordinates_estimate_the_overlap():
    rng = np.random.default_rng(5)
    whole = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    for shared in (0.25, 0.5, 0.75):
        cut = int(3000 * (1 - shared) / 2)
        a, b = whole[: 3000 - cut], whole[cut:]
        sig = signatures([a, b], 2000)
        assert (sig[0] == sig[1]).mean() == pytest.approx((3000 - 2 * cut) / 3000, abs=0.05)


def test_signatures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(6)
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1, 5, 70_000, 3, 150_000, 2)]
    together = signatures(sets, 24)
    assert all((signatures([s], 24)[0] == together[i]).all() for i, s in enumerate(sets))
    assert band_keys(together, 3).shape == (6, 8)


def test_word_hashes_equal_only_for_equal_words():
    texts = pa.array(["Ab ab\tAB", "b a", None, "", "ab", "é É", "ab" * 3_000_000 + " ab"])
    got = {i: h.tolist() for i, h in WordHasher()(texts)}
    assert len(got[0]) == 3 and len(set(got[0])) == 1 and got[0][0] == got[4][0] == got[6][1]
    assert got[2] == got[3] == [] and len(set(got[1])) == 2 and got[5][0] != got[5][1]
    assert len(shingle_set(np.array([1, 2], np.uint64), 5)) == 1


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(1000, 1060)]
    parent = defaultdict(set)
    for a, b in edges:
        parent[a].add(b)
        parent[b].add(a)
    want = {}
    for node in sorted(parent):
        todo = [node]
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = node
                todo += parent[x]
    want = {n: w for n, w in want.items() if parent[n] - {n}}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
