import random

import numpy as np
import pytest

from lectern.llm import decontaminate as d


def naive(text, item, least, blocked):
    """Greedy string tiling by the definition: longest first, then item, then text order."""
    ft, fi = list(blocked), [False] * len(item)
    tiles = []
    while True:
        best = 0
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and not fi[i + n] and not ft[j + n]:
                    n += 1
                best = max(best, n)
        if best < least:
            return tiles
        for i in range(len(item) - best + 1):
            for j in range(len(text) - best + 1):
                if any(fi[i : i + best]) or any(ft[j : j + best]):
                    continue
                if item[i : i + best] == text[j : j + best]:
                    tiles.append((j, i, best))
                    fi[i : i + best] = ft[j : j + best] = [True] * best


@pytest.mark.parametrize("seed", range(40))
def test_tiles(seed):
    rng = random.Random(seed)
    text = [rng.randrange(1, 4) for _ in range(rng.randrange(0, 40))]
    item = [rng.randrange(1, 4) for _ in range(rng.randrange(1, 25))]
    blocked = [rng.random() < 0.1 for _ in text]
    got = d.tile(np.array(text, np.uint64), np.array(item, np.uint64), 2, np.array(blocked, bool))
    assert got == naive(text, item, 2, blocked)


WORDS = [f"w{i}" for i in range(60)]
ITEM = " ".join(WORDS)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, ITEM), (2, "Only Three Tokens"), (3, ""), (4, None), (5, ITEM.upper() + " and more of it " + " ".join(f"z{i}" for i in range(30)))]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_reordered_and_partial_passages(spark, benchmark):
    parts = [" ".join(WORDS[i : i + 20]) for i in (40, 0, 20)]
    docs = [
        (1, "before, " + " -- filler -- ".join(parts) + " after"),
        (2, "some text " + " ".join(WORDS[:31])),
        (3, "some text " + " ".join(WORDS[:29])),
        (4, " ".join(w for i in range(0, 60, 4) for w in (*WORDS[i : i + 4], "x"))),
        (5, "it has only, three TOKENS in it"),
        (6, "it has three only tokens"),
        (7, None),
        (8, ""),
    ]
    got = d.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    found = {(r.doc_id, r.item_id): (r.covered_tokens, r.tiles) for r in got}
    assert found == {(1, 1): (60, 3), (1, 5): (60, 3), (2, 1): (31, 1), (5, 2): (3, 1)}


def test_blocks_and_awkward_rows(awkward, nothing, benchmark):
    whole = sorted(map(tuple, d.contaminated(awkward, awkward, item_key="doc_id").collect()), key=repr)
    assert whole == sorted(map(tuple, d.contaminated(awkward, awkward, item_key="doc_id", block_bytes=1000).collect()), key=repr)
    assert {(r[0], r[1]) for r in whole if r[5] == 1.0} >= {(1, 8), (8, 1), (7, 7), (6, 6), (9, 9), (None, 1)}
    assert d.contaminated(nothing, benchmark).count() == 0
    assert d.contaminated(awkward, benchmark.limit(0)).count() == 0


def test_query_finds_what_contains_an_item(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    contained = {(i, r.item_id) for r in items.collect() for i, t in texts if t and r.text in t}
    got = {(r.doc_id, r.item_id): r.coverage for r in d.contaminated(documents, items).collect()}
    assert contained <= {k for k, v in got.items() if v == 1.0}
