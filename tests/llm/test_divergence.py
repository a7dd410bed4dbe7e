import random
import re
from collections import Counter

import numpy as np
import pytest

from compare import compare
from lectern.llm import divergence
from lectern.llm.divergence import audit, skyband, term_counts

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(docs, least, k=50):
    """The audit by its definition, from (text, lang, source)."""
    counts, langs, seen = {}, {}, {}
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        terms = Counter(TERM.findall((text or "").translate(LOWER)))
        counts.setdefault((lang, source), Counter()).update(terms)
        langs.setdefault(lang, Counter()).update(terms)
        seen.setdefault(lang, Counter()).update(terms.keys())
    out = set()
    for lang, source in counts:
        kept = [t for t, n in seen[lang].items() if n >= least]

        def shares(c):
            below = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // below for t in kept}

        own = shares(counts[lang, source])
        pairs = []
        for other in (s for g, s in counts if g == lang and s != source):
            theirs = shares(counts[lang, other])
            pairs.append((-sum(abs(own[t] - theirs[t]) for t in kept), other.encode()))
        whole = shares(langs[lang])
        terms = [(whole[t] - own[t], t.encode()) for t in kept if counts[lang, source][t] and own[t] > whole[t]]
        for part, ranked, most in (("pair", sorted(pairs), None), ("term", sorted(terms), k)):
            out |= {(lang, source, part, item.decode(), -v, i) for i, (v, item) in enumerate(ranked[:most], 1)}
    return out


def made(seed, n=400, sources=6):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("To", "é", "ba", "Zu", "ß") for b in ("la", "ñu", "re", "x", "𝒳")]
    docs = []
    for _ in range(n):
        lang, source = rng.choice(["en", "en", "en", "de", None]), f"s{rng.randrange(sources)}" if rng.random() < 0.6 else "hot"
        text = None if rng.random() < 0.05 else " ".join(rng.choices(words, [rng.random() ** 3 for _ in words], k=rng.randrange(0, 40)))
        docs.append((text, lang, source))
    return docs


def frame(spark, docs):
    return spark.createDataFrame(docs, "text string, lang string, source string")


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_the_definition(spark, seed):
    docs = made(seed)
    got = [tuple(r) for r in audit(frame(spark, docs).repartition(5), least_documents=12, k=7).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(docs, 12, 7)


def test_small_blocks_change_nothing(spark, monkeypatch):
    docs = made(3, sources=9)
    want = brute(docs, 10, 4)
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 8)
    monkeypatch.setattr(divergence, "PART_ROWS", 2)
    monkeypatch.setattr(divergence, "COUNTED_BYTES", 100)
    assert {tuple(r) for r in audit(frame(spark, docs), least_documents=10, k=4).collect()} == want


@pytest.mark.parametrize("k", [1, 3, 10])
def test_skyband_keeps_what_few_beat(k):
    rng = np.random.default_rng(k)
    n, cl, place = rng.integers(0, 12, 700), rng.integers(0, 12, 700), rng.permutation(700)
    beats = (n[:, None] >= n) & (cl[:, None] <= cl) & (place[:, None] < place)
    assert sorted(skyband(n, cl, place, k, block=64)) == np.flatnonzero(beats.sum(axis=0) < k).tolist()
    assert len(skyband(n[:0], cl[:0], place[:0], k)) == 0


def test_terms_end_with_their_text(spark):
    rows = term_counts(frame(spark, [("ab", "en", "s"), ("cd AB", "en", "s"), ("Ünï-x_y9z\x7fq", "en", "s"), ("", "en", "s"), ("İé", "en", "s")])).collect()
    want = {"ab": (2, 2), "cd": (1, 1), "Ünï": (1, 1), "x": (1, 1), "y": (1, 1), "z": (1, 1), "q": (1, 1), "İé": (1, 1)}
    assert {r.term: (r.n, r.df) for r in rows} == want


def test_awkward_rows(awkward, nothing, spark):
    docs = [(r.text, r.lang, r.source) for r in awkward.collect()]
    got = {tuple(r) for r in audit(awkward, least_documents=3).collect()}
    assert got == brute(docs, 3)
    assert audit(nothing).collect() == []
    lone = frame(spark, [(None, None, None), ("", "en", "a"), (None, "en", "b"), ("a b", "en", None)])
    assert {tuple(r) for r in audit(lone).collect()} == brute([tuple(r) for r in lone.collect()], 30)


def test_totals_beyond_a_long_stay_exact(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(divergence.share(F.lit(10**15), F.lit(3 * 10**15), F.lit(10**6)).alias("p")).first()
    assert row.p == 1 + 10**9 * (10**15 + 5) // (3 * 10**15 + 5 * 10**6)


def test_at_more_rows(spark):
    assert compare(spark, "/root/testdata/sf0.01", "op13_divergence_skyband").startswith("ok")
