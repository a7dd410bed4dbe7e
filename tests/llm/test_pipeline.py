"""The stages beside a plain computation of each, on the stage's own input."""

from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lectern.llm.decontaminate import contaminated
from lectern.llm.tables import written
from lectern.session import shared_dir
from test_lines import brute as brute_lines
from test_minhash import brute as brute_classes
from test_quality import brute as brute_quality

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF_DIR), "test"))
    return out


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_columns(results):
    assert all(df.columns == results[0].columns and df.schema["n_chars"] == results[0].schema["n_chars"] for df in results[:-1])
    assert all(r.n_chars == len(r.text) for r in results[2].collect())


def test_stages_by_brute_force(spark, results):
    raw, quality, lines, near, clean, packed = results
    kept = rows(quality)
    assert set(kept) <= set(rows(raw))
    for i, t in rows(raw):
        n, _, _, _, repeated = brute_quality(t)
        if n < 10 or 100 * repeated > 20 * n:
            assert (i, t) not in kept
    assert rows(lines) == sorted((i, t) for i, t, *_ in brute_lines(kept))
    assert [i for i, _ in rows(near)] == sorted(i for i, _, c in brute_classes(rows(lines)) if i == c)
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    bad = {r.doc_id for r in contaminated(near, items).collect()}
    assert [i for i, _ in rows(clean)] == [i for i, _ in rows(near) if i not in bad]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    want = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in rows(clean)}
    got = {}
    for r in packed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want


def test_awkward_documents(spark, awkward):
    docs = awkward
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, SF_DIR), "test")
        assert after.columns == docs.columns
        docs = after
    # the line of three documents stays in the largest id; texts left empty belong to no group
    assert sorted(((r.doc_id or 0, bool(r.text)) for r in docs.collect())) == [(0, False), (1, False), (1, False), (8, True)]
    # of equal texts the smallest id stays, once; the row without an id and a text is left alone
    near = corpus_pipeline.near_duplicates_stage(spark, awkward, SF_DIR)
    assert sorted((r.doc_id or 0) for r in near.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 9]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= 2
    empty = awkward.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


def test_rows_that_share_only_an_id(spark):
    """Ids that repeat, and rows without an id, are told apart by their text."""
    a, b, c = (" ".join(f"{w}{i}" for i in range(30)) for w in "abc")
    rows = [(1, a), (1, b), (2, b + " more"), (3, c), (3, c), (None, c), (None, a + " x y"), (None, "other words here"), (4, ""), (4, ""), (5, None), (-7, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.near_duplicates_stage(spark, docs, SF_DIR).collect()
    want = [(-7, b), (1, a), (3, c), (None, "other words here"), (4, ""), (4, ""), (5, None)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_a_run_leaves_the_stage_outputs_only(spark):
    folder = Path(shared_dir(spark)) / "llm"
    before = {p.name for p in folder.glob("*")}
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    left = {p.name.rsplit("-", 1)[0] for p in folder.iterdir() if p.name not in before}
    assert left == {name.replace(" ", "-") for name, _ in corpus_pipeline.STAGES}
