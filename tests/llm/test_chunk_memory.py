"""What the tasks of the pipeline hold next to an Arrow batch of texts."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from lectern.llm import kernels, minhash
from lectern.llm.decontaminate import SEPARATORS, Seeds, _search
from lectern.llm.kernels import ASCII_LOWER, WordHasher, chunks
from lectern.llm.minhash import _sets, _sign

ITEM = "the first president of the united states was born in virginia"


def texts() -> list[str | None]:
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    out = [" ".join(rng.choices(words, k=400)) for _ in range(3000)]
    out[7], out[8], out[2500] = None, "", f"{out[9]} {ITEM} {out[10]}"
    return out


def steps():
    seeds = Seeds([(3, next(iter(WordHasher(SEPARATORS, ASCII_LOWER)(pa.array([ITEM]))))[1])], 5)
    return {"search": _search(seeds, 5, 0.5), "sign": _sign(5, 24, 3), "sets": _sets(5)}


def rows(step, batch):
    return [r for out in step(iter([batch])) for r in out.to_pylist()]


@pytest.fixture(scope="module")
def batch():
    own = texts()
    return pa.RecordBatch.from_arrays([pa.array(range(len(own)), pa.int64()), pa.array(own)], names=["doc_id", "text"])


@pytest.mark.parametrize("step", ["search", "sign", "sets"])
def test_a_task_holds_little_next_to_its_batch(batch, step):
    run = steps()[step]
    tracemalloc.start()
    n = sum(out.num_rows for out in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n and peak < 32 << 20


@pytest.mark.parametrize("step", ["search", "sign", "sets"])
def test_rows_do_not_depend_on_the_chunk(monkeypatch, batch, step):
    got = rows(steps()[step], batch)
    monkeypatch.setattr(chunks, "__defaults__", (1 << 30,))
    monkeypatch.setattr(minhash, "_HELD_SHINGLES", 1 << 30)
    assert got == rows(steps()[step], batch)
    if step == "search":
        assert [(r["doc_id"], r["item_id"], r["coverage"]) for r in got] == [(2500, 3, 1.0)]


def test_chunks_hold_every_text_once(batch):
    parts = [*chunks(batch.column(1))]
    assert [first for first, _ in parts] == np.cumsum([0, *(len(p) for _, p in parts[:-1])]).tolist()
    assert pa.concat_arrays([p for _, p in parts]).equals(batch.column(1))
    assert all(len(p) == 1 or p.nbytes <= 2 * kernels.CHUNK_BYTES for _, p in parts)
