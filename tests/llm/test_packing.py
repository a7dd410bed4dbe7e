from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lectern.llm.packing import encoder, hilbert, pack
from lectern.llm.queries import RANKS


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def packed(docs, length):
    return pack(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, length=length).collect()


def check(rows, wanted, length):
    """An exact round trip, and full sequences but for one per range."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length
        pieces[r.doc_id, r.doc_tokens].append((r.start, ids.tolist()))
        sequences[r.sequence_id].append((r.offset, r.length))
    got = []
    for (doc, tokens), parts in pieces.items():
        flat = [i for _, ids in sorted(parts) for i in ids]
        got += [(doc, flat[at : at + tokens]) for at in range(0, len(flat), tokens)]
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    short = sum(sum(s for _, s in parts) < length for parts in sequences.values())
    assert short <= 8
    return got


def test_round_trip(documents, reference):
    got = check(packed(documents, 512), None, 512)
    want = [(r.doc_id, reference(r.text)) for r in documents.collect()]
    assert sorted(got) == sorted(want)


def test_awkward_rows(awkward, nothing, reference):
    rows = packed(awkward.dropDuplicates(["doc_id", "text"]).filter("doc_id is not null"), 64)
    want = {r.doc_id: reference(r.text) for r in awkward.collect()}
    assert all(want[d] == ids for d, ids in check(rows, None, 64))
    assert sum(r.length for r in packed(awkward, 64)) == sum(len(reference(r.text)) for r in awkward.collect())
    assert packed(nothing, 64) == []


def test_encoder_agrees_with_the_tokenizer(reference):
    encoding = encoder(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    for text in ("", " ", "  two  spaces   three ", "tab\t\n\n nl", "don't WE'LL", "<|endoftext|> x", "émigré 漢字 🙂", "a" * 5000, "1234 5.6e7", "\u00a0x"):
        assert encoding.encode_ordinary(text) + [1] == reference(text), text


def test_hilbert_neighbours_touch():
    """Along the curve every step changes one coordinate by one."""
    for d, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
        key = hilbert(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1) == 1).all()
