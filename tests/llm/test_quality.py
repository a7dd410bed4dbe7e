import re
from collections import Counter

from lectern.llm import quality

SPACE = r"[\x20\x09-\x0D]+"


def brute(text):
    words = [w for w in re.split(SPACE, text or "") if w]
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {p for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)
    )


def test_measurements(awkward):
    for r in quality.ledger(awkward.select("doc_id", "text", "kept"), "text").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text), r.text


def test_verdicts_and_bits(awkward, nothing):
    book = quality.judged(quality.ledger(awkward), "v2").collect()
    assert len(book) == awkward.count()
    for r in book:
        base = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == base
        assert r.kept == (r.fail_bits & quality.POLICIES["v2"] == 0)
        assert r.sole_bit in (0, r.fail_bits)
    assert quality.ledger(nothing).count() == 0


def test_ablation_follows_from_the_bits(documents):
    book = quality.ledger(documents)
    rows = [r.fail_bits for r in book.collect()]
    got = {r["rule"]: r for r in quality.ablation(book, "v1").collect()}
    mask = quality.POLICIES["v1"]
    assert set(got) == {n for n, b in quality.BITS.items() if b & mask}
    for name, r in got.items():
        bit = quality.BITS[name]
        assert r.failed == sum(bool(v & bit) for v in rows)
        assert r.only == sum(v & mask == bit for v in rows)
        assert r.kept_without == sum(v & mask & ~bit == 0 for v in rows)


def test_kept_documents_keep_their_columns(awkward):
    kept = quality.kept_documents(awkward, "v2")
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 1, 8]
