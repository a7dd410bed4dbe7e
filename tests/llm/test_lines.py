import re
from collections import defaultdict

import numpy as np

from lectern.llm import lines

ENDS = " \t\n\x0b\x0c\r"


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(ENDS))


def brute(rows, min_docs=3, min_chars=20):
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key_of(line)) >= min_chars:
                holders[key_of(line)].add(-(1 << 63) if i is None else i)
    out = []
    for i, t in rows:
        kept = [
            x for x in (t or "").split("\n")
            if not (len(holders[key_of(x)]) >= min_docs and (-(1 << 63) if i is None else i) != max(holders[key_of(x)]))
        ]
        out.append((i, "\n".join(kept), len((t or "").split("\n")), len((t or "").split("\n")) - len(kept)))
    return out


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    pool = [f"Shared line number {i} with some length" for i in range(12)] + ["short", "", "  Padded LINE that many documents hold\t"]
    rows = []
    for i in range(400):
        picked = [pool[j] for j in rng.integers(0, len(pool), rng.integers(0, 9))]
        rows.append((int(i % 390), "\n".join([*picked, f"own line of document {i} only"])))
    rows += [(None, pool[0]), (500, None), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = sorted(brute(rows), key=repr)
    for records in ("10000", "7"):  # runs that go over batches and partitions
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
        got = lines.drop_repeated_lines(docs, totals=("n", "lost"))
        assert sorted(((r.doc_id, r.text or "", r.n, r.lost) for r in got.collect()), key=repr) == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_bitmaps():
    for n in (1, 8, 9, 1000):
        keep = np.arange(n) % 3 > 0
        assert (lines.unpack_bits(lines.pack_bits(keep), n) == keep).all()


def test_awkward_rows(awkward, nothing):
    got = lines.drop_repeated_lines(awkward)
    assert got.columns == awkward.columns
    want = sorted(((i, t) for i, t, *_ in brute([(r.doc_id, r.text) for r in awkward.collect()])), key=repr)
    assert sorted(((r.doc_id, r.text or "") for r in got.collect()), key=repr) == want
    assert lines.drop_repeated_lines(nothing).count() == 0
