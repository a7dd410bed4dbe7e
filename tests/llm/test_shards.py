import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lectern.llm.shards import interleave


def test_shards_match_the_mixture(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.concat(F.lit("text é "), F.col("id")).alias("text"),
    )
    for bucket in (100_000, 64):
        got = interleave(rows, 40, rows_per_bucket=bucket).collect()
        assert len(got) == 5000 and len({r.doc_id for r in got}) == 5000
        per_shard = Counter(r.shard for r in got)
        assert set(per_shard) == set(range(40)) and max(per_shard.values()) - min(per_shard.values()) <= 1
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
            assert (r.law, r.grown_shard) == ("rows", None)
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        total = Counter(r.source for r in got)
        for shard in range(40):
            mix = Counter(r.source for r in got if r.shard == shard)
            assert all(abs(mix[s] - n / 40) <= 2 for s, n in total.items())
        if bucket == 64:
            assert sorted(got) == first
        first = sorted(got)


def test_awkward_rows(awkward, nothing):
    got = interleave(awkward, 4).collect()
    assert len(got) == awkward.count()
    texts = {r.doc_id: r.text for r in awkward.collect()}
    for r in got:
        if r.doc_id is not None:
            text = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(text) + 16, zlib.crc32(text))
    assert interleave(nothing, 4).count() == 0
