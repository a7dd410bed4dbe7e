"""Proportional stratified interleaving: shards that each match the mixture.

Rows of a source are put in a seeded random order. A row's fractional rank says how
far through its source it comes, from 0 to 1. Sorting all rows by it interleaves the
sources in proportion, and equal cuts of that order hold every source in its share,
give or take a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

ROW_OVERHEAD = 16


def _running(counts: DataFrame, bucket: str, by: list[str]) -> Column:
    w = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(w), F.lit(0))


def interleave(
    docs: DataFrame, n_shards: int, seed: int = 17, key: str = "doc_id", source: str = "source",
    text: str = "text", rows_per_bucket: int = 20_000,
) -> DataFrame:
    """(key, source, size, text_crc32, law, shard, slot, grown_shard) for every row.

    Shard sizes in rows differ by one at most (``law`` is ``rows``), so
    ``grown_shard`` is null. ``slot`` counts from 0 in each shard in the mixed order.
    A null source is a source of its own; a null text has only the overhead as size.
    Rows with one id are ordered by their text's checksum and size, and rows equal in
    all of these are interchangeable. An empty table gives an empty result.

    Order inside a source is the md5 of id and seed. No task sorts a source: a
    source's rows fall into equal ranges of the hash, and the whole order into equal
    ranges of the fractional rank, each of about ``rows_per_bucket`` rows at any
    share of the largest source; counts of the ranges are summed up to offsets. Texts
    are read once and not moved."""
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    total = docs.count()
    ranges = max(1, -(-total // rows_per_bucket))
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), 1, 12), 16, 10)
    rows = docs.select(
        F.col(key), F.col(source),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("_s"),
        draw.cast("long").alias("_h"),
    ).withColumn("_b", F.floor(F.col("_h") / F.lit(float(1 << 48)) * F.lit(ranges)).cast("long"))

    counts = rows.groupBy("_s", "_b").agg(F.count("*").alias("_n"))
    offsets = counts.select(
        "_s", "_b", _running(counts, "_b", ["_s"]).alias("_before"),
        F.sum("_n").over(Window.partitionBy("_s")).alias("_of"),
    )
    within = F.row_number().over(Window.partitionBy("_s", "_b").orderBy("_h", key, "text_crc32", "size"))
    ranked = rows.withColumn("_r", within).join(offsets, ["_s", "_b"]).withColumn("_r", F.col("_r") + F.col("_before"))
    placed = ranked.withColumn("_f", (F.col("_r") * 2 - 1) / (F.col("_of") * 2)).withColumn(
        "_p", F.floor(F.col("_f") * F.lit(ranges)).cast("long")
    ).select(key, source, "size", "text_crc32", "_s", "_r", "_f", "_p")

    return _cut(placed, n_shards, total, key, source)


def _cut(placed: DataFrame, n_shards: int, total: int, key: str, source: str) -> DataFrame:
    counts = placed.groupBy("_p").agg(F.count("*").alias("_n"))
    offsets = counts.select("_p", _running(counts, "_p", []).alias("_first"))
    within = F.row_number().over(Window.partitionBy("_p").orderBy("_f", "_s", "_r")) - 1
    ordered = placed.withColumn("_at", within).join(offsets, "_p").withColumn("_at", F.col("_at") + F.col("_first"))
    shard = F.expr(f"(_at * {n_shards}) div {max(total, 1)}")
    first = F.expr(f"(_shard * {total} + {n_shards - 1}) div {n_shards}")
    return ordered.withColumn("_shard", shard).select(
        key, source, "size", "text_crc32", F.lit("rows").alias("law"), F.col("_shard").cast("int").alias("shard"),
        (F.col("_at") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
