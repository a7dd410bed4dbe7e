"""Join sizes, global positions and top-k: the shapes every operator shares."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

BROADCAST_ROWS = 250_000
BROADCAST_BYTES = 64 << 20
SALTS = 32
ARROW_BYTES = 8 << 20
_ARROW_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def _row_bytes(df: DataFrame) -> Column:
    total = F.lit(0)
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            total = total + F.coalesce(F.octet_length(col), F.lit(0))
        elif isinstance(field.dataType, ArrayType):
            total = total + F.coalesce(F.size(col), F.lit(0)) * 16
        else:
            total = total + 8
    return total


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df``, reading no more than ``max_rows`` + 1 of its rows."""
    n, size = (
        df.limit(max_rows + 1)
        .select(_row_bytes(df).cast("long").alias("b"))
        .agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0)))
        .first()
    )
    return n <= max_rows and size <= max_bytes


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Partition by ``by`` into the session's number of shuffle partitions. The
    number is given so that adaptive execution, which only sees small input
    bytes, does not merge tasks whose rows are about to be exploded."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def arrow_rows(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow`` for long rows, in batches of about ``ARROW_BYTES``. The bound stays in the session, as it is
    read when the result is computed; a smaller one of the user's stays too."""
    spark = df.sparkSession
    bound = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_ARROW_KEY))
    if not 0 < bound <= ARROW_BYTES:
        spark.conf.set(_ARROW_KEY, str(ARROW_BYTES))
    return df.mapInArrow(step, schema)


def count_up_to(df: DataFrame, limit: int = BROADCAST_ROWS) -> int | None:
    """Row count, or None when there are more rows than ``limit``."""
    n = df.select(F.lit(1)).limit(limit + 1).count()
    return n if n <= limit else None


def sized_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], salt_by: str, fits: bool, salts: int = SALTS, how: str = "inner"
) -> DataFrame:
    """Inner join, or left join, that leaves ``big`` where it is when ``small`` was measured to
    fit on every executor (``fits``, from :func:`fits_broadcast` on a table that
    bounds it). Beyond that size both sides shuffle on the key and a salt drawn
    from ``salt_by``, so a key holding a large share of ``big`` is spread over
    ``salts`` tasks. They merge by order: the optimizer takes the salted side for as
    large as one copy of it, and would send all copies through the driver."""
    on = list(on)
    if fits:
        return big.join(F.broadcast(small), on, how)
    left = big.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")


def top_k(df: DataFrame, by: str | Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each group, ranked from 1. The filter on the rank lets
    Spark cut every task's groups to ``k`` rows before they are shuffled."""
    by = [by] if isinstance(by, str) else list(by)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def first_rows(df: DataFrame, coarse: Column, fine: Sequence[Column], k: int) -> DataFrame:
    """The ``k`` rows of the whole table that come first by ``coarse``, a bigint of few
    different values, and then by ``fine``.

    Rows are counted per value, which finds the value where the cut falls. Rows before
    it are kept by a filter where they are, and only those at the cut are ordered."""
    rows = df.withColumn("_v", coarse)
    running = F.sum("n").over(Window.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counts = rows.groupBy("_v").agg(F.count("*").alias("n")).withColumn("upto", running)
    cut = counts.filter(F.col("upto") >= k).agg(F.min("_v")).scalar()
    left = k - counts.filter((F.col("upto") < k)).agg(F.coalesce(F.max("upto"), F.lit(0))).scalar()
    before = rows.filter((F.col("_v") < cut) | cut.isNull())
    tied = rows.filter(F.col("_v") == cut).orderBy(*fine).limit(k)
    place = F.row_number().over(Window.orderBy(*fine))  # at most k rows are left
    return before.unionByName(tied.withColumn("_p", place).filter(F.col("_p") <= left).drop("_p")).drop("_v")


def least_kept(df: DataFrame, value: Column, k: int) -> int:
    """The ``k``-th largest of a bigint of few different values; 0 where there are fewer."""
    running = F.sum("n").over(Window.orderBy(F.col("_v").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counts = df.groupBy(value.alias("_v")).agg(F.count("*").alias("n")).withColumn("upto", running)
    return counts.filter(F.col("upto") >= k).agg(F.max("_v")).first()[0] or 0


def _offsets(counts: DataFrame, shifts: Sequence[int]) -> DataFrame:
    """(bucket, first): rows that lie in smaller buckets, level by level."""
    if not shifts:
        w = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        return counts.select("bucket", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("first"))
    nested = counts.withColumn("parent", F.shiftright("bucket", shifts[0]))
    w = Window.partitionBy("parent").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    within = nested.withColumn("inner", F.coalesce(F.sum("n").over(w), F.lit(0)))
    parents = nested.groupBy(F.col("parent").alias("bucket")).agg(F.sum("n").alias("n"))
    above = _offsets(parents, shifts[1:]).select(F.col("bucket").alias("parent"), F.col("first").alias("above"))
    return within.join(above, "parent").select("bucket", (F.col("above") + F.col("inner")).alias("first"))


def positions(
    df: DataFrame, key: str, out: str, tie: Sequence[str] = (), shifts: Sequence[int] = (10, 20, 20)
) -> DataFrame:
    """Dense 0-based position of each row in the order of the bigint ``key``.

    A row number over the whole table would sort it in one task. Here rows are
    numbered inside buckets of ``2**shifts[0]`` key values, and the bucket
    counts are summed level by level. Distinct keys bound every bucket, whatever
    the spread of the ids; for hashed keys pass one wide shift."""
    bucketed = df.withColumn("bucket", F.shiftright(F.col(key), shifts[0]))
    w = Window.partitionBy("bucket").orderBy(key, *tie)
    numbered = bucketed.withColumn("_within", F.row_number().over(w) - 1)
    counts = bucketed.groupBy("bucket").agg(F.count("*").alias("n"))
    return (
        numbered.join(_offsets(counts, shifts[1:]), "bucket")
        .withColumn(out, (F.col("first") + F.col("_within")).cast("long"))
        .drop("bucket", "first", "_within")
    )
