"""Tables in the folder that driver and executors share: they cut lineage, and a
lost executor costs only the tasks it was running. What is superseded is deleted.
Arrow batches of texts are bounded by bytes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lectern.session import shared_dir

# a batch is held by the JVM, outside its heap, and by the worker, and neither gives back all that the largest one took
BATCH_BYTES = 2 << 20
_BATCH_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"

_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_scopes: list[set[str]] = []


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path in ``spark.checkpoint.dir``; only a local session without that
    setting gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or shared_dir(spark)
    return f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: computed once, read by all that follows."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[table] = path
    if _scopes:
        _scopes[-1].add(path)
    return table


def arrow_map(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow`` in batches of about ``BATCH_BYTES``, or one row where that is longer.

    Spark reads the bound when the result is computed, which may be after the caller has it, so it
    stays in the session; a smaller bound of the user's stays too. Rows in a batch are bounded as before."""
    spark = df.sparkSession
    bound = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_BYTES_KEY))
    if not 0 < bound <= BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES_KEY, str(BATCH_BYTES))
    return df.mapInArrow(step, schema)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop(*tables: DataFrame | None) -> None:
    """Delete tables of :func:`written` from which everything that was made of them is written; others are left alone."""
    for table in tables:
        path = _paths.pop(table, None) if table is not None else None
        if path:
            _delete(table.sparkSession, path)
            for scope in _scopes:
                scope.discard(path)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns as a written table. All tables that were written on the way are deleted."""
    _scopes.append(set())
    result = None
    try:
        result = written(make(), name)
        return result
    finally:
        made = _scopes.pop()
        kept = _paths.get(result) if result is not None else None
        spark = SparkSession.getActiveSession() if result is None else result.sparkSession
        for path in made - {kept}:
            _delete(spark, path)
        if kept and _scopes:
            _scopes[-1].add(kept)
