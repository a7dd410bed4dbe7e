"""Derived tables that are read when they exist and built when they do not.

The key of a table holds its parameters and a fingerprint of the corpus, so a
changed corpus or parameter never meets an old index."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.session import shared_dir

CELL_FILES = 8  # tasks that write a cell, so that a large cell is not one task
PASSAGE_BLOCK_BITS = 20  # ids per directory
PASSAGE_FILE_BITS = 10  # ids that stay together in a file
PACKED = {"compression": "zstd"}  # tables are as large as the corpus and more, and written once


def corpus_fingerprint(df: DataFrame, columns: Sequence[str]) -> str:
    """Row count and order-free hash of the named columns, in one pass."""
    n, total = df.agg(
        F.count("*"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    ).first()
    return f"{n}:{total}"


class TableStore:
    """Tables by name and key. A table is written to a folder of its own and becomes visible
    by a pointer file that is put in place whole, so two jobs that build the same
    table do not touch each other's files, and a job that dies leaves no half table."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or shared_dir(spark)).rstrip("/") + "/tables"

    def path(self, name: str, key: dict) -> str:
        """The pointer of a table."""
        digest = hashlib.sha256(json.dumps(key, sort_keys=True).encode()).hexdigest()[:16]
        return f"{self.root}/{name}_{digest}"

    def _files(self, path: str):
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def exists(self, path: str) -> bool:
        place, files = self._files(f"{path}.json")
        return files.exists(place)

    def _published(self, path: str) -> dict | None:
        if not self.exists(path):
            return None
        place, files = self._files(f"{path}.json")
        stream = files.open(place)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, path: str, entry: dict) -> dict:
        """Put the pointer in place, unless another job was first; the pointer that counts."""
        draft, files = self._files(f"{path}.{uuid.uuid4().hex}.draft")
        out = files.create(draft, True)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        if self.exists(path) or not files.rename(draft, self._files(f"{path}.json")[0]):
            files.delete(draft, False)
        return self._published(path)

    def _fresh(self, path: str) -> str:
        return f"{path}-{uuid.uuid4().hex[:12]}"

    def load_or_build(
        self, name: str, key: dict, build: Callable[[], DataFrame], sort_by: str | None = None
    ) -> DataFrame:
        """A plain table. Sorted files let a filter on ``sort_by`` skip pages."""
        path = self.path(name, key)
        entry = self._published(path)
        if entry is None:
            data, built = self._fresh(path), build()
            (built.sortWithinPartitions(sort_by) if sort_by else built).write.options(**PACKED).parquet(data)
            entry = self._publish(path, {"path": data})
        return self.spark.read.parquet(entry["path"])

    def load_or_build_passages(self, key: dict, build: Callable[[], DataFrame]) -> DataFrame:
        """(pid, text, block): passages partitioned by blocks of their id and
        sorted inside, so that fetching a hit list reads only its blocks."""
        path = self.path("passages", key)
        entry = self._published(path)
        if entry is None:
            data = self._fresh(path)
            placed = build().select("pid", "text", F.shiftright("pid", PASSAGE_BLOCK_BITS).alias("block"))
            (
                placed.repartition("block", F.shiftright("pid", PASSAGE_FILE_BITS))
                .sortWithinPartitions("block", "pid")
                .write.options(**PACKED)
                .partitionBy("block")
                .parquet(data)
            )
            entry = self._publish(path, {"path": data})
        return self.spark.read.schema("pid long, text string, block long").parquet(entry["path"])

    def load_or_build_cells(self, key: dict, build: Callable[[], DataFrame]) -> DataFrame:
        """(pid, vec, cell): vectors in a directory per cell, so that a search reads only
        the cells that are asked."""
        path = self.path("cells", key)
        entry = self._published(path)
        if entry is None:
            data = self._fresh(path)
            build().select("pid", "vec", "cell").repartition("cell", F.pmod(F.xxhash64("pid"), F.lit(CELL_FILES))).write.options(
                **PACKED
            ).partitionBy("cell").parquet(data)
            entry = self._publish(path, {"path": data})
        stored = self.spark.read.parquet(entry["path"])
        return stored.withColumn("cell", F.col("cell").cast("long"))

    def load_or_build_bucketed(
        self,
        name: str,
        key: dict,
        build: Callable[[int], DataFrame],
        by: str,
        buckets: Callable[[], int],
        sort_by: str | None,
        placed: bool = False,
    ) -> DataFrame:
        """A table bucketed on ``by``, so that grouping on it after a read needs
        no shuffle, and sorted on ``sort_by`` inside each bucket, so that a filter
        on it skips row groups.

        ``buckets`` is asked when the table is built; the number is kept beside the
        table, so any session finds it. ``placed`` says that what ``build`` returns is
        already partitioned by ``by`` into the number it was given, and is written as it is."""
        path = self.path(name, key | {"by": by})
        entry = self._published(path)
        if entry is None:
            data, n = self._fresh(path), buckets()
            built = build(n)
            writer = (built if placed else built.repartition(n, by)).write.format("parquet").options(**PACKED).bucketBy(n, by)
            (writer.sortBy(sort_by) if sort_by else writer).option("path", data).saveAsTable(_table_of(data))
            entry = self._publish(path, {"path": data, "buckets": n})
        table = _table_of(entry["path"])
        if not self.spark.catalog.tableExists(table):
            columns = self.spark.read.parquet(entry["path"]).schema.toDDL()
            order = f"SORTED BY ({sort_by}) " if sort_by else ""
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({by}) {order}"
                f"INTO {entry['buckets']} BUCKETS LOCATION '{entry['path']}'"
            )
        return self.spark.table(table)


def _table_of(path: str) -> str:
    return path.rsplit("/", 1)[1].replace("-", "_")
