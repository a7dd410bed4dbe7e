"""Session defaults and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # batches are bounded by rows and by bytes, as texts may be long
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # a question's terms reach sorted index files as a list, not as a range
    "spark.sql.parquet.pushdown.inFilterThreshold": "500",
}


def build_session(
    app: str = "lectern", master: str | None = None, shared: str | None = None, **conf: str
) -> SparkSession:
    """Session with the library's defaults. Cluster settings win over them
    when they are passed in ``conf`` (dots written as double underscores). ``shared`` is
    the folder for stored tables, which all executors have to see."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULT_CONF | {k.replace("__", "."): v for k, v in conf.items()}
    if shared:
        settings["spark.checkpoint.dir"] = shared
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and index tables, as the cluster names it.

    Only a local session may fall back to a fresh folder of its own: on a
    cluster a machine-local path would be lost with its executor."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
