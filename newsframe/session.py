"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "newsframe",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session or build one tuned for this library.

    On a cluster the session already exists (spark-submit) and is returned
    as is; the settings below only apply when we create it (tests, bench).
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    master = master or os.environ.get("NEWSFRAME_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # HTML rows are large: keep Arrow batches to a bounded number of pages.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
        .config("spark.driver.memory", os.environ.get("NEWSFRAME_DRIVER_MEM", "16g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A scratch folder of our own is made only where the setting is absent and
    driver and executors are one local process (tests, bench); elsewhere an
    absent setting is an error, because executors could not read that folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if conf_dir:
        if not context.getCheckpointDir():
            context.setCheckpointDir(conf_dir)
        return conf_dir
    current = context.getCheckpointDir()
    if current:
        return current
    master = context.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="newsframe-ckpt-")
    context.setCheckpointDir(local)
    return context.getCheckpointDir()


def materialize(df, name: str = "materialized"):
    """Cut the lineage of a reused intermediate result.

    Writes it as a Parquet table under the shared checkpoint folder
    (``spark.checkpoint.dir``) and reads it back: later plans read the
    written rows instead of re-running the query, the data survives executor
    loss, and the query runs once (an eager ``Dataset.checkpoint`` computes
    it twice: once to count, once to write). ``release`` deletes the table.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def release(*written) -> None:
    """Delete tables made by ``materialize`` that no later plan reads."""
    for df in written:
        delete_path(df.sparkSession, df.written_path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on whatever file system it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def estimated_bytes(df) -> int | None:
    """Catalyst's size estimate of a DataFrame (exact file sizes for a scan
    of a written table); None when unknown."""
    try:
        est = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        size = est if isinstance(est, int) else int(est.toString())
    except Exception:  # noqa: BLE001
        return None
    return None if size >= (1 << 62) else size
