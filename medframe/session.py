"""Spark session defaults for local runs and tests.

On a cluster the session is the caller's; these settings only fill gaps.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Rows of an Arrow batch crossing into Python. Batches are also capped at
# spark.sql.execution.arrow.maxBytesPerBatch (64 MiB), which bounds batches of whole files.
ARROW_ROWS = 4096


def get_session(master: str | None = None, partitions: int = 8, app: str = "medframe") -> SparkSession:
    master = master or os.environ.get("MEDFRAME_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
        .config("spark.driver.memory", os.environ.get("MEDFRAME_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``). Only
    a local-mode session without one gets a local folder (tests)."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a shared folder (HDFS, object "
            "store) so written tables survive executor loss")
    local = tempfile.mkdtemp(prefix="medframe-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def materialize(df, name: str = "table"):
    """Write ``df`` once as parquet under the cluster's checkpoint folder
    (``spark.checkpoint.dir``, a shared file system on a cluster) and read it
    back: later passes reuse the files instead of recomputing the lineage,
    and a lost executor costs no recomputation of upstream work."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/medframe-{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def local_frame(spark, rows: list[tuple], columns: list[str], schema_ddl: str):
    """A small driver-side table as a ``LocalRelation`` (sent with the plan
    through Arrow, no Python RDD). For bounded dimension tables only."""
    import pandas as pd

    return spark.createDataFrame(pd.DataFrame(rows, columns=columns), schema=schema_ddl)
