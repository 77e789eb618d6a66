"""Spark session helpers.

Cluster settings (shuffle partitions, memory, checkpoint directory) belong to
the deployment; these helpers only fill in values that are unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins from runtime sizes: a dimension is broadcast only when its
# materialized size is under the threshold (a checked bound), otherwise it is
# shuffled; skewed partitions of sort-merge joins are split.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "patronage") -> SparkSession:
    """A local session for tests and the bench (not for clusters)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("PATRONAGE_DRIVER_MEMORY", "8g")))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir`` (a shared folder). Only a
    local-mode session without one (tests, the bench) gets a fresh scratch
    folder; on a cluster a missing setting is an error, because a
    machine-local folder would not be visible to the other executors."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="patronage-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a Parquet table in the shared checkpoint
    folder: later passes read the columns they need, and a lost executor's
    work is read again instead of computed again."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
