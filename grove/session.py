"""Lineage cutting through the checkpoint folder that the cluster names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel


def ensure_checkpoint_dir(spark: SparkSession, folder: str | None = None) -> str:
    """The folder for checkpoints and scratch tables: the session's own, ``spark.checkpoint.dir``, or ``folder``.

    It must be shared by the driver and all executors. Without any of the three this raises ``ValueError``.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or folder
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and return it without its history.

    The result is also kept in memory or on local disk while it is in use; a lost executor costs a
    re-read of the checkpoint files, never a recomputation of the whole chain.
    """
    ensure_checkpoint_dir(df.sparkSession)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    done = kept.checkpoint(eager=True)
    kept.unpersist()
    return done.persist()
