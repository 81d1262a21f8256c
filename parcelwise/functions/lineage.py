"""Cut long lineages with reliable checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session without one gets a folder of its machine; a cluster without one is an
    error, since executors do not see each other's folders.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="parcelwise-checkpoint-")
    context.setCheckpointDir(named)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute once and continue from the stored rows.

    For narrow frames that several later steps read: their plan restarts here and
    lost executors only cost a re-read.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
