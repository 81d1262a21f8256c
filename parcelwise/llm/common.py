"""Shared folder, stored intermediate tables and checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.functions.lineage import ensure_checkpoint_dir


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str = "step") -> DataFrame:
    """Compute once and read back from the shared folder; lost executors only cost a re-read."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_enough(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a stored table of at most ``rows`` rows; a larger one is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def split_words(text: Column) -> Column:
    """Words between the six ASCII white-space characters."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", empty("string")).otherwise(F.split(bare, "[ \\t-\\r]+", -1))
