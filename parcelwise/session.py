"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings the operators were planned for. All of them are also
# safe on a cluster: AQE sizes the partitions, skewed joins are split.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Narrow rows compress tenfold in a shuffle and widen in an aggregate's buffers: 8 MB of them are
    # some hundred MB in a task's memory, whatever the size of the tables.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # Both sides of the feature joins are already partitioned by customer; a
    # customer-only partitioning is enough to join on (customer, window).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Sketches per (feature, month) fit in memory well past the default 128.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    # Wide aggregates: methods too long for the JIT fall back to split projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("parcelwise")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
