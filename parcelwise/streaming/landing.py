"""Incremental ingestion with Structured Streaming (all triggers are ``availableNow``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelwise.functions import columns as C
from parcelwise.operators.rollup import monthly_rollup
from parcelwise.schemas import landing_schema
from parcelwise.sources.landing import TRANSFORMS

EVER = ("1900-01-01", "2999-12-31")


def stream_landing(spark: SparkSession, path: str, base: str, *, sep: str = ";") -> DataFrame:
    """Typed rows of every new file in a folder, each file once."""
    rows = spark.readStream.schema(landing_schema(base)).csv(path, sep=sep, header=True, encoding="UTF-8", quote='"')
    return TRANSFORMS[base](rows)


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process what has arrived and stop."""
    query = (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def stream_dedup_shipments(stream: DataFrame, delay: str = "62 days") -> DataFrame:
    """Drop a shipment that is sent again within the delay. State is bounded by the watermark."""
    timed = stream.withColumn("_t", F.col("sending_time").cast("timestamp"))
    return timed.withWatermark("_t", delay).dropDuplicatesWithinWatermark(["item_code", "_t"]).drop("_t")


def split_late(batch: DataFrame, completed: DataFrame, newest: int = 2) -> tuple[DataFrame, DataFrame]:
    """Accepted and quarantined rows.

    Rows of the newest months (over the batch and the completed months) are
    accepted, older ones only while their month is not completed. ``completed`` has
    one ``yymm`` per month.
    """
    keyed = batch.withColumn("yymm", C.month_key(F.col("sending_time")))
    seen = keyed.select("yymm").distinct().unionByName(completed.select("yymm").distinct()).distinct()
    fresh = seen.filter("yymm is not null").orderBy(F.col("yymm").desc()).limit(newest)
    # Both helper tables have one row per month.
    tagged = keyed.join(F.broadcast(fresh.withColumn("_fresh", F.lit(True))), "yymm", "left").join(
        F.broadcast(completed.select("yymm").distinct().withColumn("_done", F.lit(True))), "yymm", "left"
    )
    keep = F.col("_fresh").isNotNull() | (F.col("_done").isNull() & F.col("yymm").isNotNull())
    clean = lambda df: df.drop("_fresh", "_done")
    return clean(tagged.filter(keep)), clean(tagged.filter(~keep))


def rollup_sink(spark: SparkSession, store: str, out: str) -> Callable[[DataFrame, int], None]:
    """Batch handler: keep the rows, then rebuild the roll-up of the touched months.

    Rows land in ``(yymm, batch)`` partitions, so a repeated batch overwrites
    itself; each touched month is recomputed from all its rows.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        keyed = batch.withColumn("yymm", C.month_key(F.col("sending_time"))).withColumn("batch", F.lit(batch_id))
        keyed.persist()  # read twice; a stateful stream must run once per batch
        writer = lambda df: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer(keyed).partitionBy("yymm", "batch").parquet(store)
        months = [r[0] for r in keyed.select("yymm").distinct().collect()]  # one per touched month
        keyed.unpersist()
        if not months:
            return
        stored = session.read.option("partitionColumnTypeInference.enabled", "false").parquet(store)
        touched = stored.filter(F.lpad(F.col("yymm").cast("string"), 4, "0").isin(months)).drop("yymm", "batch")
        rolled = monthly_rollup(touched, *EVER).withColumn("yymm", F.col("month_key"))
        writer(rolled).partitionBy("yymm").parquet(out)

    return handle


def stream_monthly_rollup(stream: DataFrame, store: str, out: str, checkpoint: str) -> StreamingQuery:
    """Keep the monthly roll-up current as files arrive."""
    return run_available(stream, rollup_sink(stream.sparkSession, store, out), checkpoint)


def late_policy_sink(store: str, quarantine: str, completed: Callable[[], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Batch handler that stores accepted rows and puts the rest aside."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read several times; a stateful stream must run once per batch
        good, late = split_late(batch, completed())
        for df, path in ((good, store), (late, quarantine)):
            (
                df.withColumn("batch", F.lit(batch_id))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch")
                .parquet(path)
            )
        batch.unpersist()

    return handle
