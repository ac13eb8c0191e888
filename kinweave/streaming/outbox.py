"""The decisions outbox as a stream: events land once, and the newest decision of each case is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinweave.operators.tables import path_exists

EVENT_SCHEMA = (
    "event_id string, case_id string, source_run_id string, base_case_version long, applied_case_version long, actor string, mode string, action string, "
    "proposal_id string, trace_id string, content_digest string, memberships array<struct<record_key:string,customer_id:string>>")

#: Parts of the log.
PARTS = 256


def read_outbox(spark: SparkSession, path: str) -> DataFrame:
    """Events from JSON files as they arrive."""
    return spark.readStream.schema(EVENT_SCHEMA).json(path)


def land_once(events: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Append events that the log (Parquet) lacks. A batch that is run again finds its events there, so each lands once.

    An event id that comes with another digest, in the log or in the batch, stops the stream; no digest is a digest of its own. The log is
    parted by a hash of the event id, so that a batch reads two columns of the parts it touches.
    """
    def land(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates(["event_id", "content_digest"]).withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(PARTS)).cast("int"))
        if not fresh.groupBy("event_id").count().where("count > 1").isEmpty():
            raise ValueError("an event came twice with other content")
        if path_exists(spark, log):
            touched = [r.part for r in fresh.select("part").distinct().collect()]  # PARTS at most
            old = spark.read.schema(f"{EVENT_SCHEMA}, part int").parquet(log).where(F.col("part").isin(touched)).select(F.col("event_id").alias("old_id"), F.col("content_digest").alias("old"))
            met = fresh.join(old, F.col("event_id").eqNullSafe(F.col("old_id")), "left")
            if not met.where("old_id IS NOT NULL AND NOT old <=> content_digest").isEmpty():
                raise ValueError("an event came back with other content")
            fresh = met.where("old_id IS NULL").drop("old_id", "old")
        fresh.write.mode("append").partitionBy("part").parquet(log)

    return events.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time_col: str = "ts", delay: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums by window and type; events later than ``delay`` are too late."""
    return (events.withWatermark(time_col, delay).groupBy(F.window(time_col, width), "event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
            .select(F.col("window.start").alias("window_start"), "event_type", "n", "total"))
