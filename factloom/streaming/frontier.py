"""Streams: usage by window with late rows dropped, first-seen URLs, and frontier expansion by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType


def usage(events: DataFrame, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """window start, event_type, calls and value over tumbling windows, with a watermark on ts."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type")
    return rows.agg(F.count(F.lit(1)).alias("calls"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), "event_type", "calls", "value")


def first_seen(links: DataFrame, key: str = "url", late: str = "1 hour") -> DataFrame:
    """The first row of each key within the watermark: state is bounded by it."""
    return links.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def kept(updates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes an aggregate's changed rows, batch by batch, each batch into a folder of its own: a replayed batch replaces
    itself, and only what changed is written. latest() reads the table."""

    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return updates.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    """The last batch's row of each key in a table that kept() wrote."""
    rows = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(path)
    rest = [f.name for f in schema.fields if f.name not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select(*keys, "_r.*")


def expand(links: DataFrame, queue_path: str, enqueue: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Adds to the queue table, batch by batch, what enqueue(queue, links) finds new.

    A batch's rows are the folder batch=<number> below queue_path, beside the seeds' batch=-1; a replayed batch replaces
    its own folder and sees only the ones before it, so it adds the same rows again and no others.
    """

    def step(batch: DataFrame, number: int) -> None:
        queue = batch.sparkSession.read.parquet(queue_path).where(F.col("batch") < number).drop("batch")
        enqueue(queue, batch).write.mode("overwrite").parquet(f"{queue_path}/batch={number}")

    return links.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
