"""Structured Streaming: facts that arrive in files, loaded once each however often they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from verdant.operators.star import upsert_latest


def stream_once(spark: SparkSession, source: str, schema: T.StructType, key: str, order: list[str], target: str, checkpoint: str, files_per_batch: int = 64) -> StreamingQuery:
    """Load new parquet files of `source` into `target`, each key once.

    Inside a batch the last write of a key wins; keys the target already holds are left
    out by an anti-join, so a replayed batch changes nothing.  The query stops when no file is left.
    """

    def load(batch: DataFrame, _: int) -> None:
        rows = upsert_latest(batch, key, order)
        try:
            held = batch.sparkSession.read.parquet(target).select(key)
        except Exception as error:  # the first batch finds no target
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            held = None
        (rows if held is None else rows.join(held, key, "left_anti")).write.mode("append").parquet(target)

    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return reader.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_arrivals(events: DataFrame, moment: str, arrival: str, allowed: str) -> DataFrame:
    """Rows of a batch or stream that arrive within the allowed lateness of their event time."""
    return events.where(F.col(arrival).cast("timestamp") <= F.col(moment).cast("timestamp") + F.expr(f"INTERVAL {allowed}"))


def windowed_counts(events: DataFrame, moment: str, keys: list[str], width: str, late: str) -> DataFrame:
    """Counts and sums of `value` per tumbling window; on a stream rows later than `late` behind the watermark are left out."""
    source = events.withWatermark(moment, late) if events.isStreaming else events
    grouped = source.groupBy(F.window(moment, width), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return grouped.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n", "total")
