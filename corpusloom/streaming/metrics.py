"""Additive streaming: the same operators over files as they arrive. No batch operator needs this."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

METRIC = "ts double, stage string, temp double, mhz double"


def read_metrics(spark: SparkSession, path: str, per_trigger: int = 100) -> DataFrame:
    """Metrics JSONL files of a folder as a stream, with at (the event time)."""
    return spark.readStream.schema(METRIC).option("maxFilesPerTrigger", per_trigger).json(path).withColumn("at", F.timestamp_seconds("ts"))


def throttle_alerts(metrics: DataFrame, window: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Per stage and window: hottest, slowest, throttled (83 degrees or more, or under 1500 MHz). State is dropped ``late`` after."""
    hot, slow = F.max("temp"), F.min("mhz")
    agg = metrics.withWatermark("at", late).groupBy(F.window("at", window).alias("w"), "stage").agg(hot.alias("hottest"), slow.alias("slowest"))
    return agg.select("stage", F.col("w.start").alias("start"), "hottest", "slowest", ((F.col("hottest") >= 83) | (F.col("slowest") < 1500)).alias("throttled"))


def sessions(events: DataFrame, key: str, at: str, gap: str, late: str, *aggs: Column) -> DataFrame:
    """Segments of a stream (or table) closed by a pause of ``gap``: key, start, end and the aggregates."""
    stream = events.withWatermark(at, late) if events.isStreaming else events
    out = stream.groupBy(F.session_window(at, gap).alias("s"), key).agg(*aggs)
    return out.select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), *(c for c in out.columns if c not in ("s", key)))


def ingest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All files there are now, appended once each however often it is started; then it ends."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
