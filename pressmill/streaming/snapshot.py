"""Structured Streaming: day snapshots united across runs, and windowed counts with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unite(stream: DataFrame, key: str, at: str, delay: str = "30 days") -> DataFrame:
    """First row of each key within the watermark: re-delivered articles are dropped, state older than the delay goes."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def windowed(stream: DataFrame, at: str, kind: str, width: str = "1 day", delay: str = "2 days") -> DataFrame:
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).groupBy(F.window(at, width).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")


def run_available(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process what is there once, append to Parquet, and read the result."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
