"""Usage ledgers as streams: an extension, no reading of the files they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def calls_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def windowed_cost(calls: DataFrame, cost: str, kind: str = "event_type", window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Calls and their cost by tumbling window and kind; calls later than the watermark are left out."""
    return calls.withWatermark("ts", late).groupBy(F.window("ts", window), kind).agg(F.count("*").alias("calls"), F.sum(cost).alias("cost")).select(F.col("window.start").alias("start"), F.col(kind), "calls", "cost")
