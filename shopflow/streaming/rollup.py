"""Roll-ups of the landing table by event time, as a stream.

Windows are closed by the watermark and written once (append mode); the state
holds the sums of the open windows only.  Each task adds up its rows before
the shuffle, so a window that holds most rows is one entry a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopflow.sources import sinks
from shopflow.streaming.ingest import LANDING_SCHEMA, WATERMARK_DELAY

HOURLY, DAILY = "1 hour", "1 day"


def landing_source(spark: SparkSession, landing: sinks.Target) -> DataFrame:
    """The landing table's files as they arrive."""
    return spark.readStream.schema(landing.schema or LANDING_SCHEMA).format(landing.format).load(landing.location)


def rolled_up(landed: DataFrame, every: str = HOURLY, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Per window of event time: its start, orders, quantity and value.  The
    value is added up in decimals, so it does not depend on the order."""
    at = landed.withColumn("event_time", F.col("event_time").cast("timestamp"))
    if landed.isStreaming:
        at = at.withWatermark("event_time", delay)
    return (at.groupBy(F.window("event_time", every).alias("w"))
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("quantity").alias("quantity"),
                 F.sum(F.col("total_value").cast("decimal(18,2)")).alias("total_value"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("period_start"), "orders", "quantity",
                    F.col("total_value").cast("double").alias("total_value")))


def start_rollup(spark: SparkSession, landing: sinks.Target, path: str, checkpoint: str, every: str = HOURLY,
                 delay: str = WATERMARK_DELAY, trigger: dict | None = None) -> StreamingQuery:
    """Append each closed window to the files at ``path``."""
    return (rolled_up(landing_source(spark, landing), every, delay).writeStream.format("parquet")
            .outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "30 seconds"})).start())
