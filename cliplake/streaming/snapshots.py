"""Snapshots as a stream: late and repeated observations, windowed view counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SNAPSHOT = "video_id string, observed_at timestamp, views bigint, likes bigint"


def read(spark: SparkSession, path: str, schema: str = SNAPSHOT, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def distinct(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """One row per (video_id, observed_at) within the watermark; later repeats are dropped as late."""
    return stream.withWatermark("observed_at", delay).dropDuplicatesWithinWatermark(["video_id", "observed_at"])


def growth(stream: DataFrame, width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Per video and window: observations, least and greatest views."""
    w = F.window("observed_at", width)
    return stream.withWatermark("observed_at", delay).groupBy(w, "video_id").agg(F.count("*").alias("n"), F.min("views").alias("least"), F.max("views").alias("most")).select(F.col("window.start").alias("start"), "video_id", "n", "least", "most")


def append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All that is there now, appended exactly once."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
