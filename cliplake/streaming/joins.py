"""Streams of feature vectors and snapshots, joined by time, and bursts of snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = "video_id string, projected_at timestamp, features string"


def latest_before(features: DataFrame, snapshots: DataFrame, within: str = "2 days", delay: str = "1 hour") -> DataFrame:
    """Each feature row (video_id, projected_at, features) with the last snapshot of its video at or before projected_at, at most `within` before it: observed_at, views, likes; null if there is none.

    Both sides are streams with a watermark of `delay`; state is kept for
    `within` and the delay. A row comes out, once, when no snapshot for it can
    come any more; later ones are dropped. A video's feature rows of one time are
    one row (the greatest features)."""
    left = features.where("video_id IS NOT NULL AND projected_at IS NOT NULL").withWatermark("projected_at", delay)
    right = snapshots.where("video_id IS NOT NULL AND observed_at IS NOT NULL").withWatermark("observed_at", delay)
    right = right.select(F.col("video_id").alias("_id"), "observed_at", "views", "likes")
    near = F.expr(f"video_id = _id AND observed_at <= projected_at AND observed_at >= projected_at - INTERVAL {within}")
    both = left.join(right, near, "left")
    last = both.groupBy("video_id", "projected_at").agg(F.max("features").alias("features"), F.max(F.struct("observed_at", "views", "likes")).alias("s"))
    return last.select("video_id", "projected_at", "features", "s.observed_at", "s.views", "s.likes")


def latest_before_batch(features: DataFrame, snapshots: DataFrame, within: str = "2 days") -> DataFrame:
    """What latest_before() comes to, of tables."""
    right = snapshots.select(F.col("video_id").alias("_id"), "observed_at", "views", "likes")
    near = F.expr(f"video_id = _id AND observed_at <= projected_at AND observed_at >= projected_at - INTERVAL {within}")
    last = features.where("video_id IS NOT NULL AND projected_at IS NOT NULL").join(right, near, "left")
    last = last.groupBy("video_id", "projected_at").agg(F.max("features").alias("features"), F.max(F.struct("observed_at", "views", "likes")).alias("s"))
    return last.select("video_id", "projected_at", "features", "s.observed_at", "s.views", "s.likes")


def bursts(snapshots: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """video_id, start, end, n, least and most views of each run of snapshots with less than `gap` between neighbours; of a stream, when it can't grow any more. end: the last snapshot and the gap."""
    rows = snapshots.withWatermark("observed_at", delay) if snapshots.isStreaming else snapshots
    w = F.session_window("observed_at", gap)
    got = rows.where("video_id IS NOT NULL").groupBy(w.alias("w"), "video_id").agg(F.count("*").alias("n"), F.min("views").alias("least"), F.max("views").alias("most"))
    return got.select("video_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "least", "most")
