"""Cut detection by content threshold, over a table of features per frame.

The score of a frame is the weighted mean of how far its features lie from those of
the frame before. A cut is a frame whose score reaches the threshold, at least
min_scene_length frames after the cut before it (or the first frame)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliplake.operators import series
from cliplake.operators.perception import Detector

#: Features and their weights.
WEIGHTS = {"hue": 1.0, "saturation": 1.0, "luma": 1.0}
#: Frames of a stretch.
STRETCH = 4096


def frame_scores(features: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """video_id, frame, score: 0 for a video's first frame. features: video_id, frame (one row each) and the weighted columns."""
    rows = series.lagged(features.select("video_id", "frame", *weights), "video_id", "frame", ["frame", *weights], STRETCH)
    moved = sum((F.lit(w) * F.abs(F.col(c) - F.col(f"prev_{c}")) for c, w in weights.items()), F.lit(0.0)) / F.lit(sum(weights.values()))
    return rows.select("video_id", "frame", F.when(F.col("prev_frame").isNull(), 0.0).otherwise(moved).alias("score"))


def cuts(features: DataFrame, detector: Detector = Detector(), weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """video_id, frame: the first frames of all scenes but the first. A null feature is no cut."""
    least = max(1, detector.min_scene_length)
    first = features.groupBy(F.col("video_id").alias("_id")).agg(F.min("frame").alias("first"))
    above = frame_scores(features, weights).where(F.col("score") >= detector.threshold)
    above = above.join(first, F.col("video_id").eqNullSafe(F.col("_id"))).where(F.col("frame") - F.col("first") >= least).select("video_id", F.col("frame").cast("bigint").alias("frame"))
    # behind a gap of the least length a candidate is a cut whatever came before
    cut = series.runs(above, "video_id", "frame", least, STRETCH, closed=True)
    kind = dict(features.dtypes)["video_id"]

    def step():
        last: list[int] = []

        def take(row) -> list[tuple]:
            video, frame, _ = row
            if last and frame - last[0] < least:
                return []
            last[:] = [frame]
            return [(video, frame)]

        return take, lambda: []

    return series.scan(cut, ["video_id", "run"], ["frame"], step, f"video_id {kind}, frame bigint")


def detect(features: DataFrame, facts: DataFrame, detector: Detector = Detector(), weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """video_id, ok, cuts: what perception.shots() takes. facts: video_id, fps; a scene ends where the next begins, the last one at the end of the last frame.

    A video's scenes are one row: their number is bounded by its length over the least scene length."""
    ends = features.groupBy("video_id").agg(F.min("frame").alias("low"), F.max("frame").alias("high"))
    found = cuts(features, detector, weights).groupBy("video_id").agg(F.array_sort(F.collect_list("frame")).alias("found"))
    rows = ends.join(found, "video_id", "left").join(facts.select("video_id", "fps"), "video_id")
    rate = F.coalesce("fps", F.lit(30.0))
    begins = F.concat(F.array("low"), F.coalesce("found", F.array().cast("array<bigint>")))
    rows = rows.withColumn("begins", begins).withColumn("rate", rate)
    scene = lambda b, i: F.struct((b / F.col("rate")).alias("start_seconds"), (F.coalesce(F.get("begins", i + 1), F.col("high") + 1) / F.col("rate")).alias("end_seconds"), b.cast("bigint").alias("start_frame"), F.coalesce(F.get("begins", i + 1), F.col("high") + 1).cast("bigint").alias("end_frame"))
    one = F.size("begins") == 1  # perception.shots() makes the one shot of a video without cuts
    return rows.select("video_id", F.lit(True).alias("ok"), F.when(one, F.array().cast("array<struct<start_seconds:double,end_seconds:double,start_frame:bigint,end_frame:bigint>>")).otherwise(F.transform("begins", scene)).alias("cuts"))
