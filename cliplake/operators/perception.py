"""Perception: media facts, shots and representative frames. Prober, detector and frame extractor are injected functions; what they return is put in order here."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliplake.functions import scalars as S
from cliplake.operators import normalize, relational
from cliplake.sources import calls

VERSION = "v1"
CUTS = "video_id string, path string, cuts array<struct<start_seconds:double,end_seconds:double,start_frame:bigint,end_frame:bigint>>"
FRAME = "video_id string, shot_id string, path string, timestamp_seconds double, frame_index bigint"


@dataclass(frozen=True)
class Detector:
    """What a shot detector is run with; stored beside its result."""

    name: str = "content"
    version: str | None = None
    threshold: float = 27.0
    min_scene_length: int = 15

    def to_parameters(self) -> dict:
        return {k: v for k, v in asdict(self).items() if k not in ("name", "version")}


def probe(media: DataFrame, prober: Callable[[str], str], retry: calls.Retry = calls.Retry()) -> DataFrame:
    """media (video_id, path, sha256) with media_facts, from the JSON that prober(path) returns; ok, error_category and error_message say what failed."""

    def one(row: dict) -> dict:
        return {"probe_json": prober(row["path"])}

    got = calls.call_out(media.select("video_id", "path", "sha256"), one, "video_id string, path string, sha256 string, probe_json string", retry, "unreadable_media")
    got = normalize.probe_facts(got)
    facts = F.when(F.col("media_facts").isNotNull(), F.col("media_facts").withField("sha256", F.col("sha256")))
    blind = F.col("ok") & F.col("media_facts").isNull()
    category = F.when(blind & S.parse_object(F.col("probe_json")).isNull(), "unreadable_media").when(blind, "no_video_stream").otherwise(F.col("error_category"))
    return got.withColumns({"media_facts": facts, "error_category": category, "error_message": F.when(blind, F.lit("the prober found no video stream")).otherwise(F.col("error_message")), "ok": F.col("ok") & ~blind}).drop("probe_json")


def detect(media: DataFrame, detector: Callable[[str], list[dict]], retry: calls.Retry = calls.Retry()) -> DataFrame:
    """A row a video: video_id, cuts (as detected), ok and errors. detector(path) returns dicts with start and end in seconds and frames."""

    def one(row: dict) -> dict:
        return {"cuts": detector(row["path"])}

    return calls.call_out(media.select("video_id", "path"), one, CUTS, retry, "detector_unavailable")


def shots(detected: DataFrame, facts: DataFrame) -> DataFrame:
    """video_id, shot_id, start_seconds, end_seconds, start_frame, end_frame: the cuts in order, with ids, rounded, the first from 0, the last to the duration; a video without cuts is one shot.

    facts: video_id, duration_seconds, fps."""
    facts = facts.select("video_id", "duration_seconds", "fps")
    good = detected.where("ok").select("video_id", "cuts") if "ok" in detected.columns else detected
    cuts = good.select("video_id", F.posexplode("cuts").alias("position", "c")).select("video_id", "position", "c.*")
    cuts = relational.sequential_ids(cuts, "video_id", ["position"])
    cuts = cuts.withColumns({"start_seconds": F.bround("start_seconds", 6), "end_seconds": F.bround("end_seconds", 6)}).join(facts, "video_id", "left")
    rate = F.coalesce("fps", F.lit(30.0))
    fixed = relational.fix_bounds(cuts.withColumn("_rate", rate).withColumn("_length", F.bround(F.coalesce("duration_seconds", "end_seconds"), 6)), "video_id", ["position"], "_length", "_rate")
    fixed = fixed.withColumn("start_frame", F.when(F.col("position") == 0, F.lit(0)).otherwise(F.col("start_frame")))
    return relational.whole_shots(good.select("video_id").join(facts, "video_id", "left"), fixed, "video_id", "duration_seconds", "fps")


def frames(found: DataFrame, media: DataFrame, extract: Callable[[str, float], str | None], retry: calls.Retry = calls.Retry()) -> DataFrame:
    """FRAME rows, one a shot: extract(path, seconds) returns the path of an image, or None if it can't be decoded there; the places of the seek ladder are tried in order.

    found: shots with video_id and fps; media: video_id, path of the video."""
    mid = S.midpoint(F.col("start_seconds"), F.col("end_seconds"))
    index = F.when(F.col("fps") > 0, S.frame_index(mid, F.col("fps"), F.col("start_frame"), F.col("end_frame"))).otherwise(0).cast("bigint")
    rows = found.join(media.select("video_id", F.col("path").alias("video_path")), "video_id")
    ladder = S.seek_candidates(F.col("start_seconds"), F.col("end_seconds") - F.col("start_seconds"))
    rows = rows.select("video_id", "shot_id", "video_path", ladder.alias("ladder"), index.alias("frame_index"))

    def one(row: dict) -> dict:
        for at in row["ladder"]:
            path = extract(row["video_path"], float(at))
            if path:
                return {"path": path, "timestamp_seconds": float(at)}
        raise calls.Failure(f"no frame of {row['shot_id']} can be decoded", "frame_extraction", "perception")

    return calls.call_out(rows, one, FRAME, retry, "frame_extraction")


def run(media: DataFrame, prober: Callable, detector: Callable, extract: Callable, out: str, config: Detector = Detector(), retry: calls.Retry = calls.Retry()) -> DataFrame:
    """Probe, shots and frames of media (video_id, path, sha256), written below out (media_facts, shots, frames), each before the next reads it.

    Returns video_id, ok, error_category, error_message, shot_count, frame_count,
    detector and parameters: the manifest, which is written too."""
    spark = media.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    probed = kept(probe(media, prober, retry), "media_facts")
    facts = probed.where("ok").select("video_id", "path", "media_facts.duration_seconds", "media_facts.fps")
    cuts = kept(detect(facts, detector, retry), "cuts")
    found = kept(shots(cuts, facts), "shots")
    pictures = kept(frames(found.join(facts.select("video_id", "fps"), "video_id"), facts, extract, retry), "frames")
    bad = probed.where("NOT ok").select("video_id", "error_category", "error_message")
    bad = bad.unionByName(cuts.where("NOT ok").select("video_id", "error_category", "error_message"))
    bad = bad.unionByName(pictures.where("NOT ok").select("video_id", "error_category", "error_message"))
    bad = bad.groupBy("video_id").agg(F.min(F.struct("error_category", "error_message")).alias("e"))
    counts = found.groupBy("video_id").agg(F.count("*").alias("shot_count")).join(pictures.groupBy("video_id").agg(F.count_if("ok").alias("frame_count")), "video_id", "left")
    out_rows = media.select("video_id").join(counts, "video_id", "left").join(bad, "video_id", "left")
    parameters = F.to_json(F.create_map(*[F.lit(str(x)) for kv in config.to_parameters().items() for x in kv]))
    manifest = out_rows.select("video_id", F.col("e").isNull().alias("ok"), F.col("e.error_category").alias("error_category"), F.col("e.error_message").alias("error_message"), "shot_count", "frame_count", F.lit(config.name).alias("detector"), parameters.alias("parameters"), F.lit(VERSION).alias("pipeline_version"))
    return kept(manifest, "manifest")
