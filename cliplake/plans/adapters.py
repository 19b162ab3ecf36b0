"""The default stages of a pilot: the components of this library, wired to injected tools.

Each stage is a plan over all videos that are left, and gives one row a video with
what the record needs. Failures keep their categories."""

from __future__ import annotations

import shutil
import subprocess
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliplake.operators import contracts, ingest, normalize, perception, project, validate
from cliplake.plans import multistep
from cliplake.plans.config import RunConfig
from cliplake.plans.pilot import FrameStage
from cliplake.sources import calls

# What a snapshot must hold.
REQUIRED = ("schema.name", "schema.version", "platform", "video_id", "observed_at", "metrics.views", "metrics.likes", "metrics.comments", "metrics.shares", "collector.name")


def find_tool(name: str, flag: str = "-version") -> tuple[str, str]:
    """(path, first line of its version) of a program that executors need; a failure of category prober_unavailable if it isn't there."""
    path = shutil.which(name)
    if path is None:
        raise calls.Failure(f"{name} is not on the path", "prober_unavailable", "perception")
    done = subprocess.run([path, flag], capture_output=True, text=True, timeout=30)
    return path, (done.stdout or done.stderr).split("\n", 1)[0]


@dataclass(frozen=True)
class Tools:
    """What a run gets from outside. video_path, with %s for the id, is where collectors leave a video for the other tools."""

    collectors: list[tuple[str, Callable[[str], dict]]]
    prober: Callable[[str], str]
    detector: Callable[[str], list[dict]]
    extract: Callable[[str, float], str | None]
    model: Callable
    hosts: tuple[str, ...]
    url_pattern: str
    video_path: str
    platform: str = contracts.PLATFORM
    config: RunConfig = RunConfig()
    retry: calls.Retry = field(default_factory=calls.Retry)


def _facts(**cells: Column) -> Column:
    every = F.create_map(*[x for k, v in cells.items() for x in (F.lit(k), v.cast("string"))])
    return F.map_filter(every, lambda k, v: v.isNotNull())


def _with(more: Column) -> Column:
    """The facts so far and more, of which the later ones count."""
    return F.map_concat(F.map_filter("facts", lambda k, v: ~F.array_contains(F.map_keys(more), k)), more)


def dig(facts: Column, key: str) -> Column:
    """A nested value by its dotted path, null if any part is absent."""
    return F.try_element_at(facts, F.lit(key))


def ingest_stage(tools: Tools, out: str) -> FrameStage:
    def plan(rows: DataFrame) -> DataFrame:
        handle = F.col("creator_handle") if "creator_handle" in rows.columns else F.lit(None).cast("string")
        got = ingest.run(rows.select("url", handle.alias("creator_handle")), tools.collectors, f"{out}/raw", tools.hosts, tools.url_pattern, tools.retry)
        metadata = normalize.to_json(F.struct(*ingest.FIELDS))
        facts = _facts(**{c: F.col(c) for c in ("creator_id", "creator_handle", "published_at", "duration_seconds", *normalize.COUNTS)}, metadata=metadata, video_hash=F.col("sha256"), source_hash=F.sha2(metadata, 256))
        return got.select("url", "video_id", "ok", "error_category", "error_message", F.when(F.col("ok"), facts).alias("facts"))

    return FrameStage(plan)


def snapshot_stage(tools: Tools, observed_at: Callable[[], str]) -> FrameStage:
    """Performance snapshots from the ingested fields; one that lacks what it must hold is a contract_violation. A negative age is an error, as the contract says."""

    def plan(rows: DataFrame) -> DataFrame:
        stamp = observed_at()
        cells = {c: dig(F.col("facts"), c).try_cast("bigint") for c in normalize.COUNTS}
        got = rows.select("url", "video_id", "facts", F.lit(stamp).alias("observed_at"), dig(F.col("facts"), "published_at").alias("published_at"), *[v.alias(k) for k, v in cells.items()])
        got = project.performance_snapshot(got, tools.platform)
        p = F.col("performance")
        lacking = validate.missing_fields({"video_id": F.col("video_id"), "observed_at": F.col("observed_at"), **{f"metrics.{m}": p["metrics"][m] for m in ("views", "likes", "comments", "shares")}})
        bad = F.col("performance_error").isNull() & (F.size(lacking) > 0)
        category = F.when(F.col("performance_error") == "video_id is missing", "missing_video_id").when(F.col("performance_error").isNotNull(), "bad_timestamp").when(bad, "contract_violation")
        message = F.coalesce("performance_error", F.when(bad, F.concat(F.lit("snapshot missing required fields: "), F.array_join(lacking, ", "))))
        return got.select("url", "video_id", category.isNull().alias("ok"), category.alias("error_category"), message.alias("error_message"), F.lit("0.1").alias("schema_version"), _with(_facts(observed_at=F.col("observed_at"))).alias("facts"))

    return FrameStage(plan)


def perception_stage(tools: Tools, out: str) -> FrameStage:
    def plan(rows: DataFrame) -> DataFrame:
        media = rows.select("video_id", F.format_string(tools.video_path, F.col("video_id")).alias("path"), dig(F.col("facts"), "video_hash").alias("sha256"))
        got = perception.run(media, tools.prober, tools.detector, tools.extract, f"{out}/perception", retry=tools.retry)
        got = got.select(F.col("video_id").alias("_id"), "ok", "error_category", "error_message", F.col("pipeline_version").alias("schema_version"), "shot_count", "frame_count")
        return rows.join(got, F.col("video_id") == F.col("_id")).select("url", "video_id", "ok", "error_category", "error_message", "schema_version", _with(_facts(shot_count=F.col("shot_count"), frame_count=F.col("frame_count"))).alias("facts"))

    return FrameStage(plan)


def decompile_stage(tools: Tools, out: str) -> FrameStage:
    """The two-pass run. A run that fails after the model has answered keeps its answers."""

    def plan(rows: DataFrame) -> DataFrame:
        spark = rows.sparkSession
        read = lambda n: spark.read.parquet(f"{out}/perception/{n}")
        facts = read("media_facts").where("ok").select(F.col("video_id").alias("_id"), "media_facts")
        videos = rows.select("video_id", "url", F.col("facts").alias("_f")).join(facts, F.col("video_id") == F.col("_id"))
        meta = F.parse_json(normalize.to_json(F.struct("video_id", F.col("url").alias("source_url"), dig(F.col("_f"), "creator_handle").alias("creator_handle"), dig(F.col("_f"), "published_at").alias("published_at"), F.get_json_object(dig(F.col("_f"), "metadata"), "$.caption").alias("caption")), False))
        videos = videos.select("video_id", F.format_string(tools.video_path, F.col("video_id")).alias("path"), "media_facts", meta.alias("source_metadata"))
        frames = read("frames").where("ok").select("video_id", "shot_id", "path", "timestamp_seconds", "frame_index")
        got = multistep.run(videos, read("shots"), frames, tools.model, f"{out}/runs", tools.config, platform=tools.platform, url_pattern=tools.url_pattern, sleep=tools.retry.sleep)
        provider = F.col("status").isin("synthesis_call") | F.get("errors", F.lit(0))["message"].startswith("shot call")
        category = F.when(F.coalesce(provider, F.lit(False)), "model_provider").when(F.col("status") != "complete", "model_or_validation")
        where = lambda name: F.when(category.isNull(), F.concat(F.lit("runs/"), "run_id", F.lit(f"/runs#{name}:"), "video_id"))
        got = got.select(
            F.col("video_id").alias("_id"),
            category.isNull().alias("ok"),
            category.alias("error_category"),
            F.when(category.isNotNull(), F.concat(F.col("status"), F.lit(": "), F.array_join(F.transform("errors", lambda e: e["message"]), "; "))).alias("error_message"),
            F.col("usage.total_cost_usd").alias("usage_cost_usd"),
            F.col("usage.total_latency_seconds").alias("latency_seconds"),
            F.lit(f"{tools.config.model_id} (pass A) + {tools.config.synthesis_model} (pass B)").alias("model_id"),
            F.lit(f"{tools.config.prompt_version} (pass A) + {tools.config.synthesis_prompt_version} (pass B)").alias("prompt_version"),
            _facts(creative_ir_path=where("document"), canonical_ir_path=where("canonical"), run_id=F.col("run_id"), validation=F.to_json("validation")).alias("_more"),
        )
        return rows.join(got, F.col("video_id") == F.col("_id")).select("url", "video_id", "ok", "error_category", "error_message", "usage_cost_usd", "latency_seconds", "model_id", "prompt_version", F.lit("0.1").alias("schema_version"), _with(F.col("_more")).alias("facts"))

    return FrameStage(plan)


def projection_stage() -> FrameStage:
    """Whether the run left both documents and a validation that says valid; unreadable counts as not valid."""

    def plan(rows: DataFrame) -> DataFrame:
        f = F.col("facts")
        needed = ("validation", "creative_ir_path", "canonical_ir_path")
        missing = F.filter(F.array(*[F.when(dig(f, k).isNull(), F.lit(k)) for k in needed]), lambda x: x.isNotNull())
        said = F.try_parse_json(dig(f, "validation"))
        valid = F.coalesce(F.try_variant_get(said, "$.valid", "boolean"), F.lit(False))
        category = F.when(F.size(missing) > 0, "missing_artifacts").when(~valid, "validation_failed")
        message = F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", "))).when(~valid, F.coalesce(F.get_json_object(dig(f, "validation"), "$.errors"), F.lit("[]")))
        return rows.select("url", "video_id", category.isNull().alias("ok"), category.alias("error_category"), message.alias("error_message"), category.isNull().alias("schema_valid"), F.lit("0.1").alias("schema_version"), "facts")

    return FrameStage(plan)


def default_stages(tools: Tools, out: str, observed_at: Callable[[], str]) -> dict[str, FrameStage]:
    """ingest, performance_snapshot, perception, decompile, project_canonical. `out` should be of this run alone."""
    return {"ingest": ingest_stage(tools, out), "performance_snapshot": snapshot_stage(tools, observed_at), "perception": perception_stage(tools, out), "decompile": decompile_stage(tools, out), "project_canonical": projection_stage()}
