"""The artifacts that a run leaves for each video, as rows of record folders, from the run's tables.

    folders.RecordFolders is registered, then
    write(two_pass(spark, f"{out}/{run_id}", run_id, videos), path)

An artifact is never overwritten: what is there stays, and another content is told
as a mismatch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.functions import scalars as S
from cliplake.plans.config import RunConfig
from cliplake.plans.multistep import summary
from cliplake.sources.folders import RecordFolders
from cliplake.sources.writers import pretty_json

# Where the artifacts of a run stand below a video's folder, and their names.
SINGLE_PASS = "decompilation/single_pass"
TWO_PASS = "decompilation/multi_step"
SINGLE_NAMES = ("prompt.txt", "request.json", "response.raw.txt", "response.parsed.json", "validation.json", "usage.json", "evaluation.json")
TWO_PASS_NAMES = ("media_facts.json", "shots.json", "shot_analysis/request_%03d.json", "shot_analysis/response_%03d.raw.txt", "shot_analysis/response_%03d.parsed.json", "synthesis/prompt.txt", "synthesis/request.json", "synthesis/response.raw.txt", "synthesis/response.parsed.json", "creative_ir.json", "canonical_ir.json", "validation.json", "usage.json", "evaluation.json", "comparison_vs_single_pass.json")


def _rows(table: DataFrame, where: str, name: str, content: Column) -> DataFrame:
    """video_id, artifact, content; a name with a number takes the row's batch. Null content is no artifact."""
    artifact = F.format_string(f"{where}/{name}", F.col("batch")) if "%" in name else F.lit(f"{where}/{name}")
    return table.select(F.col("video_id").cast("string").alias("video_id"), artifact.alias("artifact"), content.alias("content")).where("content IS NOT NULL")


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _struct(table: DataFrame, *columns: str | Column) -> Column:
    """Indented JSON of a struct of columns, keys in order."""
    held = table.select(F.struct(*columns).alias("x"))
    kind = held.schema["x"].dataType
    from cliplake.sources.writers import _sorted

    return F.to_json(_sorted(F.struct(*columns), kind), {"ignoreNullFields": "false", "pretty": "true"})


def _parsed(raw: Column) -> Column:
    """What a raw answer says, as JSON; `null` if it is no JSON object."""
    return F.when(raw.isNotNull(), F.coalesce(F.to_json(S.parse_object_lenient(raw)), F.lit("null")))


def two_pass(spark: SparkSession, root: str, run_id: str, videos: DataFrame, comparison: DataFrame | None = None, config: RunConfig = RunConfig()) -> DataFrame:
    """Artifacts of multistep.run() below `root`. videos: video_id, media_facts (struct); comparison: video_id and what is to be told of it.

    A step that a video didn't reach has no artifact."""
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    where, n = f"{TWO_PASS}/{run_id}", TWO_PASS_NAMES
    asked, said, second, answers, runs = (read(x) for x in ("shot_requests", "shot_answers", "synthesis_requests", "synthesis_answers", "runs"))
    settings = F.lit(str(config.generation_settings())).alias("generation_settings")
    measured = asked.select("video_id", F.explode("shots").alias("s")).groupBy("video_id").agg(F.array_sort(F.collect_list("s")).alias("shots"))
    parts = [
        _rows(videos, where, n[0], pretty_json(videos, "media_facts")),
        _rows(measured, where, n[1], _struct(measured, "shots")),
        _rows(asked, where, n[2], _struct(asked, F.lit(config.model_id).alias("model_id"), F.lit(config.prompt_version).alias("prompt_version"), settings, "prompt", summary(F.col("parts")).alias("parts"))),
        _rows(said, where, n[3], F.col("raw")),
        _rows(said, where, n[4], _parsed(F.col("raw"))),
        _rows(second, where, n[5], F.col("prompt")),
        _rows(second, where, n[6], _struct(second, F.lit(config.synthesis_model).alias("model_id"), F.lit(config.synthesis_prompt_version).alias("prompt_version"), settings, summary(F.col("parts")).alias("parts"))),
        _rows(answers, where, n[7], F.col("raw")),
        _rows(answers, where, n[8], _parsed(F.col("raw"))),
        _rows(runs, where, n[9], F.col("document")),
        _rows(runs, where, n[10], F.col("canonical")),
        _rows(runs, where, n[11], pretty_json(runs, "validation")),
        _rows(runs, where, n[12], pretty_json(runs, "usage")),
        _rows(runs.where("evaluation IS NOT NULL"), where, n[13], pretty_json(runs, "evaluation")),
    ]
    if comparison is not None:
        parts.append(_rows(comparison, where, n[14], _struct(comparison, *[c for c in comparison.columns if c != "video_id"])))
    return _all(parts)


def single_pass(spark: SparkSession, root: str, run_id: str, evaluations: DataFrame | None = None, config: RunConfig = RunConfig()) -> DataFrame:
    """Artifacts of multistep.single_pass() below `root`. evaluations: video_id and the evaluation's columns, once there are some."""
    where, n = f"{SINGLE_PASS}/{run_id}", SINGLE_NAMES
    requests, runs = spark.read.parquet(f"{root}/requests"), spark.read.parquet(f"{root}/runs")
    tokens = F.struct("input_tokens", "output_tokens", "total_tokens").alias("usage")
    prices = [F.lit(config.input_per_mtok_usd).cast("double").alias("pricing_input_per_mtok_usd"), F.lit(config.output_per_mtok_usd).cast("double").alias("pricing_output_per_mtok_usd")]
    parts = [
        _rows(requests, where, n[0], F.col("prompt")),
        _rows(requests, where, n[1], _struct(requests, "video_id", F.lit(config.provider).alias("provider"), F.lit(config.model_id).alias("model_id"), F.lit(config.prompt_version).alias("prompt_version"), F.col("settings").alias("generation_settings"), F.lit(True).alias("single_call"), F.col("summary").alias("parts"))),
        _rows(runs, where, n[2], F.col("raw")),
        _rows(runs, where, n[3], _parsed(F.col("raw"))),
        _rows(runs, where, n[4], pretty_json(runs, "validation")),
        _rows(runs, where, n[5], _struct(runs, tokens, "latency_seconds", "cost_usd", *prices)),
    ]
    if evaluations is not None:
        parts.append(_rows(evaluations, where, n[6], _struct(evaluations, *[c for c in evaluations.columns if c != "video_id"])))
    return _all(parts)


def write(rows: DataFrame, path: str) -> None:
    """Rows (video_id, artifact, content) as files below path, each if none is there."""
    rows.sparkSession.dataSource.register(RecordFolders)
    rows.write.format(RecordFolders.name()).mode("append").save(path)
