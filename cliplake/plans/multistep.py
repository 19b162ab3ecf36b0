"""Model runs over many videos as one plan: two passes (shots, then the whole), or a single one.

The model is an injected function (parts, settings) -> (text, usage); parts are
dicts of mime_type, role, path or text, usage has input_tokens, output_tokens and
total_tokens. What it returns is written, raw, before anything reads it, so that
it is called once a request, whatever fails later. All that follows is columns."""

from __future__ import annotations

import argparse
import importlib
import time
from collections.abc import Callable
from datetime import UTC, datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.functions import scalars as S
from cliplake.operators import contracts, evaluation, merge, metrics, project, relational
from cliplake.plans.config import RunConfig, load
from cliplake.sources import calls, ledger, readers, writers
from cliplake.sources.pacing import Pace

VERSION = "multistep-1.0.0"
PART = "struct<mime_type:string,role:string,path:string,text:string>"
ANSWER = "video_id string, batch int, raw string, input_tokens bigint, output_tokens bigint, total_tokens bigint, latency_seconds double"
_SHOTS = "array<struct<shot_id:string,start_seconds:double,end_seconds:double,start_frame:bigint,end_frame:bigint,representative_frame:struct<path:string,timestamp_seconds:double>>>"


def new_run_id(now: datetime | None = None) -> str:
    return f"{now or datetime.now(UTC):%Y%m%dT%H%M%SZ}_{uuid4().hex[:8]}"


def shot_list(shots: DataFrame, frames: DataFrame) -> DataFrame:
    """A row a shot, with its representative frame if it has one: what a model gets; times are the measured ones."""
    frames = frames.select("video_id", "shot_id", F.col("path").alias("_path"), F.col("timestamp_seconds").alias("_at"), F.col("frame_index").alias("_index"))
    rows = relational.shots_with_frames(shots.select("video_id", "shot_id", "start_seconds", "end_seconds", "start_frame", "end_frame"), frames, ["video_id", "shot_id"], "_index")
    frame = F.when(F.col("_path").isNotNull(), F.struct(F.col("_path").alias("path"), F.col("_at").alias("timestamp_seconds")))
    return rows.withColumn("representative_frame", frame).drop("_path", "_at", "_index")


def _part(mime: str, role: Column | str, path: Column | None = None, text: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit(mime).alias("mime_type"), (F.lit(role) if isinstance(role, str) else role).alias("role"), (none if path is None else path).alias("path"), (none if text is None else text).alias("text"))


def shot_requests(videos: DataFrame, listed: DataFrame, config: RunConfig) -> DataFrame:
    """video_id, batch, shots, prompt, parts: the video, the frames of a batch of shots in order, and the prompt."""
    rows = relational.batches(listed, "video_id", ["shot_id"], config.batch_size)
    fields = [c for c in listed.columns if c != "video_id"]
    rows = rows.groupBy("video_id", F.col("batch").cast("int").alias("batch")).agg(F.array_sort(F.collect_list(F.struct(*fields))).cast(_SHOTS).alias("shots"))
    rows = rows.join(videos.select("video_id", F.col("path").alias("video_path")), "video_id")
    prompt = S.render(config.prompt, {"shot_list": F.to_json("shots")})
    framed = F.filter("shots", lambda s: s["representative_frame"].isNotNull())
    images = F.transform(framed, lambda s: _part("image/jpeg", F.concat(F.lit("frame:"), s["shot_id"]), s["representative_frame"]["path"]))
    rows = rows.withColumn("prompt", prompt)
    return rows.withColumn("parts", F.concat(F.array(_part("video/mp4", "source_video", F.col("video_path"))), images, F.array(_part("text/plain", "prompt", text=F.col("prompt"))))).drop("video_path")


def summary(parts: Column, sizes: Column | None = None) -> Column:
    """(mime_type, role, byte_length) of parts, for the record of a request; lengths of files from a map of path to size."""
    size = lambda p: F.coalesce(F.octet_length(p["text"]), F.try_element_at(sizes, p["path"]).cast("int") if sizes is not None else F.lit(None).cast("int"))
    return F.transform(parts, lambda p: F.struct(p["mime_type"].alias("mime_type"), p["role"].alias("role"), size(p).alias("byte_length")))


class Caller:
    """A model with its settings, as a function of a request's row."""

    def __init__(self, model: Callable, config: RunConfig):
        self.model, self.settings = model, config.generation_settings()

    def __call__(self, row: dict) -> dict:
        parts = [p if isinstance(p, dict) else p.asDict() for p in row["parts"]]
        began = time.monotonic()
        text, usage = self.model(parts, self.settings)
        return {"raw": text, "latency_seconds": round(time.monotonic() - began, 3), **{k: usage.get(k) for k in ("input_tokens", "output_tokens", "total_tokens")}}


def ask(requests: DataFrame, model: Callable, config: RunConfig, path: str, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """ANSWER and how the call went, for requests (video_id, batch, parts), written to `path`.

    Calls are kept in a ledger beside it, batch by batch, so that a run that was
    killed goes on behind its last batch; between any two calls of the cluster
    there is the config's least gap. An answer that is there already stays."""
    if not writers.complete(requests.sparkSession, path):
        pace = Pace(config.min_gap_seconds, config.lanes, sleep=sleep)
        got = ledger.call(requests.select("video_id", "batch", "parts"), Caller(model, config), ANSWER, f"{path}-ledger", "answers", "video_id", calls.Retry(config.max_attempts, 5.0, sleep=sleep), "model_provider", config.ledger_batch, pace)
        got.write.mode("overwrite").parquet(path)
    return requests.sparkSession.read.parquet(path)


def _usage(answers: DataFrame, config: RunConfig, model: str, version: str, label: Column) -> DataFrame:
    price = lambda x: F.lit(x).cast("double")
    cost = S.usage_cost(F.col("input_tokens"), F.col("output_tokens"), price(config.input_per_mtok_usd), price(config.output_per_mtok_usd))
    return answers.select("video_id", label.alias("pass"), F.lit(model).alias("model_id"), F.lit(version).alias("prompt_version"), F.col("input_tokens").alias("tokens_in"), F.col("output_tokens").alias("tokens_out"), "total_tokens", cost.alias("cost_usd"), "latency_seconds")


def _report(passes: DataFrame) -> DataFrame:
    """video_id, usage (struct) of passes."""
    total = metrics.usage_totals(passes, "video_id")
    each = passes.groupBy("video_id").agg(F.count("*").cast("int").alias("model_call_count"), F.sum(F.coalesce("total_tokens", F.lit(0))).alias("total"), F.array_sort(F.collect_list(F.struct("pass", "model_id", "prompt_version", "latency_seconds", "cost_usd"))).alias("passes"))
    tokens = F.create_map(F.lit("input_tokens"), F.col("tokens_in"), F.lit("output_tokens"), F.col("tokens_out"), F.lit("total_tokens"), F.col("total"))
    usage = F.struct("passes", "model_call_count", tokens.alias("total_usage"), F.col("cost_usd").alias("total_cost_usd"), F.col("latency_seconds").alias("total_latency_seconds"))
    return total.join(each, "video_id").select("video_id", usage.alias("usage"))


def run(videos: DataFrame, shots: DataFrame, frames: DataFrame, model: Callable, out: str, config: RunConfig = RunConfig(), synthesis_model: Callable | None = None, include_video: bool = True, platform: str = contracts.PLATFORM, url_pattern: str = "https://video.example/%s", run_id: str | None = None, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """One two-pass run for each of videos (video_id, path, media_facts struct, source_metadata VARIANT), written below out/<run id>: shot_requests, shot_answers, synthesis_requests, synthesis_answers, runs.

    Returns runs: run_id, video_id, status (complete, or the step that failed),
    errors, document, canonical, validation, usage, evaluation. What fails for a
    video is in its row; the raw answers stay. A run that was killed goes on under
    its run_id: what it has written is read, only calls that it lacks are made."""
    spark, run_id = videos.sparkSession, run_id or new_run_id()
    root, stamp = f"{out}/{run_id}", datetime.now(UTC).isoformat()

    def kept(df: DataFrame, name: str) -> DataFrame:
        if not writers.complete(spark, f"{root}/{name}"):
            df.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    listed = shot_list(shots, frames)
    asked = kept(shot_requests(videos, listed, config), "shot_requests")
    said = ask(asked, model, config, f"{root}/shot_answers", sleep)
    parsed = said.join(asked.select("video_id", "batch", "shots"), ["video_id", "batch"]).withColumn("analysis", S.parse_object_lenient(F.col("raw")))
    where = F.concat(F.lit(" (batch "), F.col("batch").cast("string"), F.lit(")"))
    wrong = merge.shot_analysis_errors(F.col("analysis"), F.col("shots"))
    problem = F.when(~F.col("ok"), F.concat(F.lit("shot call"), where, F.lit(": "), F.col("error_message"))).when(F.col("analysis").isNull(), F.concat(F.lit("shot parse failure"), where)).when(F.size(wrong) > 0, F.concat(F.lit("shot response invalid"), where, F.lit(": "), F.array_join(wrong, "; ")))
    parsed = parsed.withColumn("problem", problem)
    items = lambda p: F.transform(F.coalesce(F.try_variant_get("analysis", f"$.{p}", "array<variant>"), F.array().cast("array<variant>")), lambda x: F.to_json(x))
    reference = F.format_string("shot_analysis/response_%03d.raw.txt", F.col("batch"))
    batch = F.struct("batch", items("shots").alias("shots"), items("uncertainties").alias("unsure"), reference.alias("reference"))
    whole = parsed.groupBy("video_id").agg(F.min("problem").alias("shot_problem"), F.array_sort(F.collect_list(batch)).alias("b"))
    joined = lambda f: F.array_join(F.flatten(F.transform("b", lambda x: x[f])), ",")
    whole = whole.select("video_id", "shot_problem", F.concat(F.lit('{"shots":['), joined("shots"), F.lit('],"uncertainties":['), joined("unsure"), F.lit("]}")).alias("analysis_json"), F.transform("b", lambda x: x["reference"]).alias("references"))
    fields = [c for c in listed.columns if c != "video_id"]
    by_video = listed.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).cast(_SHOTS).alias("shots"))
    rows = videos.join(whole, "video_id").join(by_video, "video_id")

    prompt = S.render(config.synthesis_prompt, {"source_metadata": F.to_json("source_metadata"), "media_facts": F.to_json("media_facts"), "shot_list": F.to_json("shots"), "shot_analyses": F.col("analysis_json")})
    video = [_part("video/mp4", "source_video", F.col("path"))] if include_video else []
    second = rows.where("shot_problem IS NULL").withColumn("prompt", prompt)
    second = second.select("video_id", F.lit(0).alias("batch"), "prompt", F.array(*video, _part("text/plain", "prompt", text=F.col("prompt"))).alias("parts"))
    second = kept(second, "synthesis_requests")
    answers = ask(second, synthesis_model or model, config, f"{root}/synthesis_answers", sleep)
    answers = answers.select("video_id", F.col("ok").alias("synthesis_ok"), F.col("error_message").alias("synthesis_error"), S.parse_object_lenient(F.col("raw")).alias("synthesis"))

    rows = rows.join(answers, "video_id", "left").withColumn("analysis", F.try_parse_json("analysis_json"))
    run_block = F.struct(
        F.lit("0.1").alias("schema_version"),
        F.lit(VERSION).alias("pipeline_version"),
        F.lit(f"{config.model_id} (pass A) + {config.synthesis_model} (pass B)").alias("model_id"),
        F.lit(config.provider).alias("provider"),
        F.lit(f"{config.prompt_version} (pass A) + {config.synthesis_prompt_version} (pass B)").alias("prompt_version"),
        F.lit(stamp).alias("created_at"),
        F.lit("automated").alias("annotation_mode"),
    )
    rows = rows.withColumns({"source": merge.source_block(F.col("source_metadata"), F.col("media_facts"), platform, url_pattern), "decompilation": run_block})
    rows = merge.creative_document(rows)
    # what is validated and projected is a document as it is stored: its JSON, with nulls, but for certainties that nobody stated
    text = F.regexp_replace(F.to_json("document", {"ignoreNullFields": "false"}), r',"(?:music|sfx|ambience)_certainty":null', "")
    rows = rows.withColumn("stored", text)
    text = F.col("stored")
    broken = contracts.violations(F.try_parse_json(text), "creative_ir_v0_1", platform)
    rows = rows.withColumn("document_errors", F.when(F.col("document").isNotNull(), broken))
    canonical = project.canonical(F.from_json(text, project.DOCUMENT))
    rows = rows.withColumn("canonical", F.when(F.size("document_errors") == 0, canonical))
    rows = rows.withColumn("canonical_errors", F.when(F.col("canonical").isNotNull(), contracts.violations(F.try_parse_json(F.to_json("canonical", {"ignoreNullFields": "false"})), "canonical_ir_v0_1", platform)))
    failed = F.when(F.col("shot_problem").isNotNull(), "shot_analysis").when(~F.coalesce("synthesis_ok", F.lit(False)), "synthesis_call").when(F.col("synthesis").isNull(), "synthesis_parse").when(F.col("document").isNull(), "merge").when(F.size("document_errors") > 0, "creative_ir_schema").when(F.size("canonical_errors") > 0, "canonical_projection").otherwise("complete")
    plain = lambda m: F.array(F.struct(F.lit("/").alias("path"), m.alias("message")))
    errors = F.when(F.col("status") == "shot_analysis", plain(F.col("shot_problem"))).when(F.col("status") == "synthesis_call", plain(F.col("synthesis_error"))).when(F.col("status") == "synthesis_parse", plain(F.lit("not a JSON object"))).when(F.col("status") == "merge", plain(F.array_join("merge_errors", "; "))).when(F.col("status") == "creative_ir_schema", F.col("document_errors")).when(F.col("status") == "canonical_projection", F.col("canonical_errors")).otherwise(F.array().cast("array<struct<path:string,message:string>>"))
    rows = rows.withColumn("status", failed).withColumn("errors", errors)
    passes = _usage(said, config, config.model_id, config.prompt_version, F.format_string("A_factual_shot_analysis_batch_%03d", F.col("batch")))
    passes = passes.unionByName(_usage(spark.read.parquet(f"{root}/synthesis_answers"), config, config.synthesis_model, config.synthesis_prompt_version, F.lit("B_global_creative_synthesis")))
    rows = rows.join(_report(passes), "video_id", "left")
    complete = rows.withColumn("document", F.when(F.col("status") == "complete", F.col("document")))
    rows = evaluation.scaffold(complete)
    valid = F.struct((F.col("status") == "complete").alias("valid"), F.col("status").alias("stage"), F.col("errors").alias("errors"))
    out_rows = rows.select(F.lit(run_id).alias("run_id"), "video_id", "status", "errors", F.col("stored").alias("document"), F.to_json("canonical", {"ignoreNullFields": "false"}).alias("canonical"), valid.alias("validation"), "usage", "evaluation")
    return kept(out_rows, "runs")


def single_pass(videos: DataFrame, model: Callable, out: str, config: RunConfig = RunConfig(), platform: str = contracts.PLATFORM, run_id: str | None = None, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """One call a video (video_id, path, source_metadata VARIANT): answers that don't parse or fit the contract are recorded as they are, not mended.

    Returns run_id, video_id, raw, validation (valid, errors), tokens, latency and cost; written below out/<run id>."""
    run_id = run_id or new_run_id()
    root = f"{out}/{run_id}"
    prompt = S.render(config.prompt, {"source_metadata": F.to_json("source_metadata")})
    requests = videos.withColumn("prompt", prompt).select("video_id", F.lit(0).alias("batch"), "prompt", F.array(_part("video/mp4", "source_video", F.col("path")), _part("text/plain", "prompt", text=F.col("prompt"))).alias("parts"))
    if not writers.complete(videos.sparkSession, f"{root}/requests"):
        requests.withColumns({"settings": F.lit(str(config.generation_settings())), "summary": summary(F.col("parts"))}).write.mode("overwrite").parquet(f"{root}/requests")
    said = ask(requests, model, config, f"{root}/answers", sleep)
    parsed = S.parse_object(F.col("raw"))
    failed = lambda m: F.struct(F.lit(False).alias("valid"), F.array(F.struct(F.lit("/").alias("path"), m.alias("message"))).alias("errors"))
    validation = F.when(~F.col("ok"), failed(F.concat(F.lit("call failure: "), F.col("error_message")))).when(parsed.isNull(), failed(F.lit("parse failure: not a JSON object"))).otherwise(contracts.verdict(parsed, "single_pass_v0_1", platform))
    cost = S.usage_cost(F.col("input_tokens"), F.col("output_tokens"), F.lit(config.input_per_mtok_usd).cast("double"), F.lit(config.output_per_mtok_usd).cast("double"))
    rows = said.select(F.lit(run_id).alias("run_id"), "video_id", F.lit(config.model_id).alias("model_id"), F.lit(config.prompt_version).alias("prompt_version"), "raw", validation.alias("validation"), "input_tokens", "output_tokens", "total_tokens", "latency_seconds", cost.alias("cost_usd"))
    if not writers.complete(videos.sparkSession, f"{root}/runs"):
        rows.write.mode("overwrite").parquet(f"{root}/runs")
    return videos.sparkSession.read.parquet(f"{root}/runs")


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("videos", help="Parquet with video_id, path, media_facts and source_metadata (JSON text)")
    p.add_argument("perception", help="folder of perception results, one folder a video")
    p.add_argument("out")
    p.add_argument("--model", required=True, help="module:function of (parts, settings)")
    p.add_argument("--config")
    p.add_argument("--compare", help="folder of single-pass evaluations (JSON) to compare with")
    a = p.parse_args()
    module, name = a.model.split(":")
    spark = SparkSession.builder.appName("multistep").getOrCreate()
    videos = spark.read.parquet(a.videos).withColumn("source_metadata", F.try_parse_json("source_metadata"))
    _, shots, frames = readers.perception_inputs(spark, a.perception)
    rows = run(videos, shots, frames, getattr(importlib.import_module(module), name), a.out, load(a.config))
    rows.select("run_id", "video_id", "status", "usage.total_cost_usd").show(truncate=False)
    if a.compare:
        single = evaluation.evaluations(readers.json_documents(spark, a.compare))
        multi = rows.where("status = 'complete'").select("evaluation.*")
        evaluation.write_comparison(single, multi.select(*single.columns), f"{a.out}/comparison").select("video_id", "decision", "follow_up").show(truncate=False)


if __name__ == "__main__":
    main()
