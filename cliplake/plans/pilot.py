"""The batch lifecycle as one plan: sources, cohort, stages, records, index, metrics, reviews, gate.

    python -m cliplake.plans.pilot SOURCES COHORT.json OUT --stages package.module:function

Below OUT: ledger (every call, kept batch by batch), calls/<run>/<stage> (what each
stage returned, written before anything reads it, so that every stage is called once
a video), records (one row per video
and run, appended), index (rebuilt from the latest record of every video),
rejections and ingestion_failures (logs), manual_review and report."""

from __future__ import annotations

import argparse
import importlib
import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.functions import scalars as S
from cliplake.operators import cohort, contracts, metrics, relational
from cliplake.sources import calls, ledger, readers, writers

VERSION = "pilot-1.0.0"
#: What a stage returns for a video. facts are passed on to later stages and end up in the record.
STAGE = "url string, video_id string, usage_cost_usd double, latency_seconds double, model_id string, prompt_version string, schema_version string, schema_valid boolean, facts map<string,string>"
#: Facts that the index has columns for.
FACTS = {"creator_id": "string", "creator_handle": "string", "published_at": "string", "duration_seconds": "double", "observed_at": "string", "views": "bigint", "likes": "bigint", "comments": "bigint", "shares": "bigint", "creative_ir_path": "string", "canonical_ir_path": "string", "source_hash": "string", "video_hash": "string"}
RECORD = (
    "url string, video_id string, cohort_id string, cohort_version string, status string, failure struct<stage:string,category:string,message:string>, failure_category string, schema_valid boolean, "
    "total_usage_cost_usd double, total_latency_seconds double, stage_costs map<string,double>, stage_latencies map<string,double>, model_ids map<string,string>, prompt_versions map<string,string>, schema_versions map<string,string>, stage_status map<string,string>, "
    + ", ".join(f"{k} {v}" for k, v in FACTS.items())
    + ", pipeline_version string, run_id string, recorded_at string"
)


@dataclass(frozen=True)
class FrameStage:
    """A stage that is a plan over the videos left (url, video_id, facts and the entry's columns) instead of a function of one."""

    plan: Callable[[DataFrame], DataFrame]


def run_stages(entries: DataFrame, stages: dict[str, Callable[[dict], dict] | FrameStage], path: str, retry: calls.Retry = calls.Retry(), ledger_path: str | None = None, fresh: bool = False, batch_rows: int = ledger.BATCH) -> DataFrame:
    """A row per video and stage, up to the first stage that fails: STAGE, ok, error_category, error_message, attempts, stage, position.

    Each stage is written below `path` before the next one or the result reads it.
    With ledger_path, calls are kept there batch by batch, and those of earlier runs
    that went well for the same input are not made again, unless `fresh`."""
    spark, rows = entries.sparkSession, None
    left = entries if "facts" in entries.columns else entries.withColumn("facts", F.create_map().cast("map<string,string>"))
    names = [f.name for f in spark.createDataFrame([], STAGE).schema]
    for k, (name, stage) in enumerate(stages.items()):
        if isinstance(stage, FrameStage):
            got = stage.plan(left)
        else:
            one = lambda row, f=stage: _merged(row, f(row))
            got = ledger.call(left, one, STAGE, ledger_path, name, "url", retry, "unexpected", batch_rows, fresh=fresh) if ledger_path else calls.call_out(left, one, STAGE, retry, "unexpected")
        got = _conform(got, names)
        where = f"{path}/{name}"
        got.withColumns({"stage": F.lit(name), "position": F.lit(k)}).write.mode("errorifexists").parquet(where)
        got = spark.read.parquet(where)
        rows = got if rows is None else rows.unionByName(got)
        passed = got.where("ok").select(F.col("url").alias("_url"), F.col("video_id").alias("_id"), F.col("facts").alias("_facts"))
        rest = [c for c in left.columns if c not in ("video_id", "facts")]
        left = left.join(passed, F.col("url") == F.col("_url")).select(*rest, F.coalesce("_id", "video_id").alias("video_id"), F.coalesce("_facts", "facts").alias("facts"))
    return rows


def _merged(row: dict, got: dict) -> dict:
    facts = {**dict(row.get("facts") or {}), **{k: None if v is None else str(v) for k, v in (got.get("facts") or {}).items()}}
    return {**got, "facts": facts}


def _conform(got: DataFrame, names: list[str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in got.sparkSession.createDataFrame([], f"{STAGE}, {calls.CALLED}").schema}
    return got.select(*[(F.col(n) if n in got.columns else F.lit(None)).cast(kinds[n]).alias(n) for n in [*names, "ok", "error_category", "error_message", "attempts", "errors"]])


def manifests(stages: DataFrame) -> DataFrame:
    """Per url: video_id, status, failure, failure_category, totals and maps of its stages, and the facts."""
    failed = F.when(~F.col("ok"), F.struct("position", "stage", F.col("error_category").alias("category"), F.coalesce("error_message", F.lit("")).alias("message")))
    last = lambda c: F.max_by(c, F.when(c.isNotNull(), F.col("position")))
    facts = [last(F.try_element_at("facts", F.lit(k))).alias(k) for k in FACTS]
    status = F.map_from_entries(F.array_sort(F.collect_list(F.struct("stage", F.when(F.col("ok"), "ok").otherwise("failed").alias("status"))))).alias("stage_status")
    state = stages.groupBy("url").agg(last(F.col("video_id")).alias("video_id"), F.min(failed).alias("f"), F.coalesce(F.bool_and("schema_valid"), F.lit(False)).alias("valid"), status, *facts)
    state = state.withColumn("status", F.coalesce(S.stage_failure(F.col("f.stage")), F.lit("success")))
    failure = F.when(F.col("f").isNotNull(), F.struct("f.stage", "f.category", "f.message"))
    state = state.select("url", "video_id", "status", failure.alias("failure"), F.col("f.category").alias("failure_category"), (F.col("valid") & (F.col("status") == "success")).alias("schema_valid"), "stage_status", *[F.col(k).try_cast(v).alias(k) for k, v in FACTS.items()])
    return state.join(metrics.manifest_rollup(stages, "url"), "url")


def records(spark: SparkSession, out: str) -> DataFrame:
    """All records below out; none before the first run."""
    try:
        return spark.read.schema(RECORD).parquet(f"{out}/records")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], RECORD)


def latest_records(spark: SparkSession, out: str) -> DataFrame:
    """The last record of each video; of one run's records of several urls, that of the last url."""
    return relational.latest(records(spark, out), "video_id", ["recorded_at", "run_id", "url"])


def run(
    spark: SparkSession,
    sources: str,
    policy: cohort.Policy,
    stages: dict[str, Callable[[dict], dict] | FrameStage],
    out: str,
    reviews: str | None = None,
    resume: bool = True,
    reprocess: bool = False,
    retry: calls.Retry = calls.Retry(),
    hosts: tuple[str, ...] | None = None,
    batch_rows: int = ledger.BATCH,
) -> DataFrame:
    """Runs the stages for the accepted entries and returns the one-row report.

    With resume, videos whose latest record below `out` is a success are not run
    again, but count; reprocess runs all. Calls are kept in batches of batch_rows
    below out/ledger: after a run that was killed, a stage goes on behind its last
    batch. With hosts, a url must be on one of
    them, else it fails in ingestion as invalid_url. The report is over the latest
    records of all runs, the rejections of this one and its failures without a
    video_id."""
    now, run_id = datetime.now(UTC), None
    run_id = f"{now:%Y%m%dT%H%M%SZ}_{uuid4().hex[:8]}"
    stamp = now.isoformat()
    every = cohort.guard_size(readers.source_list(spark, sources), policy)
    known = S.video_id(F.col("url"), hosts) if hosts else S.last_segment(F.col("url"))
    every = every.withColumn("video_id", F.coalesce("video_id", known))
    requested = every.count()
    todo = relational.pending(every, latest_records(spark, out), "video_id", reprocess) if resume else every
    decided = cohort.decide(todo, policy)
    rejected = decided.where("NOT accepted").select("url", "video_id", "reason", F.lit(policy.cohort_id).alias("cohort_id"), F.lit(policy.version).alias("cohort_version"), F.lit(stamp).alias("rejected_at"))
    writers.append_log(rejected, f"{out}/rejections/{run_id}")
    accepted = decided.where("accepted").drop("reason", "accepted")
    if hosts:
        first = next(iter(stages))
        stages = {**stages, first: _guarded(stages[first], hosts)}
    run_stages(accepted, stages, f"{out}/calls/{run_id}", retry, f"{out}/ledger", reprocess or not resume, batch_rows)
    rows = None
    for name in stages:
        got = spark.read.parquet(f"{out}/calls/{run_id}/{name}")
        rows = got if rows is None else rows.unionByName(got)
    held = manifests(rows).withColumns({"cohort_id": F.lit(policy.cohort_id), "cohort_version": F.lit(policy.version), "pipeline_version": F.lit(VERSION), "run_id": F.lit(run_id), "recorded_at": F.lit(stamp)})
    named = [f.name for f in spark.createDataFrame([], RECORD).schema]
    writers.writing(f"{out}/records", lambda: held.where("video_id IS NOT NULL").select(*named).write.mode("append").parquet(f"{out}/records"))
    lost = held.where("video_id IS NULL")
    writers.append_log(lost.select("url", "video_id", "status", "failure_category", F.col("failure.message").alias("message"), F.lit(stamp).alias("failed_at")), f"{out}/ingestion_failures/{run_id}")

    latest = latest_records(spark, out)
    index = latest.withColumn("source_url", F.col("url"))
    writers.write_index(writers.index_rows(index), f"{out}/index", -(-latest.count() // writers.INDEX_ROWS))
    outcome = latest.select("video_id", "url", "status", "failure_category", "schema_valid", "total_latency_seconds", "total_usage_cost_usd")
    missed = relational.unrecorded(lost.select("video_id", "url", "status", "failure_category"), spark.read.parquet(f"{out}/index"))
    outcome = outcome.unionByName(missed, allowMissingColumns=True).unionByName(rejected.select("video_id", "url", F.lit("rejected_by_cohort").alias("status")), allowMissingColumns=True)
    report = build_report(outcome, requested, readers.reviews(spark, reviews) if reviews else None, stamp)
    if reviews:
        report.select("manual_review.*").write.mode("overwrite").option("ignoreNullFields", "false").json(f"{out}/manual_review")
    report.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{out}/report")
    return spark.read.schema(report.schema).json(f"{out}/report")


def _guarded(stage: Callable[[dict], dict] | FrameStage, hosts: tuple[str, ...]) -> Callable[[dict], dict] | FrameStage:
    if isinstance(stage, FrameStage):
        return stage

    def run(row: dict) -> dict:
        from urllib.parse import urlsplit

        parts = urlsplit(row["url"])
        if parts.scheme not in ("http", "https") or (parts.hostname or "").lower() not in hosts:
            raise calls.Failure(f"not a url of an allowed host: {row['url']}", "invalid_url", "ingest")
        return stage(row)

    return run


def build_report(rows: DataFrame, requested: int, reviews: DataFrame | None = None, generated_at: str | None = None) -> DataFrame:
    """One row: run metrics, manual_review, error_counts_by_category, gate_decision, gate_blockers, generated_at. rows: as for metrics.run_metrics()."""
    spark = rows.sparkSession
    total = metrics.run_metrics(rows, requested)
    scored = reviews if reviews is not None else spark.createDataFrame([], readers.REVIEW)
    said = metrics.review_error_counts(scored)
    counts = metrics.merge_counts(metrics.error_counts(rows), said)
    counts = counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("error_counts_by_category"))
    gate = metrics.gate(total, metrics.review_summary(scored), said).withColumnsRenamed({"decision": "gate_decision", "blockers": "gate_blockers"})
    one = lambda df: df.withColumn("_k", F.lit(1))
    report = one(total).join(one(metrics.manual_review(scored)), "_k").join(one(counts), "_k").join(one(gate), "_k").drop("_k")
    return report.withColumn("generated_at", F.lit(generated_at or datetime.now(UTC).isoformat()))


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("sources")
    p.add_argument("cohort")
    p.add_argument("out")
    p.add_argument("--stages", required=True, help="module:function that returns {stage: callable}")
    p.add_argument("--reviews")
    p.add_argument("--no-resume", action="store_true", help="run videos again that have a success on record")
    p.add_argument("--reprocess", action="store_true", help="the same")
    p.add_argument("--max-attempts", type=int, default=3)
    p.add_argument("--backoff-seconds", type=float, default=1.0)
    a = p.parse_args()
    module, name = a.stages.split(":")
    spark = SparkSession.builder.appName("pilot").getOrCreate()
    policy = load_cohort(a.cohort)
    stages = getattr(importlib.import_module(module), name)()
    report = run(spark, a.sources, policy, stages, a.out, a.reviews, not a.no_resume, a.reprocess, calls.Retry(a.max_attempts, a.backoff_seconds))
    print(report.toJSON().first())


def load_cohort(path: str) -> cohort.Policy:
    """The policy in a JSON file; says so if there is none."""
    if not Path(path).is_file():
        raise FileNotFoundError(f"cohort config not found: {path}")
    return cohort.Policy.from_dict(json.loads(Path(path).read_text()))


def load_validated_config(spark: SparkSession, path: str, platform: str = contracts.PLATFORM, approved: bool = False) -> cohort.Policy:
    """The policy of a full cohort config that fits its contract; all violations, sorted, are in the error if it doesn't. With approved, it must be that too."""
    if not Path(path).is_file():
        raise FileNotFoundError(f"cohort config not found: {path}")
    text = Path(path).read_text()
    row = spark.createDataFrame([(text,)], "raw string").select(contracts.violations(F.try_parse_json("raw"), "pilot_cohort", platform).alias("v"))
    found = sorted(f"{v['path']}: {v['message']}" for v in row.collect()[0]["v"])
    if found:
        raise ValueError("; ".join(found))
    policy = cohort.Policy.from_dict(json.loads(text))
    return policy.require_approved() if approved else policy


if __name__ == "__main__":
    main()
