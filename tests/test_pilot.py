"""Merging model output, and the batch lifecycle with fakes."""

import json
import uuid
from collections import Counter

from pyspark.sql import functions as F

from cliplake.operators import cohort, merge, project
from cliplake.plans import pilot
from cliplake.sources import calls

ANALYSIS = {"shots": [{"shot_id": "shot_001", "subjects": ["hand", 5], "actions": [], "visual_description": "d", "framing": "huge", "camera_movement": "pan", "on_screen_text": [{"text": "Buy", "exact": True}, {"text": " "}], "spoken_dialogue": [{"speaker": "a", "text": "hi", "exact": True, "confidence": "low"}], "audio": {"music": "m", "music_certainty": "loud"}, "transition_in": "cut"}]}
SYNTHESIS = {"observed_summary": "s", "hook": {"description": "h", "start_seconds": 0, "end_seconds": 1.5}, "inferred": {"commercial": {"status": "non_commercial", "details": {"offer": "x"}}, "hook_type": {"value": "loud", "confidence": "sure"}, "attention_mechanisms": ["bare", {"label": "l", "confidence": "high"}, 7]}, "generation": {"global_brief": "b", "shots": [{"shot_id": "shot_001", "reconstruction_intent": "x" * 40}], "continuity_constraints": "one"}}


def document(spark, analysis, synthesis):
    rows = spark.createDataFrame([(json.dumps(analysis), json.dumps(synthesis))], "a string, s string")
    shot = F.array(F.struct(F.lit("shot_001").alias("shot_id"), F.lit(0.0).alias("start_seconds"), F.lit(2.0).alias("end_seconds")))
    rows = rows.select(F.parse_json("a").alias("analysis"), F.parse_json("s").alias("synthesis"), shot.alias("shots"), F.struct(F.lit("p").alias("platform"), F.lit("1").alias("video_id"), F.lit(None).cast("string").alias("source_url")).alias("source"), F.struct(F.lit("1").alias("pipeline_version"), F.lit("1").alias("prompt_version"), F.lit("automated").alias("annotation_mode")).alias("decompilation"))
    return merge.creative_document(rows)


def test_merge(spark):
    rows = document(spark, ANALYSIS, SYNTHESIS)
    x = rows.collect()[0]
    assert x["merge_errors"] == []
    s = x["document"]["observed"]["shots"][0]
    assert (s["subjects"], s["framing"], s["camera_movement"], s["audio"]["music_certainty"]) == (["hand"], "unknown", "pan", "unknown")
    assert [tuple(t) for t in s["on_screen_text"]] == [("Buy", True)] and s["spoken_dialogue"][0]["exact"] is False
    assert [e["kind"] for e in s["evidence"]] == ["deterministic", "model_observation"]
    i = x["document"]["inferred"]
    assert (i["hook_type"]["value"], i["hook_type"]["confidence"], i["commercial"]["details"]) == ("unknown", "low", None)
    assert [m["label"] for m in i["attention_mechanisms"]] == ["bare", "l"] and x["document"]["generation"]["continuity_constraints"] == ["one"]
    f = rows.select(project.features(F.from_json(F.to_json("document"), project.DOCUMENT)).alias("f")).collect()[0]["f"]
    assert (f["hook_present"], f["cta_type"], f["product_present"], f["visible_text_roles"]) == (True, "not_applicable", False, ["promotional"])


def test_merge_errors(spark):
    bad = {"shots": [dict(ANALYSIS["shots"][0], end_seconds=1.0), {"shot_id": "shot_009"}]}
    syn = json.loads(json.dumps(SYNTHESIS))
    syn["generation"]["shots"] = [{"shot_id": "shot_001", "reconstruction_intent": "short"}, {"shot_id": "shot_007", "reconstruction_intent": "x" * 50}]
    syn["marketing_evidence"] = "says link in bio"
    x = document(spark, bad, syn).collect()[0]
    assert x["document"] is None
    said = [m.split(":")[0] for m in x["merge_errors"]]
    assert said == ["unknown shots", "missing fields", "blank descriptions", "measured bounds overwritten", "non_commercial, but its evidence names a call to action", "unknown shots", "vague instructions"]


def sources(tmp_path, n=8):
    lines = ["url,hashtags,views"] + [f"https://v.example/video/{100000 + k},x,{k}" for k in range(n)]
    (tmp_path / "s.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "r.jsonl").write_text('{"video_id": "100003", "scores": {"a": 4, "b": 5}, "errors": ["dialogue"]}\n')
    return f"{tmp_path}/s.csv", f"{tmp_path}/r.jsonl"


def counting(tmp_path, name, f):
    """f, with a file for each call, as calls are made in worker processes."""
    (tmp_path / name).mkdir()

    def run(row):
        (tmp_path / name / uuid.uuid4().hex).write_text(row["video_id"])
        return f(row)

    return run, lambda: Counter(p.read_text() for p in (tmp_path / name).iterdir())


POLICY = cohort.Policy("c", "1", required_hashtags=("x",), min_views=2)


def test_pilot(spark, tmp_path):
    s, r = sources(tmp_path)

    def ingest(row):
        if row["video_id"] == "100004":
            raise calls.Failure("the video is private", "video_unavailable")
        return {"usage_cost_usd": 0.5, "latency_seconds": 1.0, "facts": {"views": 7, "creator_id": "c"}}

    def decompile(row):
        if row["video_id"] == "100005":
            return {"ok": False, "error_category": "model_provider", "error_message": "no answer"}
        return {"usage_cost_usd": 0.25, "latency_seconds": 2.0, "model_id": row["facts"]["creator_id"]}

    check = lambda row: {"schema_valid": True, "schema_version": "0.1"}
    stages = {}
    seen = {}
    for name, f in (("performance_snapshot", ingest), ("decompile", decompile), ("project_canonical", check)):
        stages[name], seen[name] = counting(tmp_path, name, f)
    x = pilot.run(spark, s, POLICY, stages, f"{tmp_path}/out", r, retry=calls.Retry(sleep=lambda t: None)).collect()[0]
    assert [sum(seen[n]().values()) for n in stages] == [6, 5, 4] and max(c for n in stages for c in seen[n]().values()) == 1
    assert (x["requested"], x["cohort_rejections"], x["fully_processed"], x["collection_failures"], x["model_provider_failures"]) == (8, 2, 4, 1, 1)
    assert abs(x["success_rate"] - 4 / 6) < 1e-9 and x["schema_validation_rate"] == 1.0 and x["p50_latency_seconds"] == 3.0 and x["median_cost_usd"] == 0.75
    assert x["gate_decision"] == "decompiler-needs-more-work" and x["manual_review"]["average_overall"] == 4.5 and x["manual_review"]["per_review"][0]["video_id"] == "100003"
    assert x["error_counts_by_category"] == {"dialogue": 1, "model_provider": 1, "video_unavailable": 1} and x["generated_at"]
    index = {i["video_id"]: i for i in spark.read.parquet(f"{tmp_path}/out/index").collect()}
    assert index["100004"]["status"] == "ingestion_failed" and index["100002"]["views"] == 7 and index["100002"]["model_ids"] == '{"decompile":"c"}'
    assert spark.read.json(f"{tmp_path}/out/rejections/*").count() == 2


def test_resume_keeps_records_and_counts_the_whole_list(spark, tmp_path):
    s, _ = sources(tmp_path)
    fine = {"on": False}

    def stage(row, broken):
        if broken and row["video_id"] == "100006":
            raise KeyError("gone")
        return {"latency_seconds": 1.0, "schema_valid": True}

    first, seen = counting(tmp_path, "first", lambda row: stage(row, True))
    one = pilot.run(spark, s, POLICY, {"perception": first}, f"{tmp_path}/out").collect()[0]
    again, seen_again = counting(tmp_path, "again", lambda row: stage(row, False))
    two = pilot.run(spark, s, POLICY, {"perception": again}, f"{tmp_path}/out").collect()[0]
    assert (one["fully_processed"], two["fully_processed"]) == (5, 6) and one["requested"] == two["requested"] == 8
    assert seen_again() == Counter(["100006"]) and spark.read.parquet(f"{tmp_path}/out/index").count() == 6
    assert one["error_counts_by_category"] == {"unexpected": 1} and two["success_rate"] == 1.0
    every, seen_every = counting(tmp_path, "every", lambda row: stage(row, False))
    pilot.run(spark, s, POLICY, {"perception": every}, f"{tmp_path}/out", reprocess=True)
    assert sum(seen_every().values()) == 6 and fine == {"on": False}
    assert spark.read.parquet(f"{tmp_path}/out/records").groupBy("video_id").count().where("count > 1").count() == 6


def test_urls_of_other_hosts_and_absent_stages_fail_loudly(spark, tmp_path):
    (tmp_path / "s.jsonl").write_text('{"url": "https://v.example/video/1234567", "hashtags": ["x"], "views": 5}\n{"url": "https://other.example/video/7654321", "hashtags": ["x"], "views": 5}\n')
    got = pilot.run(spark, f"{tmp_path}/s.jsonl", POLICY, {"performance_snapshot": lambda row: {}, "perception": calls.failing_stage("perception")}, f"{tmp_path}/out", hosts=("v.example",)).collect()[0]
    assert got["error_counts_by_category"] == {"invalid_url": 1, "stage_not_available": 1} and got["fully_processed"] == 0
    log = spark.read.json(f"{tmp_path}/out/ingestion_failures/*").collect()
    assert [(x["url"], x["status"], x["failure_category"]) for x in log] == [("https://other.example/video/7654321", "ingestion_failed", "invalid_url")]
    none = pilot.build_report(spark.createDataFrame([], "video_id string, url string, status string, failure_category string, schema_valid boolean, total_latency_seconds double, total_usage_cost_usd double"), 0).collect()[0]
    assert none["success_rate"] == 0.0 and none["p95_latency_seconds"] == 0.0 and none["manual_review"]["reviewed_count"] == 0


def test_retry_is_bounded_and_for_passing_faults_only():
    pauses, tried = [], []

    def flaky(errors):
        def call():
            tried.append(1)
            if errors:
                raise errors.pop(0)
            return "x"

        return call

    policy = calls.Retry(3, 2.0, sleep=pauses.append)
    got = policy.run(flaky([ValueError("HTTP 503"), TimeoutError("slow")]))
    assert (got.value, got.attempts, got.succeeded, pauses) == ("x", 3, True, [2.0, 4.0])
    got = policy.run(flaky([ValueError("bad input"), ValueError("x")]))
    assert (got.attempts, got.succeeded, got.errors) == (1, False, ["attempt 1: ValueError: bad input"])
    got = policy.run(flaky([calls.Transient("t")] * 9))
    assert (got.attempts, got.succeeded, len(tried)) == (3, False, 7)
