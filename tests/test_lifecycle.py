"""Ingestion, perception, model runs, contracts, evaluation and settings, with fakes for what is outside."""

import json

import pytest
from pyspark.sql import functions as F

from cliplake.operators import contracts, evaluation, ingest, perception
from cliplake.plans import config, multistep
from cliplake.sources import calls, readers

MP4 = b"\x00\x00\x00\x18ftypmp42" + b"x" * 20
QUIET = calls.Retry(sleep=lambda t: None)


def test_ingest(spark, tmp_path):
    def broken(url):
        raise calls.Failure("not installed", "collector_dependency_unavailable")

    def fetch(body):
        def run(url):
            if "404" in url:
                raise calls.Failure("gone", "video_unavailable")
            ident = url.rsplit("/", 1)[1]
            return {"video_id": ident, "payload": json.dumps({"desc": "Hi #one", "stats": {"play_count": 5}}), "content": b"RIFF" if ident == "222222" else body, "collector_version": "1"}

        return run

    urls = [f"https://v.example/video/{i}" for i in ("111111", "222222", "404404")] + ["https://w.example/video/333333"]
    entries = spark.createDataFrame([(u, None) for u in urls], "url string, creator_handle string")
    go = lambda body: {r["url"].rsplit("/", 1)[1]: r for r in ingest.run(entries, [("one", broken), ("two", fetch(body))], f"{tmp_path}/raw", ("v.example",), "https://v.example/video/%s", QUIET).collect()}
    got = go(MP4)
    assert {k: r["error_category"] for k, r in got.items()} == {"111111": None, "222222": "download_failure", "404404": "video_unavailable", "333333": "invalid_url"}
    x = got["111111"]
    assert (x["reused"], x["observation"], x["views"], x["hashtags"]) == (False, None, 5, ["one"]) and [a["ok"] for a in x["collector_attempts"]] == [False, True]
    m = spark.read.parquet(f"{tmp_path}/raw/manifests").collect()
    assert len(m) == 1 and m[0]["attempted_collectors_in_order"] == ["one", "two"] and m[0]["fallback_or_error_notes"][0]["error_category"] == "collector_dependency_unavailable"
    again = go(MP4)["111111"]
    assert again["reused"] and again["observation"] and spark.read.parquet(f"{tmp_path}/raw/media").count() == 1
    assert spark.read.parquet(f"{tmp_path}/raw/observations").count() == 1 and spark.read.parquet(f"{tmp_path}/raw/metadata_raw").count() == 1
    other = go(MP4 + b"y")["111111"]
    assert (other["ok"], other["error_category"]) == (False, "artifact_mismatch") and spark.read.parquet(f"{tmp_path}/raw/media").collect()[0]["content"] == MP4


def probe_json(duration):
    return json.dumps({"streams": [{"codec_type": "video", "codec_name": "h264", "width": 720, "height": 1280, "avg_frame_rate": "30/1"}], "format": {"duration": str(duration)}})


def test_perception(spark, tmp_path):
    def prober(path):
        return {"a": probe_json(3.0), "b": probe_json(2.5), "c": "{}", "d": "no json"}[path]

    def detector(path):
        return [{"start_seconds": 0.1, "end_seconds": 1.0, "start_frame": 3, "end_frame": 30}, {"start_seconds": 1.0, "end_seconds": 2.9, "start_frame": 30, "end_frame": 87}] if path == "a" else []

    def extract(path, at):
        return None if path == "a" and at > 1.9 else f"{path}@{at}"

    media = spark.createDataFrame([(x, x, "0" * 64) for x in "abcd"], "video_id string, path string, sha256 string")
    got = {r["video_id"]: r for r in perception.run(media, prober, detector, extract, f"{tmp_path}/p", retry=QUIET).collect()}
    assert {k: r["error_category"] for k, r in got.items()} == {"a": None, "b": None, "c": "no_video_stream", "d": "unreadable_media"}
    shots = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/p/shots").collect())
    assert shots == [("a", "shot_001", 0.0, 1.0, 0, 30), ("a", "shot_002", 1.0, 3.0, 30, 87), ("b", "shot_001", 0.0, 2.5, 0, 75)]
    frames = {(r["video_id"], r["shot_id"]): (r["timestamp_seconds"], r["frame_index"]) for r in spark.read.parquet(f"{tmp_path}/p/frames").collect()}
    assert frames == {("a", "shot_001"): (0.5, 15), ("a", "shot_002"): (1.8, 60), ("b", "shot_001"): (1.25, 38)}
    assert (got["a"]["shot_count"], got["a"]["frame_count"], got["b"]["detector"]) == (2, 2, "content")


def test_perception_inputs_and_latest_run(spark, tmp_path):
    d = tmp_path / "v1"
    d.mkdir()
    (d / "media_facts.json").write_text(json.dumps({"duration_seconds": 2.0, "fps": 30.0, "sha256": "a"}))
    (d / "shots.json").write_text(json.dumps({"shots": [{"shot_id": "shot_001", "start_seconds": 0, "end_seconds": 2, "start_frame": 0, "end_frame": 60}]}))
    facts, shots, frames = readers.perception_inputs(spark, str(tmp_path))
    assert facts.collect()[0]["video_id"] == "v1" and shots.collect()[0]["shot_id"] == "shot_001" and frames.count() == 0
    (d / "frames.json").write_text(json.dumps([{"shot_id": "shot_001", "path": "p", "timestamp_seconds": 1.0, "frame_index": 30}]))
    assert readers.perception_inputs(spark, str(tmp_path))[2].collect()[0]["frame_index"] == 30
    for run in ("20240101T000000Z_b", "20240301T000000Z_a"):
        (tmp_path / "runs" / run).mkdir(parents=True)
        (tmp_path / "runs" / run / "usage.json").write_text("{}")
    assert readers.latest_run(spark, f"{tmp_path}/runs") == "20240301T000000Z_a" and readers.latest_run(spark, f"{tmp_path}/none") is None


def shot_answer(ids):
    entry = lambda i: {"shot_id": i, "subjects": ["a hand"], "actions": [], "visual_description": "dough", "framing": "medium", "camera_movement": "static", "on_screen_text": [{"text": "Buy now", "exact": True}], "spoken_dialogue": [], "audio": {"music": "piano", "music_certainty": "observed"}, "transition_in": "cut"}
    return json.dumps({"shots": [entry(i) for i in ids], "uncertainties": ["light"]})


def whole_answer(ids, status="non_commercial", mechanism=True):
    inferred = {"commercial": {"status": status}, "concept": {"value": "bread", "confidence": "high"}, "target_audience_hypothesis": {"value": None, "confidence": "low"}, "hook_type": {"value": "question", "confidence": "high"}, "narrative_structure": {"value": "loud", "confidence": "low"}, "attention_mechanisms": ["b", "a"], "persuasion_mechanisms": []}
    if mechanism:
        inferred["hook_mechanism"] = {"label": "m", "confidence": "low"}
    return json.dumps({"observed_summary": "s", "hook": {"description": "h", "start_seconds": 0, "end_seconds": 1.0}, "inferred": inferred, "generation": {"global_brief": "b", "shots": [{"shot_id": i, "reconstruction_intent": "x" * 40} for i in ids], "continuity_constraints": []}})


@pytest.fixture(scope="module")
def two_pass(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("runs")
    ids = ["shot_001", "shot_002", "shot_003"]

    def model(parts, settings):
        assert settings["response_mime_type"] == "application/json" and "top_p" not in settings
        prompt = parts[-1]["text"]
        usage = {"input_tokens": 111, "output_tokens": 222, "total_tokens": 333}
        which = next(p["path"] for p in parts if p["role"] == "source_video")
        if prompt.startswith("Describe the whole"):
            assert '"shot_id":"shot_002"' in prompt and "piano" in prompt
            return ("```json\n" + whole_answer(ids, mechanism=which != "nomechanism") + "\n```"), usage
        asked = [i for i in ids if f'"{i}"' in prompt]
        if which == "bad" and "shot_003" in asked:
            return "no json", usage
        if which == "down":
            raise ValueError("quota")
        return shot_answer(asked), usage

    names = ("good", "bad", "down", "nomechanism")
    videos = spark.createDataFrame([(n, n) for n in names], "video_id string, path string")
    facts = F.struct(F.lit(6.0).alias("duration_seconds"), F.lit("a" * 64).alias("sha256"))
    videos = videos.withColumns({"media_facts": facts, "source_metadata": F.parse_json(F.lit('{"id": "1234567", "description": "Bread #baking", "uploader": "@me", "timestamp": 1700000000}'))})
    shots = spark.createDataFrame([(n, i, 2.0 * k, 2.0 * k + 2, 60 * k, 60 * k + 60) for n in names for k, i in enumerate(ids)], "video_id string, shot_id string, start_seconds double, end_seconds double, start_frame bigint, end_frame bigint")
    frames = spark.createDataFrame([("good", "shot_001", "f.jpg", 1.0, 30)], perception.FRAME)
    settings = config.RunConfig(batch_size=2, input_per_mtok_usd=1.0, output_per_mtok_usd=2.0, min_gap_seconds=0.0)
    rows = multistep.run(videos, shots, frames, model, str(tmp), settings, sleep=lambda t: None)
    return tmp, rows, {r["video_id"]: r for r in rows.collect()}


def test_two_pass_run(spark, two_pass):
    tmp, rows, got = two_pass
    assert not got["good"]["errors"]
    assert {k: r["status"] for k, r in got.items()} == {"good": "complete", "bad": "shot_analysis", "down": "shot_analysis", "nomechanism": "creative_ir_schema"}
    x = got["good"]
    doc, canonical = json.loads(x["document"]), json.loads(x["canonical"])
    assert doc["source"]["published_at"] == "2023-11-14T22:13:20+00:00" and doc["source"]["hashtags"] == ["baking"] and doc["source"]["creator_handle"] == "me"
    assert [s["end_seconds"] for s in doc["observed"]["shots"]] == [2.0, 4.0, 6.0] and canonical["features"]["shot_count"] == 3
    assert canonical["features"]["attention_mechanism_labels"] == ["a", "b"] and canonical["features"]["narrative_structure"] == "unknown"
    assert x["usage"]["model_call_count"] == 3 and x["usage"]["total_usage"] == {"input_tokens": 333, "output_tokens": 666, "total_tokens": 999}
    assert abs(x["usage"]["total_cost_usd"] - 3 * 0.000555) < 1e-9
    e = x["evaluation"]
    assert e["deterministic_fact_checks"] == {"duration_equal": True, "artifact_sha256_equal": True, "boundaries_equal": True}
    assert [c["kind"] for c in e["certain_claim_inventory"][:2]] == ["exact_on_screen_text", "observed_music_identity"] and len(e["certain_claim_inventory"]) == 6
    assert "batch 1" in got["bad"]["errors"][0]["message"] and "quota" in got["down"]["errors"][0]["message"]
    assert got["nomechanism"]["errors"][0]["path"] == "$.inferred.hook_mechanism" and got["nomechanism"]["canonical"] is None
    run = rows.collect()[0]["run_id"]
    raw = spark.read.parquet(f"{tmp}/{run}/shot_answers")
    assert raw.count() == 8 and raw.where("raw = 'no json'").count() == 1
    parts = spark.read.parquet(f"{tmp}/{run}/shot_requests").where("video_id = 'good' AND batch = 0").select(multistep.summary(F.col("parts")).alias("s")).collect()[0]["s"]
    assert [(p["mime_type"], p["role"]) for p in parts] == [("video/mp4", "source_video"), ("image/jpeg", "frame:shot_001"), ("text/plain", "prompt")] and parts[2]["byte_length"] > 50


def test_artifacts_of_a_two_pass_run(spark, two_pass, tmp_path):
    from cliplake.plans import artifacts

    tmp, rows, got = two_pass
    run = rows.collect()[0]["run_id"]
    videos = spark.createDataFrame([(n, (6.0, "a" * 64)) for n in ("good", "bad", "down", "nomechanism")], "video_id string, media_facts struct<duration_seconds:double,sha256:string>")
    compared = spark.createDataFrame([("good", "validated", 4.5)], "video_id string, decision string, average double")
    made = artifacts.two_pass(spark, f"{tmp}/{run}", run, videos, compared)
    artifacts.write(made, str(tmp_path / "r"))
    artifacts.write(made, str(tmp_path / "r"))  # what is there stays
    at = tmp_path / "r" / "good" / "decompilation" / "multi_step" / run
    names = sorted(str(p.relative_to(at)) for p in at.rglob("*") if p.is_file())
    batches = [0, 1]
    assert names == sorted([n % b for n in artifacts.TWO_PASS_NAMES if "%" in n for b in batches] + [n for n in artifacts.TWO_PASS_NAMES if "%" not in n])
    assert json.loads((at / "media_facts.json").read_text()) == {"duration_seconds": 6.0, "sha256": "a" * 64}
    assert [x["shot_id"] for x in json.loads((at / "shots.json").read_text())["shots"]] == ["shot_001", "shot_002", "shot_003"]
    assert json.loads((at / "creative_ir.json").read_text()) == json.loads(got["good"]["document"]) and json.loads((at / "validation.json").read_text())["valid"]
    assert (at / "synthesis/response.raw.txt").read_text().startswith("```json") and json.loads((at / "synthesis/response.parsed.json").read_text())["observed_summary"] == "s"
    assert json.loads((at / "comparison_vs_single_pass.json").read_text()) == {"decision": "validated", "average": 4.5}
    bad = tmp_path / "r" / "bad" / "decompilation" / "multi_step" / run
    assert (bad / "shot_analysis/response_001.raw.txt").read_text() == "no json" and (bad / "shot_analysis/response_001.parsed.json").read_text() == "null"
    assert not (bad / "synthesis").exists() and not (bad / "canonical_ir.json").exists() and not (tmp_path / "r/_mismatches").exists()


def test_single_pass(spark, tmp_path):
    good = {"schema_version": "0.1", "source": {"video_id": "1"}, "observed": {"timeline": [], "visible_text": [], "dialogue": [], "visual": {}, "audio": {}}, "inferred": {}, "generation": {}}
    answers = {"a": json.dumps(good), "b": "not json", "c": json.dumps({**good, "mood": 1})}

    def model(parts, settings):
        return answers[parts[0]["path"]], {"input_tokens": 1_000_000, "output_tokens": 500_000}

    videos = spark.createDataFrame([(x, x) for x in answers], "video_id string, path string").withColumn("source_metadata", F.parse_json(F.lit("{}")))
    rows = multistep.single_pass(videos, model, str(tmp_path), config.RunConfig(input_per_mtok_usd=1.0, output_per_mtok_usd=2.0, min_gap_seconds=0.0), sleep=lambda t: None)
    got = {r["video_id"]: r for r in rows.collect()}
    assert got["a"]["validation"]["valid"] and got["a"]["cost_usd"] == 2.0 and got["b"]["raw"] == "not json"
    assert got["b"]["validation"]["errors"][0]["message"].startswith("parse failure") and [tuple(e) for e in got["c"]["validation"]["errors"]] == [("$", "does not allow mood")]


CANONICAL = {"schema": {"name": "canonical_ir", "version": "0.1"}, "source": {"platform": "short_video", "video_id": "1"}, "decompilation_ref": {"pipeline_version": "1", "prompt_version": "1"}, "features": {"hook_present": None, "shot_count": 1, "shot_duration_mean_seconds": 1.0, "subject_categories": ["food"], "commercial_status": "uncertain", "visible_text_present": False, "spoken_dialogue_present": False, "camera_motion_categories": [], "transition_categories": [], "music_present": None, "sfx_present": False, "cta_type": None, "proof_labels": [], "trust_labels": [], "persuasion_labels": []}}
SNAPSHOT = {"schema": {"name": "performance", "version": "0.1"}, "platform": "short_video", "video_id": "1", "published_at": "2024-01-01T00:00:00Z", "observed_at": "2024-01-02T00:00:00+00:00", "age_since_publish_seconds": 86400, "metrics": {"views": 0, "likes": None, "comments": 1, "shares": 2}, "collector": {"name": "c", "collected_at": "2024-01-02T00:00:00Z"}}


def changed(document, path, value):
    out = json.loads(json.dumps(document))
    *front, last = path.split(".")
    at = out
    for k in front:
        at = at[k]
    if value is KeyError:
        del at[last]
    else:
        at[last] = value
    return out


def test_contracts(spark):
    cases = [
        ("canonical_ir_v0_1", CANONICAL, []),
        ("canonical_ir_v0_1", changed(CANONICAL, "features.generation", "x"), ["$.features"]),
        ("canonical_ir_v0_1", changed(CANONICAL, "features.subject_categories", ["food", "food"]), ["$.features.subject_categories"]),
        ("canonical_ir_v0_1", changed(CANONICAL, "features.shot_count", 0), ["$.features.shot_count"]),
        ("canonical_ir_v0_1", changed(CANONICAL, "features.cta_type", "shout"), ["$.features.cta_type"]),
        ("performance_v0_1", SNAPSHOT, []),
        ("performance_v0_1", changed(SNAPSHOT, "metrics.views", -1), ["$.metrics.views"]),
        ("performance_v0_1", changed(SNAPSHOT, "metrics.shares", KeyError), ["$.metrics"]),
        ("performance_v0_1", changed(SNAPSHOT, "observed_at", "yesterday"), ["$.observed_at"]),
        ("performance_v0_1", changed(SNAPSHOT, "age_since_publish_seconds", 5), ["$.age_since_publish_seconds"]),
    ]
    for name in ("canonical_ir_v0_1", "performance_v0_1"):
        mine = [(json.dumps(d), w) for n, d, w in cases if n == name]
        got = spark.createDataFrame(mine, "raw string, want array<string>").select("want", contracts.violations(F.try_parse_json("raw"), name).alias("v")).collect()
        for r in got:
            assert [v["path"] for v in r["v"]] == r["want"], r
    with pytest.raises(Exception, match="performance_v0_1 validation failed at"):
        contracts.require_valid(spark.createDataFrame([('{"schema": 1}',)], "raw string").select(F.parse_json("raw").alias("d")), "d", "performance_v0_1").collect()
    with pytest.raises(KeyError, match="no contract"):
        contracts.load_schema("x")


def test_cohort_configs(spark, tmp_path):
    from cliplake.plans import pilot

    always = ("store_published_at_when_available", "store_observed_at_for_every_snapshot", "store_creator_identity_when_available", "store_follower_count_when_available", "store_raw_metrics_unnormalized")
    full = {k: "x" for k in ("cohort_id", "version", "niche_name", "niche_description", "geographic_constraints", "publication_window_policy")}
    full |= {k: ["x"] for k in ("languages", "creator_inclusion_rules", "format_inclusion_rules", "exclusion_rules", "minimum_metadata_for_inclusion")}
    full |= {"approval_status": "pending_owner_approval", "platform": "short_video", "duration_seconds": {"min": 0, "max": 60}, "commercial_content_policy": {"mode": "allowed"}, "duplicate_policy": {"same_video_id": "one_source_record", "direct_reposts": "treated_independent", "near_duplicate_detection": "none"}}
    full |= {"performance_observation_policy": {**dict.fromkeys(always, True), "raw_metrics": ["views"]}, "pilot_sampling_policy": {"target_size_range": [1, 5], "method": "m", "stratification": "s", "viral_only_sampling_allowed": False}}
    path = tmp_path / "cohort.json"
    path.write_text(json.dumps(full))
    assert pilot.load_validated_config(spark, str(path)).cohort_id == "x"
    with pytest.raises(ValueError, match="not approved"):
        pilot.load_validated_config(spark, str(path), approved=True)
    bad = changed(changed(full, "pilot_sampling_policy.viral_only_sampling_allowed", True), "languages", [])
    path.write_text(json.dumps({**bad, "mood": 1}))
    with pytest.raises(ValueError, match=r"^\$.languages: fewer than 1 items; \$.pilot_sampling_policy.viral_only_sampling_allowed: not one of false; \$: does not allow mood$"):
        pilot.load_validated_config(spark, str(path))
    for load in (pilot.load_cohort, lambda p: pilot.load_validated_config(spark, p)):
        with pytest.raises(FileNotFoundError):
            load(f"{tmp_path}/none.json")


def rubric(video, score, **more):
    return {"run_metadata": {"video_id": video}, "categories": {c: {"score": score(k), "notes": "n", "evidence": "e"} for k, c in enumerate(evaluation.RUBRIC)}, "unsupported_claims": [], "schema_validation_success": True, "latency_seconds": 5.0, "cost_usd": 0.1, **more}


def test_comparison_and_decision(spark, tmp_path):
    single = [rubric("1", lambda k: 3, unsupported_claims=[{"claim": "x"}]), rubric("2", lambda k: 4)]
    multi = [rubric("1", lambda k: 5 if k % 2 else 4, deterministic_fact_checks={"duration_equal": True}), rubric("2", lambda k: 2 if k == 3 else 4, cost_usd=None, missed_important_facts="none")]
    for name, docs in (("s", single), ("m", multi)):
        (tmp_path / name).mkdir()
        for k, d in enumerate(docs):
            (tmp_path / name / f"{k}.json").write_text(json.dumps(d))
    load = lambda n: evaluation.evaluations(readers.json_documents(spark, f"{tmp_path}/{n}"))
    got = {r["video_id"]: r for r in evaluation.write_comparison(load("s"), load("m"), f"{tmp_path}/out").collect()}
    a, b = got["1"], got["2"]
    assert [c["category"] for c in a["categories"]] == list(evaluation.RUBRIC) and [c["delta"] for c in a["categories"][:2]] == [1, 2]
    assert (a["overall_average"]["single_pass"], a["overall_average"]["multi_step"]) == (3.0, round((4 * 6 + 5 * 5) / 11, 3))
    assert (a["unsupported_claims"]["single_pass_count"], a["decision"], a["follow_up"]) == (1, "validated-for-pilot", None)
    assert b["decision"] == "needs-one-video-fix" and b["follow_up"] == "overall_average_gte_4; no_category_below_3; cost_and_latency_recorded"
    assert [(c["category"], c["score"]) for c in b["low_categories"]] == [("dialogue", 2)] and b["material_omissions"]["multi_step_count"] == 0


def test_manual_scores(spark, two_pass):
    _, rows, _ = two_pass
    evaluated = rows.where("status = 'complete'").select("evaluation.*").withColumn("video_id", F.lit("good"))
    scored = {c: (4, "n", "e") for c in evaluation.RUBRIC[:3]}
    review = lambda cats: spark.createDataFrame([("good", cats, [{"claim": "x"}], None)], f"video_id string, categories map<string,{evaluation.SCORE}>, unsupported_claims {evaluation.CLAIM}, missed_important_facts {evaluation.CLAIM}")
    got = evaluation.record_manual_scores(evaluated, review(scored)).collect()[0]
    assert len(got["categories"]) == 3 and not got["scores_pending_manual_review"] and got["unsupported_claims"] == [{"claim": "x"}] and got["missed_important_facts"] == []
    for bad, said in (({"mood": (4, "n", "e")}, "unknown rubric categories: mood"), ({"hook": (4, None, "e")}, "without score, notes or evidence: hook")):
        with pytest.raises(Exception, match=said):
            evaluation.record_manual_scores(evaluated, review(bad)).collect()


def test_settings(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"model_id": "file"}))
    env = {"CLIPLAKE_MODEL_ID": "env", "CLIPLAKE_BATCH_SIZE": "3", "CLIPLAKE_TOP_P": "0.5", "CLIPLAKE_API_KEY": "secret"}
    c = config.load(f"{tmp_path}/c.json", env)
    assert (c.model_id, c.batch_size, c.top_p, c.temperature, c.synthesis_model) == ("file", 3, 0.5, 0.0, "file")
    assert "secret" not in c.to_json() and c.generation_settings() == {"temperature": 0.0, "response_mime_type": "application/json", "top_p": 0.5}
    assert config.load(env={}).model_id == "model"
    for bad in ({"x": 1}, {"batch_size": 0}):
        (tmp_path / "bad.json").write_text(json.dumps(bad))
        with pytest.raises(ValueError):
            config.load(f"{tmp_path}/bad.json", {})
    with pytest.raises(FileNotFoundError):
        config.load(f"{tmp_path}/none.json", {})


def test_default_stages(spark, tmp_path):
    from cliplake.operators import cohort
    from cliplake.plans import adapters, pilot

    ids = ["shot_001", "shot_002"]

    def fetch(url):
        ident = url.rsplit("/", 1)[1]
        if ident == "1000004":
            raise calls.Failure("gone", "video_unavailable")
        stats = {"play_count": 5, "digg_count": 1, "comment_count": 0, "share_count": None if ident == "1000003" else 2}
        return {"video_id": ident, "payload": json.dumps({"desc": "Bread #baking", "author": {"unique_id": "me", "uid": 9}, "stats": stats, "create_time": 1700000000}), "content": MP4 + ident.encode()}

    def detector(path):
        return [{"start_seconds": 0.0, "end_seconds": 1.0, "start_frame": 0, "end_frame": 30}, {"start_seconds": 1.0, "end_seconds": 2.0, "start_frame": 30, "end_frame": 60}]

    def model(parts, settings):
        usage = {"input_tokens": 10, "output_tokens": 20, "total_tokens": 30}
        if parts[-1]["text"].startswith("Describe the whole"):
            return whole_answer(ids[:1] if "1000002" in parts[0]["path"] else ids), usage
        return shot_answer([i for i in ids if f'"{i}"' in parts[-1]["text"]]), usage

    tools = adapters.Tools([("c", fetch)], lambda path: probe_json(2.0), detector, lambda path, at: f"{path}@{at}", model, ("v.example",), "https://v.example/video/%s", f"{tmp_path}/videos/%s.mp4", config=config.RunConfig(min_gap_seconds=0.0, input_per_mtok_usd=1.0, output_per_mtok_usd=1.0), retry=QUIET)
    (tmp_path / "s.csv").write_text("url,hashtags,views\n" + "".join(f"https://v.example/video/{1000000 + k},x,{k}\n" for k in range(1, 5)))
    out = f"{tmp_path}/out"
    stages = adapters.default_stages(tools, out, lambda: "2024-01-02T00:00:00+00:00")
    report = pilot.run(spark, f"{tmp_path}/s.csv", cohort.Policy("c", "1", required_hashtags=("x",)), stages, out, retry=QUIET).collect()[0]
    assert report["error_counts_by_category"] == {"contract_violation": 1, "model_or_validation": 1, "video_unavailable": 1}
    assert (report["requested"], report["fully_processed"], report["schema_validation_rate"]) == (4, 1, 1.0) and abs(report["total_cost_usd"] - 3 * 0.00003) < 1e-9
    index = {r["video_id"]: r for r in spark.read.parquet(f"{out}/index").collect()}
    x = index["1000001"]
    assert (x["status"], x["creator_id"], x["views"], x["observed_at"], x["published_at"]) == ("success", "9", 5, "2024-01-02T00:00:00+00:00", "2023-11-14T22:13:20+00:00")
    assert x["canonical_ir_path"].startswith("runs/") and {k: r["status"] for k, r in index.items()} == {"1000001": "success", "1000002": "decompilation_failed", "1000003": "ingestion_failed"}
    assert spark.read.json(f"{out}/ingestion_failures/*").collect()[0]["failure_category"] == "video_unavailable"  # no record without a video id
    record = pilot.latest_records(spark, out).where("video_id = '1000002'").collect()[0]
    assert record["failure"]["stage"] == "decompile" and "shots without instructions: shot_002" in record["failure"]["message"]
    with pytest.raises(calls.Failure, match="not on the path"):
        adapters.find_tool("no-such-program")
    assert adapters.find_tool("java")[1]
