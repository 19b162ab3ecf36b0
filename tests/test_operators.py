"""Operators on small rows with known results."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from cliplake.functions import arrays as A
from cliplake.functions import scalars as S
from cliplake.operators import cohort, metrics, normalize, project, relational, validate
from cliplake.sources import calls, readers, writers
from cliplake.streaming import snapshots


def one(spark, col, sql="SELECT 1"):
    return spark.sql(sql).select(col.alias("x")).collect()[0]["x"]


def lit(spark, f, *values):
    return one(spark, f(*[F.lit(v) for v in values]))


def test_scalars(spark):
    assert lit(spark, S.subject_category, "Human handle") == "person_creator"
    assert lit(spark, S.subject_category, "a loaf") == "food"
    assert lit(spark, S.subject_category, "sky") is None
    assert lit(spark, S.text_role, "50% today") == "promotional"
    assert lit(spark, S.caption_hashtags, "Making sourdough #baking ##bread") == ["baking", "bread"]
    assert lit(spark, S.split_hashtags, "#a; b ;;") == ["a", "b"]
    assert lit(spark, S.handle, "@@me") == "me" and lit(spark, S.handle, "@") is None
    assert lit(spark, S.epoch_iso, "1700000000") == "2023-11-14T22:13:20+00:00"
    assert [lit(spark, S.epoch_iso, x) for x in ("", "0", "x", "12.5")] == [None] * 4
    assert lit(spark, S.to_int, "12.5") is None and lit(spark, S.to_int, " 12 ") == 12
    assert tuple(lit(spark, S.rational, "30000/1001")) == ("30000/1001", 30000 / 1001)
    assert tuple(lit(spark, S.rational, "0/0")) == (None, None)
    assert tuple(lit(spark, S.rational, "N/A")) == ("N/A", None) and tuple(lit(spark, S.rational, "5/0")) == ("5/0", None)
    assert lit(spark, S.aspect_ratio, 720, 1280) == "9:16" and lit(spark, S.aspect_ratio, 0, 5) is None
    assert lit(spark, S.usage_cost, 1_000_000, 500_000, 1.0, 2.0) == 2.0
    assert one(spark, S.usage_cost(F.lit(1), F.lit(1), F.lit(None).cast("double"), F.lit(1.0))) is None
    assert lit(spark, S.retry_delay, "please retry in 3s", 1) == 5.0 and lit(spark, S.retry_delay, "no", 9) == 60.0
    assert lit(spark, S.file_stem, "/a/b/12.5.mp4") == "12.5" and lit(spark, S.file_stem, "x") == "x"
    assert lit(spark, S.mentions_cta, "see LINK in bio now") is True
    assert lit(spark, S.stage_failure, "ingest") == "ingestion_failed" and lit(spark, S.stage_failure, "z") == "z_failed"
    assert lit(spark, lambda c: S.video_id(c, ["v.example"]), "https://v.example/@u/video/123456?x=1") == "123456"
    assert lit(spark, lambda c: S.video_id(c, ["v.example"]), "https://other.example/video/1") is None
    assert lit(spark, lambda c: S.video_id(c, []), "1234567") == "1234567"
    assert one(spark, S.looks_like_mp4(F.lit(b"\x00\x00\x00\x18ftypmp42"))) is True
    assert one(spark, S.looks_like_mp4(F.lit(b"RIFF"))) is False


def test_model_output(spark):
    for raw in ('{"a": 1}', '```json\n{"a": 1}\n```'):
        assert one(spark, F.try_variant_get(S.parse_object(F.lit(raw)), "$.a", "int")) == 1
    assert one(spark, S.parse_object(F.lit("[1]"))) is None and one(spark, S.parse_object(F.lit("no"))) is None
    broken = '{"a": "x\\u12 y\\ud83d z"}'
    assert one(spark, F.try_variant_get(S.parse_object_lenient(F.lit(broken)), "$.a", "string")) == "x y z"


def test_arrays(spark):
    tri = lambda *v: one(spark, A.presence(F.array(*[F.lit(x) for x in v]).cast("array<string>")))
    assert tri("absent", "observed") is True and tri("absent", None) is False and tri() is False and tri("unknown", "absent") is None
    assert one(spark, A.ordered_distinct(F.array(*[F.lit(x) for x in ("b", "a", "unknown", "b", None)]))) == ["b", "a"]
    assert one(spark, A.sorted_labels(F.array(*[F.lit(x) for x in ("b", "a", "b", None)]))) == ["a", "b"]


def test_nearest_rank_agrees_with_its_definition(spark):
    r = random.Random(3)
    groups = {k: [r.randint(0, 30) / 2 for _ in range(r.randint(1, 12))] for k in range(40)}
    rows = spark.createDataFrame([(k, x) for k, v in groups.items() for x in v], "k int, x double")
    for pct in (50, 95):
        want = {k: sorted(v)[round(pct / 100 * (len(v) - 1))] for k, v in groups.items()}
        assert dict(rows.groupBy("k").agg(A.nearest_rank(F.col("x"), pct)).collect()) == want
        assert dict(metrics.nearest_rank_rows(rows, "k", "x", pct).collect()) == want


def test_ranks_of_large_and_odd_groups(spark):
    r = random.Random(8)
    groups = {1: [r.lognormvariate(0, 3) for _ in range(3000)], 2: [5.0] * 40, 3: [r.choice([0.0, 1e9, -1e9]) for _ in range(101)], 4: [7.5]}
    rows = spark.createDataFrame([(k, x) for k, v in groups.items() for x in v] + [(4, None), (5, None)], "k int, x double")
    got = {x["k"]: (x["a"], x["b"], x["c"]) for x in metrics.at_ranks(rows, "k", "x", {"a": lambda n: F.lit(0), "b": lambda n: F.floor((n - 1) / 2), "c": metrics.nearest(95)}).collect()}
    assert got == {k: (min(v), sorted(v)[(len(v) - 1) // 2], sorted(v)[round(0.95 * (len(v) - 1))]) for k, v in groups.items()}


def greedy(det, ann, tol):
    free, out = sorted(ann), []
    for d in sorted(det):
        near = [(abs(d - a), i) for i, a in enumerate(free) if abs(d - a) <= tol]
        if near:
            out.append((d, free.pop(min(near)[1])))
    return out


def test_boundaries(spark):
    r = random.Random(5)
    rows = [(k, [r.randint(0, 20) / 4 for _ in range(r.randint(0, 6))], [r.randint(0, 20) / 4 for _ in range(r.randint(0, 6))]) for k in range(60)]
    df = spark.createDataFrame(rows, "k int, d array<double>, a array<double>")
    got = {x["k"]: [tuple(p) for p in x["p"]] for x in df.select("k", A.greedy_matches(F.col("d"), F.col("a"), 0.6).alias("p")).collect()}
    assert got == {k: greedy(d, a, 0.6) for k, d, a in rows}
    known = spark.createDataFrame([(1, [0.85, 1.7, 2.4], [0.8, 1.6])], "k int, d array<double>, a array<double>")
    x = relational.boundary_evaluation(known, "k", "d", "a", 0.3).collect()[0]
    assert (x["true_positives"], x["false_positives"], x["missed"], x["recall"]) == (2, 1, 0, 1.0)
    assert abs(x["precision"] - 2 / 3) < 1e-12 and abs(x["median_error"] - 0.075) < 1e-9
    empty = relational.boundary_evaluation(spark.createDataFrame([(1, [], [])], "k int, d array<double>, a array<double>"), "k", "d", "a", 0.3).collect()[0]
    assert empty["precision"] is None and empty["f1"] is None


def test_cohort(spark):
    p = cohort.Policy.from_dict({"cohort_id": "c", "version": 1, "rules": {"required_hashtags": ["x"], "min_views": 10}})
    assert p.max_videos == 50
    rows = spark.createDataFrame([(["x"], "a", 10), (["y"], "a", 10), (["x"], None, None), (["x"], "b", 9)], "hashtags array<string>, creator_handle string, views long")
    assert [r["reason"] for r in cohort.decide(rows, p).collect()] == ["eligible", "missing_required_hashtag", "below_min_views", "below_min_views"]
    listed = cohort.Policy("c", "1", handles=("a",))
    assert [r["accepted"] for r in cohort.decide(rows, listed).collect()] == [True, True, True, False]
    with pytest.raises(ValueError):
        p.require_approved()
    with pytest.raises(ValueError):
        cohort.Policy.from_dict({"cohort_id": "c", "version": 1, "max_videos": 51})


def test_reviews_and_gate(spark):
    reviews = spark.createDataFrame([({"a": 4.0, "b": 5.0}, ["dialogue"]), ({"a": 4.0, "b": 4.0}, ["dialogue"])], "scores map<string,double>, errors array<string>")
    s = metrics.review_summary(reviews).collect()[0]
    assert (s["reviewed_count"], s["average_overall"]) == (2, 4.25)
    runs = spark.createDataFrame([(str(i), "success", 1.0 + i, 0.1, True, None) for i in range(25)], "video_id string, status string, total_latency_seconds double, total_usage_cost_usd double, schema_valid boolean, failure_category string")
    m = metrics.run_metrics(runs, 25)
    assert m.collect()[0]["p50_latency_seconds"] == 13.0
    g = metrics.gate(m, metrics.review_summary(reviews), metrics.review_error_counts(reviews)).collect()[0]
    assert g["blockers"] == ["manual review coverage 2 < required 5 (max(5, ceil(20% of successes)))", "systematic severe errors in category 'dialogue' (2/2 reviews report it, > half)"]
    none = metrics.run_metrics(runs.limit(0), 0).collect()[0]
    assert none["success_rate"] == 0.0 and none["p95_latency_seconds"] == 0.0


def test_usage_totals(spark):
    rows = spark.createDataFrame([("r", 111, 222, 0.1, 1.0)] * 3 + [("s", None, 1, None, 2.0)], "run_id string, tokens_in long, tokens_out long, cost_usd double, latency_seconds double")
    got = {r["run_id"]: r for r in metrics.usage_totals(rows).collect()}
    assert (got["r"]["tokens_in"], got["r"]["tokens_out"]) == (333, 666) and abs(got["r"]["cost_usd"] - 0.3) < 1e-9
    assert got["s"]["cost_usd"] is None and got["s"]["tokens_in"] == 0


def test_validation(spark):
    schema = {
        "type": "object",
        "required": ["a", "when"],
        "additionalProperties": False,
        "properties": {"a": {"type": "integer", "minimum": 1}, "when": {"type": "string", "format": "date-time"}, "tags": {"type": "array", "items": {"enum": ["x", "y"]}, "uniqueItems": True}, "e": {"anyOf": [{"enum": [None, "u"]}, {"enum": ["v"]}]}, "kind": {"const": "k"}},
        "allOf": [{"if": {"properties": {"a": {"minimum": 5}}}, "then": {"required": ["tags"]}}],
    }
    ask = lambda s: one(spark, validate.errors(F.try_parse_json(F.lit(s)), schema))
    assert ask('{"a": 2, "when": "2024-01-01T00:00:00Z", "tags": ["x", "y"], "e": null, "kind": "k"}') == []
    assert ask('{"a": 0, "when": "yesterday", "b": 1}') == ["$.a: less than 1", "$.when: not a date-time", "$: does not allow b"]
    assert ask('{"a": 5, "when": "2024-01-01T00:00:00+00:00"}') == ["$: lacks tags"]
    assert ask('{"a": "1", "when": "2024-01-01T00:00:00Z", "tags": ["x", "x"], "e": "w", "kind": "z"}') == ["$.a: expected integer", "$.e: fits none of the alternatives", "$.kind: not one of k", "$.tags: items are not unique"]
    assert ask('{"a": 1, "when": "2024-01-01T00:00:00Z", "tags": ["x", "z"]}') == ["$.tags[1]: not one of x, y"]
    assert ask("no json") == ["$: not a JSON document"]
    shots = "SELECT array(named_struct('start_seconds', 0D, 'end_seconds', 1D), named_struct('start_seconds', 0.5D, 'end_seconds', 0.4D)) AS s"
    assert one(spark, validate.shot_errors(F.col("s")), shots) == ["shot ends before it starts", "shot overlaps an earlier one"]
    assert one(spark, validate.missing_fields({"a": F.lit(0), "b": F.lit(""), "c": F.lit(None)})) == ["b", "c"]


def test_normalise(spark):
    payload = '{"desc": "Hi #one", "author": {"unique_id": "@me", "uid": 5}, "stats": {"play_count": 0, "digg_count": "abc"}, "digg_count": 7, "create_time": 1700000000, "video": {"duration": 10.5}}'
    x = normalize.normalize(spark.createDataFrame([(payload,)], "raw string").select(F.parse_json("raw").alias("payload"))).collect()[0]
    assert (x["creator_handle"], x["creator_id"], x["views"], x["likes"]) == ("me", "5", 0, None)
    assert x["hashtags"] == ["one"] and x["published_at"] == "2023-11-14T22:13:20+00:00" and x["duration_seconds"] == 10.5
    flat = '{"uploader": "u", "title": "t #a", "hashtags": [], "view_count": 12.7, "like_count": "12.5"}'
    y = normalize.normalize(spark.createDataFrame([(flat,)], "raw string").select(F.parse_json("raw").alias("payload"))).collect()[0]
    assert y["hashtags"] == [] and y["views"] == 12 and y["likes"] is None
    probe = '{"streams": [{"codec_type": "audio"}, {"codec_type": "video", "codec_name": "h264", "width": 720, "height": 1280, "avg_frame_rate": "30/1", "nb_frames": "300"}], "format": {"duration": "10.0"}}'
    f = normalize.probe_facts(spark.createDataFrame([(probe,), ("x",)], "probe_json string")).collect()
    assert f[0]["media_facts"]["aspect_ratio"] == "9:16" and f[0]["media_facts"]["frame_count"] == 300 and f[1]["media_facts"] is None


def test_projection(spark):
    doc = """{"source": {"platform": "p", "video_id": "1"}, "decompilation": {"pipeline_version": "1", "prompt_version": "1", "annotation_mode": "manual"},
      "observed": {"hook": {"evidence": ["e"], "end_seconds": 2.0}, "shots": [
        {"start_seconds": 0, "end_seconds": 1, "subjects": ["Hand", "bread"], "camera_movement": "pan", "transition_in": "unknown", "on_screen_text": [{"text": "Shop now", "exact": true}], "audio": {"music_certainty": "observed", "music": "m", "sfx_certainty": "absent"}},
        {"start_seconds": 1, "end_seconds": 4, "subjects": ["face"], "camera_movement": "static", "transition_in": "cut", "spoken_dialogue": [{"speaker": "s", "text": "Hi", "exact": true}], "audio": {"sfx_certainty": "absent"}}]},
      "inferred": {"commercial": {"status": "commercial", "details": {"product_presence": "x", "proof_type": "unknown", "trust_signals": ["t"], "cta": {"type": "follow"}}}, "hook_type": {"value": "question"}, "attention_mechanisms": [{"label": "b"}, {"label": "a"}, {"label": "b"}]}}"""
    rows = spark.createDataFrame([(doc,)], "raw string").select(F.from_json("raw", project.DOCUMENT).alias("d"))
    f = rows.select(project.features(F.col("d")).alias("f"), project.claims(F.col("d.observed.shots")).alias("c")).collect()[0]
    x = f["f"].asDict()
    assert x["hook_present"] is None and x["hook_type"] == "question" and x["hook_end_seconds"] == 2.0
    assert (x["shot_count"], x["shot_duration_min_seconds"], x["shot_duration_max_seconds"], x["shot_duration_mean_seconds"]) == (2, 1.0, 3.0, 2.0)
    assert x["subject_categories"] == ["person_creator", "food"] and x["visible_text_roles"] == ["promotional"]
    assert x["camera_motion_categories"] == ["pan", "static"] and x["transition_categories"] == ["cut"]
    assert (x["music_present"], x["sfx_present"], x["product_present"], x["cta_type"]) == (True, False, True, "follow")
    assert x["proof_labels"] == [] and x["trust_labels"] == ["t"] and x["attention_mechanism_labels"] == ["a", "b"] and x["persuasion_labels"] == []
    assert [tuple(c) for c in f["c"]] == [("on_screen_text", "Shop now"), ("music", "m"), ("spoken_dialogue", "Hi")]


def test_snapshot(spark):
    rows = spark.createDataFrame([("1", "2024-01-02T00:00:00Z", "2024-01-01T00:00:00Z", 5), ("2", "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", 5), ("3", "x", None, None)], "video_id string, observed_at string, published_at string, views long")
    for c in ("likes", "comments", "shares", "saves"):
        rows = rows.withColumn(c, F.lit(None).cast("long"))
    got = project.performance_snapshot(rows, "p").orderBy("video_id").collect()
    assert got[0]["performance"]["age_since_publish_seconds"] == 86400.0 and got[0]["performance"]["metrics"]["likes"] is None
    assert [r["performance_error"] for r in got[1:]] == ["observed before it was published", "observed_at is not a timestamp"]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("url,video_id,hashtags,views,mood\nhttps://v/1,1,#a;b,5,good\nhttps://v/2,,,,\n")
    got = readers.source_list(spark, f"{tmp_path}/a.csv").orderBy("url").collect()
    assert got[0]["hashtags"] == ["a", "b"] and got[0]["views"] == 5 and got[0]["extra"]["mood"] == "good" and got[1]["video_id"] is None
    (tmp_path / "b.jsonl").write_text('{"url": "u1", "hashtags": ["x", "#y"], "views": 3}\n\n{"url": "u2"}\n')
    assert readers.source_list(spark, f"{tmp_path}/b.jsonl").orderBy("url").collect()[0]["hashtags"] == ["x", "y"]
    (tmp_path / "c.csv").write_text("url\nu\nu\n")
    (tmp_path / "d.csv").write_text("url\n")
    for bad in ("c.csv", "d.csv", "e.txt"):
        with pytest.raises(ValueError):
            readers.source_list(spark, f"{tmp_path}/{bad}")
    empty = spark.createDataFrame([], "video_id string")
    writers.write_index(writers.index_rows(empty), f"{tmp_path}/index")
    assert spark.read.parquet(f"{tmp_path}/index").columns == [x.split()[0] for x in writers.INDEX.split(", ")]
    rows = spark.createDataFrame([("1", "aa"), ("2", "bb")], "video_id string, sha256 string")
    assert writers.write_once(rows, f"{tmp_path}/media", "video_id").count() == 0
    again = spark.createDataFrame([("1", "zz"), ("3", "cc")], "video_id string, sha256 string")
    assert [r["video_id"] for r in writers.write_once(again, f"{tmp_path}/media", "video_id").collect()] == ["1"]
    assert spark.read.parquet(f"{tmp_path}/media").count() == 3


def test_documents_are_written_sorted_and_failures_named(spark, tmp_path):
    rows = spark.sql("SELECT '1' AS video_id, named_struct('b', 1, 'a', named_struct('z', CAST(NULL AS INT), 'y', map('k2', 1, 'k1', 2)), 'c', array(named_struct('q', 1, 'p', 2))) AS d")
    writers.write_documents(rows, f"{tmp_path}/docs", "d")
    text = "\n".join(r[0] for r in spark.read.text(f"{tmp_path}/docs/video_id=1").collect())
    assert json.loads(text) == {"a": {"y": {"k1": 2, "k2": 1}, "z": None}, "b": 1, "c": [{"p": 2, "q": 1}]}
    assert re.sub(r"\s", "", text) == '{"a":{"y":{"k1":2,"k2":1},"z":null},"b":1,"c":[{"p":2,"q":1}]}' and "\n" in text
    (tmp_path / "file").write_text("x")
    with pytest.raises(calls.Failure) as e:
        writers.write_documents(rows, f"{tmp_path}/file/docs", "d")
    assert e.value.category == "file_write_failure"
    flat = readers.flat(readers.entries(spark.createDataFrame([("u", "good")], "url string, mood string")), ["mood", "url", "none"])
    assert flat.collect()[0]["mood"] == "good" and "extra" not in flat.columns and flat.collect()[0]["none"] is None


def test_call_out_keeps_failures_as_rows(spark):
    def fetch(row):
        if row["id"] == 2:
            raise KeyError("gone")
        if row["id"] == 3:
            raise TimeoutError("slow")
        return {"size": row["id"] * 10}

    got = calls.call_out(spark.range(1, 4), fetch, "id long, size long", calls.Retry(sleep=lambda t: None)).orderBy("attempts", "error_category").collect()
    assert [(r["ok"], r["error_category"], r["attempts"]) for r in got] == [(True, None, 1), (False, "KeyError", 1), (False, "TimeoutError", 3)]


def test_ordered_state(spark):
    shots = spark.createDataFrame([("v", 1, 0.2, 1.0), ("v", 2, 1.0, 2.8)], "v string, n int, start_seconds double, end_seconds double").withColumns({"d": F.lit(3.0), "fps": F.lit(30.0)})
    fixed = relational.fix_bounds(shots, "v", ["n"], "d", "fps").orderBy("n").collect()
    assert (fixed[0]["start_seconds"], fixed[1]["end_seconds"]) == (0.0, 3.0)
    ids = relational.sequential_ids(spark.range(1001).withColumn("v", F.lit(1)), "v", ["id"]).where("id IN (0, 1000)").orderBy("id").collect()
    assert [r["shot_id"] for r in ids] == ["shot_001", "shot_1001"]
    left = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(Exception, match="no analysis for a key"):
        relational.required_join(left, spark.createDataFrame([(1, "x")], "k int, y string"), ["k"], "analysis").collect()


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([("v", "2024-01-01 00:10:00", 1), ("v", "2024-01-01 00:10:00", 1), ("v", "2024-01-01 00:50:00", 4)], "video_id string, at string, views long")
    rows.select("video_id", F.col("at").cast("timestamp").alias("observed_at"), "views", F.lit(0).cast("long").alias("likes")).write.parquet(f"{tmp_path}/in")
    q = snapshots.append(snapshots.distinct(snapshots.read(spark, f"{tmp_path}/in")), f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
    batch = snapshots.growth(spark.read.parquet(f"{tmp_path}/in")).collect()[0]
    assert (batch["n"], batch["least"], batch["most"]) == (3, 1, 4)


def parses(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().lower().count("parsejson")


def test_facts_are_parsed_once_a_row(spark, sf):
    from cliplake.plans import catalogue

    assert parses(catalogue.queries()["media_facts"](spark, sf)) == 1
    sizes = spark.createDataFrame([(1080, 1920), (987, 610), (610, 987), (7, 7), (2147483647, 2), (0, 3), (None, 3)], "w int, h int")
    got = [x[0] for x in sizes.select(S.aspect_ratio(F.col("w"), F.col("h"))).collect()]
    assert got == ["9:16", "987:610", "610:987", "1:1", "2147483647:2", None, None]


def test_documents_are_parsed_once_a_row(spark, sf):
    from cliplake.plans import catalogue

    assert parses(catalogue.queries()["contract_verdicts"](spark, sf)) == 1
    schema = {"type": "object", "required": ["a", "z"], "additionalProperties": False, "properties": {"a": {"type": ["integer", "null"]}, "b": {"type": "object", "required": ["c"], "properties": {"c": {"type": "string"}}}}}
    rows = spark.createDataFrame([('{"a":null,"b":{"c":null},"z":1}',), ('{"b":{"d":1}}',), ("[1]",), (None,)], "j string")
    got = [x[0] for x in rows.select(validate.errors(F.parse_json("j"), schema)).collect()]
    assert got == [["$.b.c: expected string", "$: does not allow z"], ["$.b: lacks c", "$: lacks a", "$: lacks z"], ["$: expected object"], ["$: not a JSON document"]]
