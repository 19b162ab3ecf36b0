"""Evaluation of a run: what can be checked mechanically, a reviewer's scores, and the comparison of two runs with its decision.

An evaluation is a row: video_id, categories (map of category to struct(score,
notes, evidence)), unsupported_claims, missed_important_facts, and operational
figures. All is in array and map functions: a row holds one video, a rubric has
eleven categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliplake.operators import metrics, project

# The rubric, in order.
RUBRIC = ("media_facts", "shot_boundaries_timeline", "visible_text_ocr", "dialogue", "visual_description", "camera_editing", "audio", "hook", "narrative", "marketing_commercial_reasoning", "reconstruction_quality")
CLAIMS = {"on_screen_text": "exact_on_screen_text", "spoken_dialogue": "exact_spoken_quote", "music": "observed_music_identity", "sfx": "observed_sfx_identity", "ambience": "observed_ambience_identity"}

SCORE = "struct<score:int,notes:string,evidence:string>"
CLAIM = "array<map<string,string>>"
EVALUATION = f"video_id string, template_version string, categories map<string,{SCORE}>, unsupported_claims {CLAIM}, missed_important_facts {CLAIM}, schema_validation_success boolean, canonical_projection_success boolean, deterministic_fact_checks map<string,boolean>, certain_fabricated_claims {CLAIM}, latency_seconds double, api_usage map<string,bigint>, cost_usd double, model_call_count int"


def evaluations(documents: DataFrame) -> DataFrame:
    """Rows of EVALUATION from VARIANT documents (column document). Values of another type than theirs are null; a list that isn't one counts as none."""
    d = F.col("document")
    at = lambda p, kind: F.try_variant_get(d, f"$.{p}", kind)
    cells = {"video_id": at("run_metadata.video_id", "string")}
    for field in EVALUATION.removeprefix("video_id string, ").split(", "):
        name, kind = field.split(" ")
        cells[name] = at(name, kind)
    return documents.select(*[c.alias(n) for n, c in cells.items()])


def scores(categories: Column) -> Column:
    """Map of the rubric's categories that have a score, without others."""
    known = F.map_filter(categories, lambda k, v: k.isin(*RUBRIC) & v["score"].isNotNull())
    return F.coalesce(F.transform_values(known, lambda k, v: v["score"]), F.create_map().cast("map<string,int>"))


def average(scored: Column) -> Column:
    """Mean of a map of scores, rounded to 3; null if there is none."""
    values = F.map_values(scored)
    return F.round(F.try_divide(F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x), F.size(values)), 3)


def listed(values: Column) -> Column:
    """Length of a list; 0 if there is none."""
    return F.coalesce(F.size(values), F.lit(0))


def low_scores(scored: Column, least: int = 3) -> Column:
    """array<struct<category, score>> of scores below `least`, in the rubric's order."""
    every = F.transform(F.array(*[F.lit(c) for c in RUBRIC]), lambda c: F.struct(c.alias("category"), F.try_element_at(scored, c).alias("score")))
    return F.filter(every, lambda e: e["score"] < least)


def comparison(single: DataFrame, multi: DataFrame) -> DataFrame:
    """One row a video of `multi` (EVALUATION columns both), compared with its row in `single`: categories (in the rubric's order, delta only where both have a score), averages, counts, operational figures."""
    fields = [c for c in single.columns if c != "video_id"]
    s = single.select(F.col("video_id").alias("_of"), F.struct(*fields).alias("s"))
    m = multi.select("video_id", F.struct(*[c for c in multi.columns if c != "video_id"]).alias("m"))
    rows = m.join(s, F.col("video_id") == F.col("_of"), "left").withColumns({"single": scores(F.col("s.categories")), "multi": scores(F.col("m.categories"))})

    def row(c: Column) -> Column:
        said = lambda side: F.when(F.try_element_at(side, c).isNotNull(), F.struct(F.try_element_at(side, c)["notes"].alias("notes"), F.try_element_at(side, c)["evidence"].alias("evidence")))
        one, two = F.try_element_at("single", c), F.try_element_at("multi", c)
        return F.struct(c.alias("category"), one.alias("single_pass_score"), two.alias("multi_step_score"), (two - one).alias("delta"), said(F.col("s.categories")).alias("single_pass_evidence"), said(F.col("m.categories")).alias("multi_step_evidence"))

    both = lambda name, f: F.struct(f("s").alias("single_pass"), f("m").alias("multi_step")).alias(name)
    counts = lambda name, c: F.struct(listed(F.col(f"s.{c}")).alias("single_pass_count"), listed(F.col(f"m.{c}")).alias("multi_step_count")).alias(name)
    figures = lambda side, calls: F.struct(F.col(f"{side}.latency_seconds").alias("latency_seconds"), F.col(f"{side}.api_usage").alias("api_usage"), F.col(f"{side}.cost_usd").alias("cost_usd"), calls.alias("model_calls"))
    return rows.select(
        "video_id",
        F.coalesce("m.template_version", F.lit("0.1")).alias("template_version"),
        F.transform(F.array(*[F.lit(c) for c in RUBRIC]), row).alias("categories"),
        F.struct(average(F.col("single")).alias("single_pass"), average(F.col("multi")).alias("multi_step")).alias("overall_average"),
        counts("unsupported_claims", "unsupported_claims"),
        counts("material_omissions", "missed_important_facts"),
        both("schema_success", lambda side: F.coalesce(F.col(f"{side}.schema_validation_success"), F.lit(False))),
        F.coalesce("m.certain_fabricated_claims", F.array().cast(CLAIM)).alias("certain_fabricated_claims"),
        F.coalesce("m.deterministic_fact_checks", F.create_map().cast("map<string,boolean>")).alias("deterministic_fact_checks"),
        F.coalesce("m.canonical_projection_success", F.lit(True)).alias("canonical_projection_pass"),
        F.struct(figures("s", F.lit(1)).alias("single_pass"), figures("m", F.col("m.model_call_count")).alias("multi_step")).alias("operational"),
        low_scores(F.col("multi")).alias("low_categories"),
    )


def decide(compared: DataFrame) -> DataFrame:
    """compared (of comparison()) with gates, decision and follow_up."""
    of = lambda side: F.map_from_entries(F.transform(F.filter("categories", lambda c: c[side].isNotNull()), lambda c: F.struct(c["category"], c[side].cast("double"))))
    needed = {
        "schema_valid": F.col("schema_success.multi_step"),
        "projection_ok": F.col("canonical_projection_pass"),
        "facts": F.col("deterministic_fact_checks"),
        "fabricated": F.size("certain_fabricated_claims"),
        "multi_average": F.col("overall_average.multi_step"),
        "multi": of("multi_step_score"),
        "base": of("single_pass_score"),
        "multi_unsupported": F.col("unsupported_claims.multi_step_count"),
        "base_unsupported": F.col("unsupported_claims.single_pass_count"),
        "latency_seconds": F.col("operational.multi_step.latency_seconds"),
        "cost_usd": F.col("operational.multi_step.cost_usd"),
    }
    return metrics.decision_gates(compared.withColumns(needed)).drop(*needed)


def write_comparison(single: DataFrame, multi: DataFrame, path: str) -> DataFrame:
    """Comparison and decision, written as JSON with nulls; returns what was written."""
    out = decide(comparison(single, multi))
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return out.sparkSession.read.schema(out.schema).json(path)


def bounds(shots: Column) -> Column:
    """Map of shot_id to (start, end)."""
    return F.map_from_entries(F.transform(shots, lambda s: F.struct(s["shot_id"], F.struct(s["start_seconds"].alias("start"), s["end_seconds"].alias("end")))))


def same_bounds(left: Column, right: Column) -> Column:
    """Whether two arrays of shots have the same ids with the same bounds, in any order."""
    sorted_ = lambda shots: F.array_sort(F.transform(shots, lambda s: F.struct(s["shot_id"].alias("shot_id"), s["start_seconds"].cast("double").alias("start"), s["end_seconds"].cast("double").alias("end"))))
    return sorted_(left).eqNullSafe(sorted_(right))


def claim_inventory(shots: Column) -> Column:
    """array<struct<kind, shot_id, claim>> of what is claimed with certainty, in shot order, that a reviewer has to verify."""
    kinds = F.create_map(*[F.lit(x) for kv in CLAIMS.items() for x in kv])

    def of(s: Column) -> Column:
        said = F.filter(project.claims(F.array(s)), lambda c: F.coalesce(c["text"], F.lit("")) != "")
        return F.transform(said, lambda c: F.struct(F.element_at(kinds, c["kind"]).alias("kind"), s["shot_id"].alias("shot_id"), c["text"].alias("claim")))

    return F.flatten(F.transform(shots, of))


def scaffold(rows: DataFrame) -> DataFrame:
    """Adds `evaluation` to rows with document (of merge.creative_document()), media_facts, shots (measured) and usage (struct total_latency_seconds, total_usage, total_cost_usd, model_call_count): fact checks, claims and figures; the scores are a reviewer's."""
    d, facts, usage = F.col("document"), F.col("media_facts"), F.col("usage")
    checks = F.create_map(
        F.lit("duration_equal"), d["source"]["duration_seconds"].eqNullSafe(facts["duration_seconds"]),
        F.lit("artifact_sha256_equal"), d["source"]["artifact_sha256"].eqNullSafe(facts["sha256"]),
        F.lit("boundaries_equal"), same_bounds(d["observed"]["shots"], F.col("shots")),
    )
    none = F.array().cast(CLAIM)
    out = F.struct(
        d["source"]["video_id"].alias("video_id"),
        F.lit("0.1").alias("template_version"),
        F.create_map().cast(f"map<string,{SCORE}>").alias("categories"),
        none.alias("unsupported_claims"),
        none.alias("missed_important_facts"),
        F.lit(True).alias("schema_validation_success"),
        F.lit(True).alias("canonical_projection_success"),
        checks.alias("deterministic_fact_checks"),
        none.alias("certain_fabricated_claims"),
        usage["total_latency_seconds"].alias("latency_seconds"),
        usage["total_usage"].alias("api_usage"),
        usage["total_cost_usd"].alias("cost_usd"),
        usage["model_call_count"].alias("model_call_count"),
        claim_inventory(d["observed"]["shots"]).alias("certain_claim_inventory"),
        F.lit(True).alias("scores_pending_manual_review"),
    )
    return rows.withColumn("evaluation", F.when(d.isNotNull(), out))


def record_manual_scores(evaluated: DataFrame, reviews: DataFrame) -> DataFrame:
    """evaluated (columns of an evaluation) with the categories, unsupported_claims and missed_important_facts of `reviews` (by video_id), no longer pending.

    An unknown category fails the run, as would a comparison with another rubric; so
    does a category without score, notes or evidence. Videos without a review stay
    as they are."""
    unknown = F.array_sort(F.array_except(F.map_keys("_categories"), F.array(*[F.lit(c) for c in RUBRIC])))
    partial = F.map_keys(F.map_filter("_categories", lambda k, v: v["score"].isNull() | v["notes"].isNull() | v["evidence"].isNull()))
    problem = F.when(F.size(unknown) > 0, F.concat(F.lit("unknown rubric categories: "), F.array_join(unknown, ", "))).when(F.size(partial) > 0, F.concat(F.lit("categories without score, notes or evidence: "), F.array_join(F.array_sort(partial), ", ")))
    r = reviews.select(F.col("video_id").alias("_of"), F.col("categories").alias("_categories"), F.col("unsupported_claims").alias("_claims"), F.col("missed_important_facts").alias("_missed"))
    r = r.withColumn("_categories", F.when(problem.isNotNull(), F.raise_error(problem).cast(f"map<string,{SCORE}>")).otherwise(F.col("_categories")))
    rows = evaluated.join(r, F.col("video_id") == F.col("_of"), "left")
    given = F.col("_of").isNotNull()
    none = F.array().cast(CLAIM)
    new = {
        "categories": F.when(given, F.col("_categories")).otherwise(F.col("categories")),
        "unsupported_claims": F.when(given, F.coalesce("_claims", none)).otherwise(F.col("unsupported_claims")),
        "missed_important_facts": F.when(given, F.coalesce("_missed", none)).otherwise(F.col("missed_important_facts")),
        "scores_pending_manual_review": ~given & (F.col("scores_pending_manual_review") if "scores_pending_manual_review" in evaluated.columns else F.lit(True)),
    }
    return rows.withColumns(new).select(*dict.fromkeys([*evaluated.columns, *new]))
