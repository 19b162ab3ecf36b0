"""The versioned document contracts, and validation by name: the schema first, then rules over several fields.

A contract is a JSON schema built from the notation below; the platform is a
parameter. validate() compiles it to one column of violations."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliplake.operators import merge, validate

# Fixed values that only contracts need.
ANNOTATION = ("automated", "manual", "hybrid")
SUBJECTS = ("person_creator", "other_people", "product", "food", "environment", "text_overlay_only", "none_visible")
TEXT_ROLES = ("caption_style", "instructional", "promotional", "decorative")
APPROVALS = ("pending_owner_approval", "approved", "retired")
COMMERCIAL_MODES = ("allowed", "required", "excluded", "allowed_flagged")
REPOSTS = ("excluded_with_duplicate_of_note", "flagged_creative_duplicate", "treated_independent")
NEAR_DUPLICATES = ("manual_during_pilot", "automated", "none")
METRICS = ("views", "likes", "comments", "shares", "saves")
OBSERVED = ("none", "uncertain", "present")

_TEXT, _FULL = {"type": "string"}, {"type": "string", "minLength": 1}
_BOOLEAN, _COUNT = {"type": "boolean"}, {"type": "integer", "minimum": 0}
_SECONDS = {"type": "number", "minimum": 0}
_TIME = {"type": "string", "format": "date-time"}


def _or_null(rule: dict) -> dict:
    return {**rule, "type": [rule["type"], "null"]}


def _list(rule: dict, **more) -> dict:
    return {"type": "array", "items": rule, **more}


def _enum(values, *extra) -> dict:
    return {"enum": [*extra, *values]}


def _either(values, *extra) -> dict:
    return {"anyOf": [{"enum": list(extra)}, _enum(values)]}


def _closed(required: str = "", **props) -> dict:
    """An object with these properties and no others; `required` names some, "*" all."""
    return {"type": "object", "additionalProperties": False, "required": list(props) if required == "*" else required.split(), "properties": props}


def _head(name: str) -> dict:
    return _closed("*", name={"const": name}, version={"const": "0.1"})


def _canonical(platform: str) -> dict:
    labels = _list(_FULL, uniqueItems=True)
    flag = _or_null(_BOOLEAN)
    features = _closed(
        "hook_present shot_count shot_duration_mean_seconds subject_categories commercial_status visible_text_present spoken_dialogue_present camera_motion_categories transition_categories music_present sfx_present cta_type proof_labels trust_labels persuasion_labels",
        hook_present=flag,
        hook_type=_either(merge.HOOKS, None, "unknown"),
        hook_end_seconds=_or_null(_SECONDS),
        shot_count={"type": "integer", "minimum": 1},
        shot_duration_min_seconds=_or_null(_SECONDS),
        shot_duration_max_seconds={"type": ["number", "null"], "exclusiveMinimum": 0},
        shot_duration_mean_seconds=_or_null(_SECONDS),
        subject_categories=_list(_enum(SUBJECTS), uniqueItems=True),
        commercial_status=_enum(merge.STATUSES),
        product_present=flag,
        first_product_appearance_seconds=_or_null(_SECONDS),
        visible_text_present=flag,
        visible_text_roles=_list(_enum(TEXT_ROLES), uniqueItems=True),
        spoken_dialogue_present=flag,
        camera_motion_categories=_list(_enum(merge.CAMERA), uniqueItems=True),
        transition_categories=_list(_enum(merge.TRANSITIONS), uniqueItems=True),
        music_present=flag,
        sfx_present=flag,
        narrative_structure=_either(merge.NARRATIVES, None, "unknown"),
        attention_mechanism_labels=labels,
        cta_type=_either(merge.CTA_TYPES, None, "not_applicable"),
        proof_labels=labels,
        trust_labels=labels,
        persuasion_labels=labels,
    )
    source = _closed("platform video_id", platform={"const": platform}, video_id=_FULL, source_url={"type": ["string", "null"], "format": "uri"})
    reference = _closed("pipeline_version prompt_version", pipeline_version=_FULL, prompt_version=_FULL, annotation_mode=_enum(ANNOTATION))
    return _closed("*", schema=_head("canonical_ir"), source=source, decompilation_ref=reference, features=features)


def _performance(platform: str) -> dict:
    counts = _closed("views likes comments shares", **{m: _or_null(_COUNT) for m in METRICS})
    collector = _closed("name collected_at", name=_FULL, version=_or_null(_TEXT), method=_or_null(_TEXT), collected_at=_TIME, raw_payload_reference=_or_null(_TEXT))
    return _closed(
        "schema platform video_id observed_at metrics collector",
        schema=_head("performance"),
        platform={"const": platform},
        video_id=_FULL,
        source_url={"type": ["string", "null"], "format": "uri"},
        creator_handle=_or_null(_TEXT),
        creator_id=_or_null(_TEXT),
        published_at=_or_null(_TIME),
        observed_at=_TIME,
        age_since_publish_seconds=_or_null(_SECONDS),
        metrics=counts,
        follower_count_at_observation=_or_null(_COUNT),
        collector=collector,
        notes=_or_null(_TEXT),
    )


def _creative(platform: str) -> dict:
    confidence = _enum(merge.CONFIDENCES)
    evidence = _list(_closed("kind", kind=_enum(("deterministic", "model_observation")), reference=_TEXT))
    valued = lambda rule: _closed("value confidence", value=rule, confidence=confidence, rationale=_or_null(_TEXT))
    labeled = _closed("value confidence", value=_or_null(_TEXT), confidence=confidence, rationale=_or_null(_TEXT), evidence_refs=evidence)
    free = _closed("label confidence", label=_FULL, confidence=confidence, rationale=_or_null(_TEXT))
    certainty = _enum(merge.CERTAINTIES)
    audio = {k: v for c in ("music", "sfx", "ambience") for k, v in ((c, _or_null(_TEXT)), (f"{c}_certainty", certainty))}
    shot = _closed(
        "shot_id start_seconds end_seconds visual_description evidence",
        shot_id={"type": "string", "pattern": "^shot_[0-9]{3,}$"},
        start_seconds=_SECONDS,
        end_seconds={"type": "number", "exclusiveMinimum": 0},
        subjects=_list(_TEXT),
        actions=_list(_TEXT),
        visual_description=_FULL,
        framing=_either(merge.FRAMING, "unknown"),
        camera_movement={"anyOf": [{"enum": ["unknown"]}, _enum(merge.CAMERA), {"type": "null"}]},
        on_screen_text=_list(_closed("*", text=_FULL, exact=_BOOLEAN)),
        spoken_dialogue=_list(_closed("text exact", speaker=_or_null(_TEXT), text=_FULL, exact=_BOOLEAN)),
        audio=_closed("", **audio),
        transition_in=_either(merge.TRANSITIONS, "unknown"),
        evidence={**evidence, "minItems": 1},
    )
    cta = {**_closed("text type", text=_or_null(_TEXT), text_exact=_or_null(_BOOLEAN), type=_enum(merge.CTA_TYPES)), "type": ["object", "null"]}
    details = _closed(
        "product_presence",
        product_presence=_or_null(_TEXT),
        first_product_appearance_seconds=_or_null(_SECONDS),
        problem_desire=_or_null(_TEXT),
        promise_claim=_or_null(_TEXT),
        proof_type=_either([p for p in merge.PROOFS if p != "unknown"], None, "unknown"),
        trust_signals=_list(_TEXT),
        objections=_list(_TEXT),
        offer=_or_null(_TEXT),
        cta=cta,
    )
    status = lambda s: {"properties": {"status": {"const": s}}}
    commercial = {
        **_closed("status", status=_enum(merge.STATUSES), details={"anyOf": [details, {"type": "null"}]}),
        "allOf": [{"if": status("non_commercial"), "then": {"properties": {"details": {"const": None}}}}, {"if": status("commercial"), "then": {"required": ["details"]}}],
    }
    source = _closed(
        "platform video_id source_url",
        platform={"const": platform},
        video_id=_FULL,
        source_url={"type": "string", "format": "uri"},
        creator_handle=_or_null(_TEXT),
        caption=_or_null(_TEXT),
        hashtags=_list(_TEXT),
        duration_seconds={"type": ["number", "null"], "exclusiveMinimum": 0},
        published_at=_or_null(_TIME),
        artifact_sha256={"type": ["string", "null"], "pattern": "^[0-9a-f]{64}$"},
        manifest_reference=_or_null(_TEXT),
    )
    run = _closed("*", schema_version={"const": "0.1"}, pipeline_version=_FULL, model_id=_FULL, provider=_FULL, prompt_version=_FULL, created_at=_TIME, annotation_mode=_enum(ANNOTATION))
    hook = _closed("evidence", description=_or_null(_TEXT), start_seconds=_or_null(_SECONDS), end_seconds=_or_null(_SECONDS), evidence={**evidence, "minItems": 1})
    observed = _closed("summary shots", summary=_FULL, hook=hook, narrative_evidence=_or_null(_TEXT), marketing_evidence=_or_null(_TEXT), first_product_appearance_seconds=_or_null(_SECONDS), shots=_list(shot, minItems=1))
    inferred = _closed(
        "commercial",
        concept=labeled,
        target_audience_hypothesis=labeled,
        hook_type=valued(_either(merge.HOOKS, "unknown")),
        hook_mechanism=free,
        narrative_structure=valued(_either(merge.NARRATIVES, "unknown")),
        attention_mechanisms=_list(free),
        persuasion_mechanisms=_list(free),
        commercial=commercial,
    )
    generation = _closed("global_brief shots", global_brief=_FULL, timeline_pacing=_or_null(_TEXT), text_treatment=_or_null(_TEXT), transitions=_or_null(_TEXT), continuity_constraints=_list(_TEXT), payoff_timing=_or_null(_TEXT), shots=_list(_closed("*", shot_id=_TEXT, reconstruction_intent=_FULL)))
    return _closed("schema source decompilation observed inferred", schema=_head("creative_ir"), source=source, decompilation=run, observed=observed, inferred=inferred, generation=generation)


def _single_pass(platform: str) -> dict:
    sure = {"type": ["string", "null"], "enum": [None, *merge.CONFIDENCES]}
    seen = {"type": ["string", "null"], "enum": [None, *OBSERVED]}
    text, number = _or_null(_TEXT), {"type": ["number", "null"]}
    texts = {"type": ["array", "null"], "items": _TEXT}
    beat = _closed("index start_seconds end_seconds description", index={"type": "integer"}, start_seconds=_or_null(_SECONDS), end_seconds=_or_null(_SECONDS), boundary_confidence=sure, description=_TEXT, subjects_actions=text, camera_framing_movement=text, on_screen_text=texts, spoken_dialogue=text, transition_to_next=text)
    timed = lambda name: _list(_closed("text timestamp_seconds", text=_TEXT, timestamp_seconds=number, **{name: sure}))
    observed = _closed(
        "*",
        timeline=_list(beat),
        visible_text=timed("legibility_confidence"),
        dialogue=timed("confidence"),
        visual=_closed("", overall_description=text, setting=text, people_subjects=text, editing_style=text),
        audio=_closed("", music_presence=seen, music_description=text, sfx_events=texts, voiceover_presence=seen),
    )
    inferred = _closed("", hook=_closed("", evidence=text, mechanism=text), narrative_structure=text, audience_hypothesis=text, attention_mechanisms=texts, commercial_mechanisms=texts)
    steps = {"type": ["array", "null"], "items": _closed("*", shot_index={"type": "integer"}, instruction=_TEXT)}
    source = _closed("video_id", video_id=text, duration_seconds_claimed=number, resolution_claimed=text, fps_claimed=number)
    return _closed("schema_version source observed inferred generation", schema_version={"const": "0.1"}, source=source, observed=observed, inferred=inferred, generation=_closed("", global_instructions=text, per_shot_instructions=steps), uncertainties=texts)


def _cohort(platform: str) -> dict:
    rules = _list(_FULL, minItems=1)
    always = {"const": True}
    policy = ("store_published_at_when_available", "store_observed_at_for_every_snapshot", "store_creator_identity_when_available", "store_follower_count_when_available", "store_raw_metrics_unnormalized")
    return _closed(
        "cohort_id version approval_status niche_name niche_description platform languages geographic_constraints duration_seconds publication_window_policy commercial_content_policy creator_inclusion_rules format_inclusion_rules exclusion_rules duplicate_policy minimum_metadata_for_inclusion performance_observation_policy pilot_sampling_policy",
        cohort_id=_FULL,
        version=_FULL,
        approval_status=_enum(APPROVALS),
        approved_by=_or_null(_TEXT),
        approved_at=_or_null(_TEXT),
        selected_candidate=_FULL,
        niche_name=_FULL,
        niche_description=_FULL,
        platform={"const": platform},
        languages=_list(_TEXT, minItems=1),
        language_policy=_TEXT,
        geographic_constraints=_TEXT,
        duration_seconds=_closed("*", min=_SECONDS, max={"type": "number", "exclusiveMinimum": 0}),
        publication_window_policy=_FULL,
        commercial_content_policy=_closed("mode", mode=_enum(COMMERCIAL_MODES), flag_values=_list(_TEXT), rules=_TEXT),
        creator_inclusion_rules=rules,
        format_inclusion_rules=rules,
        exclusion_rules=rules,
        duplicate_policy=_closed("same_video_id direct_reposts near_duplicate_detection", same_video_id={"const": "one_source_record"}, direct_reposts=_enum(REPOSTS), near_duplicate_detection=_enum(NEAR_DUPLICATES), near_duplicate_rule=_TEXT),
        minimum_metadata_for_inclusion=_list(_TEXT, minItems=1),
        performance_observation_policy=_closed("*", **{p: always for p in policy}, raw_metrics=_list(_enum(METRICS), minItems=1, uniqueItems=True)),
        pilot_sampling_policy=_closed(
            "target_size_range method stratification viral_only_sampling_allowed",
            target_size_range=_list({"type": "integer", "minimum": 1}, minItems=2, maxItems=2),
            method=_FULL,
            performance_strata=_list(_TEXT),
            stratification=_TEXT,
            max_videos_per_creator={"type": "integer", "minimum": 1},
            viral_only_sampling_allowed={"const": False},
        ),
        version_change_triggers=_list(_TEXT),
    )


CONTRACTS = {"creative_ir_v0_1": _creative, "canonical_ir_v0_1": _canonical, "performance_v0_1": _performance, "single_pass_v0_1": _single_pass, "pilot_cohort": _cohort}
PLATFORM = "short_video"


@cache
def load_schema(name: str, platform: str = PLATFORM) -> dict:
    """The schema of a contract, built once."""
    if name not in CONTRACTS:
        raise KeyError(f"no contract {name}; there are {', '.join(CONTRACTS)}")
    return CONTRACTS[name](platform)


def _semantic(document: Column, name: str) -> list[Column]:
    """Messages (or null) of rules that a schema can't state; null-safe where a field is absent."""
    at = lambda p, kind: F.try_variant_get(document, p, kind)
    if name == "creative_ir_v0_1":
        shots = F.transform(F.coalesce(at("$.observed.shots", "array<variant>"), F.array().cast("array<variant>")), lambda s: F.struct(F.try_variant_get(s, "$.start_seconds", "double").alias("start_seconds"), F.try_variant_get(s, "$.end_seconds", "double").alias("end_seconds")))
        known = F.filter(shots, lambda s: s["start_seconds"].isNotNull() & s["end_seconds"].isNotNull())
        found = validate.shot_errors(known)
        hook = validate.hook_error(at("$.observed.hook.start_seconds", "double"), at("$.observed.hook.end_seconds", "double"))
        return [F.when(F.size(found) > 0, F.concat(F.lit("$.observed.shots: "), F.array_join(F.array_distinct(found), "; "))), F.when(hook.isNotNull(), F.concat(F.lit("$.observed.hook: "), hook))]
    if name == "performance_v0_1":
        time = lambda p: F.try_to_timestamp(at(p, "string"))
        age = validate.age_error(time("$.observed_at"), time("$.published_at"), at("$.age_since_publish_seconds", "double"))
        return [F.when(age.isNotNull(), F.concat(F.lit("$.age_since_publish_seconds: "), age))]
    return []


def violations(document: Column, name: str, platform: str = PLATFORM) -> Column:
    """array<struct<path, message>> of a VARIANT document against a contract: those of its schema by path, then those of the rules over several fields."""
    cut = lambda m: F.struct(F.substring_index(m, ": ", 1).alias("path"), F.substr(m, F.locate(": ", m) + 2).alias("message"))

    def found(d: Column) -> Column:
        rules = F.filter(F.array(*_semantic(d, name)).cast("array<string>"), lambda m: m.isNotNull())
        return F.transform(F.concat(validate.errors(d, load_schema(name, platform)), rules), cut)

    return validate.let(document, found)


def require_valid(rows: DataFrame, document: str, name: str, platform: str = PLATFORM) -> DataFrame:
    """rows, if all their documents are valid; the run fails with the first violation of one that isn't."""
    found = F.get(violations(F.col(document), name, platform), F.lit(0))
    said = F.concat(F.lit(f"{name} validation failed at "), found["path"], F.lit(": "), found["message"])
    checked = F.when(found.isNotNull(), F.raise_error(said).cast("boolean")).otherwise(True)
    return rows.withColumn("_valid", checked).where("_valid").drop("_valid")


def verdict(document: Column, name: str, platform: str = PLATFORM) -> Column:
    """struct(valid, errors)."""
    return validate.let(violations(document, name, platform), lambda found: F.struct((F.size(found) == 0).alias("valid"), found.alias("errors")))
