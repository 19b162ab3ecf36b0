"""Merging model output with measured shots, with provenance. Errors are an array of messages beside the result; nothing raises.

Inputs per row: `shots` array<struct<shot_id:string,start_seconds:double,end_seconds:double>>
(measured), `analysis` and `synthesis` VARIANT objects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliplake.functions import scalars as S

# Closed enumerations.
FRAMING = ("extreme_close_up", "close_up", "medium", "wide", "extreme_wide")
CAMERA = ("static", "handheld", "pan", "tilt", "zoom_in", "zoom_out", "tracking")
TRANSITIONS = ("cut", "jump_cut", "whip_pan", "match_cut", "fade", "wipe", "none_single_shot")
CERTAINTIES = ("observed", "uncertain", "absent", "unknown")
HOOKS = ("question", "bold_claim", "curiosity_gap", "visual_shock", "direct_address", "problem_statement", "before_after_tease", "social_proof_open", "other")
NARRATIVES = ("problem_solution", "before_after", "tutorial_steps", "storytime", "listicle", "single_beat_no_narrative", "other")
CONFIDENCES = ("high", "medium", "low")
CTA_TYPES = ("link_in_bio", "follow", "comment", "share", "save", "shop_now", "affiliate_link", "other")
PROOFS = ("demonstration", "before_after", "testimonial", "credentials", "data_stats", "social_proof", "unknown")
STATUSES = ("commercial", "non_commercial", "uncertain")
SHOT_FIELDS = ("shot_id", "subjects", "actions", "visual_description", "framing", "camera_movement", "on_screen_text", "spoken_dialogue", "audio", "transition_in")


def _get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, f"$.{path}", kind)


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("missing"))


def _text(v: Column, path: str) -> Column:
    """A string; other kinds are null."""
    x = _get(v, path)
    return F.when(_kind(x) == "STRING", _get(v, path, "string"))


def _items(v: Column, path: str) -> Column:
    return F.coalesce(_get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def _strings(v: Column, path: str) -> Column:
    return F.transform(F.filter(_items(v, path), lambda x: _kind(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))


def _messages(*found: Column) -> Column:
    return F.filter(F.array(*found).cast("array<string>"), lambda m: m.isNotNull())


def _list(name: str, bad: Column) -> Column:
    return F.when(F.size(bad) > 0, F.concat(F.lit(f"{name}: "), F.array_join(bad, ", ")))


# ---- first pass: shots


def shot_analysis_errors(analysis: Column, shots: Column, required: Sequence[str] = SHOT_FIELDS) -> Column:
    """Duplicate, missing and unknown shots, lacking fields and blank descriptions; bounds that differ from the measured ones."""
    entries = _items(analysis, "shots")
    ids = F.transform(entries, lambda e: F.coalesce(_text(e, "shot_id"), F.lit("")))
    known = F.transform(shots, lambda s: s["shot_id"])
    twice = F.array_distinct(F.filter(ids, lambda i: F.size(F.filter(ids, lambda j: j == i)) > 1))
    lacking = F.flatten(F.transform(entries, lambda e: F.transform(F.filter(F.array(*[F.when(_get(e, f).isNull(), F.lit(f)) for f in required]), lambda f: f.isNotNull()), lambda f: F.concat_ws(".", _text(e, "shot_id"), f))))
    blank = F.filter(entries, lambda e: F.coalesce(F.trim(_text(e, "visual_description")), F.lit("")) == "")
    moved = lambda s, e, f: _get(e, f).isNotNull() & F.coalesce(F.abs(_get(e, f, "double") - s[f]) > 1e-6, F.lit(True))
    changed = F.filter(shots, lambda s: F.exists(entries, lambda e: (_text(e, "shot_id") == s["shot_id"]) & (moved(s, e, "start_seconds") | moved(s, e, "end_seconds"))))
    return _messages(
        F.when(~_kind(_get(analysis, "shots")).startswith("ARRAY"), "no array of shots"),
        F.when(F.exists(entries, lambda e: ~_kind(e).startswith("OBJECT")), "entries must be objects"),
        F.when(F.array_contains(ids, ""), "an entry lacks a shot_id"),
        _list("duplicate shots", twice),
        _list("shots without analysis", F.array_except(known, ids)),
        _list("unknown shots", F.array_except(F.filter(ids, lambda i: i != ""), known)),
        _list("missing fields", lacking),
        _list("blank descriptions", F.transform(blank, lambda e: F.coalesce(_text(e, "shot_id"), F.lit("?")))),
        _list("measured bounds overwritten", F.transform(changed, lambda s: s["shot_id"])),
    )


def merged_shots(analysis: Column, shots: Column, reference: Sequence[str] = ("shot_analysis/response_000.raw.txt",)) -> Column:
    """Measured bounds with cleaned model fields and evidence; the last entry of a shot counts."""
    entries = _items(analysis, "shots")

    def merge(s: Column) -> Column:
        e = F.element_at(F.filter(F.concat(F.array(F.parse_json(F.lit("{}"))), entries), lambda x: F.coalesce(_text(x, "shot_id") == s["shot_id"], _kind(x) == "OBJECT<>")), -1)
        said = lambda f: F.filter(_items(e, f), lambda t: F.coalesce(F.trim(_text(t, "text")), F.lit("")) != "")
        sure = lambda t: F.coalesce(_get(t, "exact", "boolean"), F.lit(False))
        audio = [c for k in ("music", "sfx", "ambience") for c in (_get(e, f"audio.{k}", "string").alias(k), F.when(_get(e, f"audio.{k}_certainty").isNotNull(), S.enum_or(_text(e, f"audio.{k}_certainty"), CERTAINTIES)).alias(f"{k}_certainty"))]
        where = F.concat(F.lit("perception shots.json#"), s["shot_id"], F.lit(" ["), s["start_seconds"].cast("string"), F.lit("-"), s["end_seconds"].cast("string"), F.lit("s]"))
        return F.struct(
            s["shot_id"].alias("shot_id"),
            s["start_seconds"].alias("start_seconds"),
            s["end_seconds"].alias("end_seconds"),
            _strings(e, "subjects").alias("subjects"),
            _strings(e, "actions").alias("actions"),
            _text(e, "visual_description").alias("visual_description"),
            S.enum_or(_text(e, "framing"), FRAMING).alias("framing"),
            S.enum_or(_text(e, "camera_movement"), CAMERA).alias("camera_movement"),
            F.transform(said("on_screen_text"), lambda t: F.struct(_text(t, "text").alias("text"), sure(t).alias("exact"))).alias("on_screen_text"),
            F.transform(said("spoken_dialogue"), lambda t: F.struct(_text(t, "speaker").alias("speaker"), _text(t, "text").alias("text"), S.exact_quote(sure(t), _text(t, "confidence")).alias("exact"))).alias("spoken_dialogue"),
            F.struct(*audio).alias("audio"),
            S.enum_or(_text(e, "transition_in"), TRANSITIONS).alias("transition_in"),
            F.concat(F.array(S.reference("deterministic", where)), F.array(*[S.reference("model_observation", F.lit(r)) for r in reference])).alias("evidence"),
        )

    return F.transform(shots, merge)


# ---- second pass: synthesis


def _confidence(v: Column) -> Column:
    return S.enum_or(_text(v, "confidence"), CONFIDENCES, "low")


def labeled(v: Column, path: str, allowed: Sequence[str] | None = None) -> Column:
    """struct(value, confidence, rationale); with `allowed`, other values are unknown."""
    block = _get(v, path)
    value = F.when(_kind(block).startswith("OBJECT"), _get(block, "value", "string"))
    return F.struct((S.enum_or(value, allowed) if allowed else value).alias("value"), _confidence(block).alias("confidence"), _text(block, "rationale").alias("rationale"))


def labels(v: Column, path: str) -> Column:
    """struct(label, confidence, rationale) of objects with a label and of bare strings."""
    bare = lambda x: F.when(_kind(x) == "STRING", F.try_variant_get(x, "$", "string"))
    every = F.transform(_items(v, path), lambda x: F.struct(F.coalesce(bare(x), _text(x, "label")).alias("label"), _confidence(x).alias("confidence"), _text(x, "rationale").alias("rationale")))
    return F.filter(every, lambda x: x["label"].isNotNull())


def string_list(v: Column, path: str) -> Column:
    """A list of strings or one string, without blanks; null for anything else."""
    x = _get(v, path)
    kind = _kind(x)
    one = F.filter(F.array(_get(v, path, "string")), lambda s: F.trim(s) != "")
    every = F.forall(_items(v, path), lambda i: _kind(i) == "STRING")
    return F.when(kind.isin("missing", "VOID"), F.array().cast("array<string>")).when(kind == "STRING", one).when(kind.startswith("ARRAY") & every, F.filter(_strings(v, path), lambda s: F.trim(s) != ""))


def commercial(v: Column) -> Column:
    """struct(status, details); details are null for non_commercial."""
    block, d = _get(v, "inferred.commercial"), _get(v, "inferred.commercial.details")
    status = S.enum_or(_text(block, "status"), STATUSES, "uncertain")
    cta = F.when(_kind(_get(d, "cta")).startswith("OBJECT"), F.struct(_text(d, "cta.text").alias("text"), _get(d, "cta.text_exact", "boolean").alias("text_exact"), S.enum_or(_text(d, "cta.type"), CTA_TYPES, "other").alias("type")))
    details = F.struct(
        _get(d, "product_presence", "string").alias("product_presence"),
        _get(d, "first_product_appearance_seconds", "double").alias("first_product_appearance_seconds"),
        _get(d, "problem_desire", "string").alias("problem_desire"),
        _get(d, "promise_claim", "string").alias("promise_claim"),
        _get(d, "offer", "string").alias("offer"),
        S.enum_or(_text(d, "proof_type"), PROOFS, None).alias("proof_type"),
        _strings(d, "trust_signals").alias("trust_signals"),
        _strings(d, "objections").alias("objections"),
        cta.alias("cta"),
    )
    return F.struct(status.alias("status"), F.when(status != "non_commercial", details).alias("details"))


def synthesis_errors(v: Column, shots: Column) -> Column:
    """Lacking parts, contradictions about a call to action, unknown or missing shots and vague intents."""
    known = F.transform(shots, lambda s: s["shot_id"])
    gen = _items(v, "generation.shots")
    ids = F.transform(gen, lambda g: F.coalesce(_text(g, "shot_id"), F.lit("?")))
    vague = F.filter(gen, lambda g: F.array_contains(known, _text(g, "shot_id")) & ~S.meaningful(_get(g, "reconstruction_intent", "string")))
    bare = lambda x: F.when(_kind(x) == "STRING", F.try_variant_get(x, "$", "string"))
    hints = F.concat(F.array(_text(v, "marketing_evidence")), F.flatten(F.transform(_items(v, "inferred.persuasion_mechanisms"), lambda m: F.array(bare(m), _text(m, "label"), _text(m, "rationale")))))
    status = _text(v, "inferred.commercial.status")
    return _messages(
        *[F.when(_get(v, k).isNull(), f"lacks {k}") for k in ("observed_summary", "inferred", "generation", "inferred.commercial")],
        F.when(_get(v, "observed_summary").isNotNull() & (F.coalesce(_get(v, "observed_summary", "string"), F.lit("")) == ""), "no observed_summary"),
        F.when(_text(v, "generation.global_brief").isNull(), "generation.global_brief must be a string"),
        F.when(~_kind(_get(v, "generation.shots")).startswith("ARRAY"), "generation.shots must be an array"),
        F.when((status == "non_commercial") & F.exists(hints, S.mentions_cta), "non_commercial, but its evidence names a call to action"),
        F.when((status == "commercial") & ~_kind(_get(v, "inferred.commercial.details")).startswith("OBJECT"), "commercial requires details"),
        _list("unknown shots", F.array_except(ids, known)),
        _list("vague instructions", F.transform(vague, lambda g: _text(g, "shot_id"))),
        _list("shots without instructions", F.array_sort(F.array_except(known, ids))),
        F.when(string_list(v, "generation.continuity_constraints").isNull(), "generation.continuity_constraints must be a list of strings"),
    )


def merged_synthesis(v: Column, reference: str = "synthesis/response.raw.txt") -> tuple[Column, Column, Column]:
    """(observed without shots, inferred, generation)."""
    number = lambda p: F.when(_kind(_get(v, p)).rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)"), _get(v, p, "double"))
    refs = F.transform(_get(v, "hook.evidence", "array<string>"), lambda r: S.reference("model_observation", r))
    refs = F.when(F.coalesce(F.size(refs), F.lit(0)) > 0, refs).otherwise(F.array(S.reference("model_observation", F.lit(f"{reference}#hook"))))
    hook = F.struct(_text(v, "hook.description").alias("description"), refs.alias("evidence"), number("hook.start_seconds").alias("start_seconds"), number("hook.end_seconds").alias("end_seconds"))
    observed = F.struct(F.coalesce(_get(v, "observed_summary", "string"), F.lit("")).alias("summary"), hook.alias("hook"), _get(v, "narrative_evidence", "string").alias("narrative_evidence"), _get(v, "marketing_evidence", "string").alias("marketing_evidence"), number("first_product_appearance_seconds").alias("first_product_appearance_seconds"))
    mechanism = _get(v, "inferred.hook_mechanism")
    inferred = F.struct(
        labeled(v, "inferred.concept").alias("concept"),
        labeled(v, "inferred.target_audience_hypothesis").alias("target_audience_hypothesis"),
        labeled(v, "inferred.hook_type", HOOKS).alias("hook_type"),
        F.when(_text(mechanism, "label").isNotNull(), F.struct(_text(mechanism, "label").alias("label"), _confidence(mechanism).alias("confidence"), _text(mechanism, "rationale").alias("rationale"))).alias("hook_mechanism"),
        labeled(v, "inferred.narrative_structure", NARRATIVES).alias("narrative_structure"),
        labels(v, "inferred.attention_mechanisms").alias("attention_mechanisms"),
        labels(v, "inferred.persuasion_mechanisms").alias("persuasion_mechanisms"),
        commercial(v).alias("commercial"),
    )
    generation = F.struct(
        F.coalesce(F.nullif(_get(v, "generation.global_brief", "string"), F.lit("")), _get(v, "observed_summary", "string"), F.lit("")).alias("global_brief"),
        *[_text(v, f"generation.{k}").alias(k) for k in ("timeline_pacing", "text_treatment", "transitions", "payoff_timing")],
        string_list(v, "generation.continuity_constraints").alias("continuity_constraints"),
        F.transform(_items(v, "generation.shots"), lambda g: F.struct(_text(g, "shot_id").alias("shot_id"), F.trim(_get(g, "reconstruction_intent", "string")).alias("reconstruction_intent"))).alias("shots"),
    )
    return observed, inferred, generation


def source_block(meta: Column, facts: Column, platform: str, url_pattern: str, manifest: Column | None = None) -> Column:
    """The source of a document from collector metadata (VARIANT; a raw payload, one below `raw`, or the normalised fields) and media facts (struct). url_pattern, with %s for the id, serves where no page is known."""
    raw = F.when(_kind(_get(meta, "raw")).startswith("OBJECT"), _get(meta, "raw")).otherwise(meta)
    either = lambda *paths: F.coalesce(*[F.nullif(F.try_variant_get(v, f"$.{p}", "string"), F.lit("")) for p in paths for v in (raw, meta)])
    ident = either("id", "video_id")
    caption = either("description", "caption")
    stamp = _get(raw, "timestamp")
    epoch = F.when(_kind(stamp).rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)"), S.epoch_iso(F.floor(F.try_variant_get(raw, "$.timestamp", "double")).cast("bigint")))
    return F.struct(
        F.lit(platform).alias("platform"),
        ident.alias("video_id"),
        F.coalesce(either("webpage_url", "source_url"), F.format_string(url_pattern, ident)).alias("source_url"),
        S.handle(either("uploader", "creator_handle")).alias("creator_handle"),
        caption.alias("caption"),
        F.coalesce(S.caption_hashtags(caption), F.array().cast("array<string>")).alias("hashtags"),
        facts["duration_seconds"].alias("duration_seconds"),
        F.coalesce(epoch, either("published_at")).alias("published_at"),
        facts["sha256"].alias("artifact_sha256"),
        (F.lit(None).cast("string") if manifest is None else manifest).alias("manifest_reference"),
    )


def creative_document(rows: DataFrame) -> DataFrame:
    """Adds `merge_errors` and `document` (null if there are errors) to rows with shots, analysis, synthesis, source (struct) and decompilation (struct)."""
    a, v, shots = F.col("analysis"), F.col("synthesis"), F.col("shots")
    observed, inferred, generation = merged_synthesis(v)
    rows = rows.withColumn("merge_errors", F.concat(shot_analysis_errors(a, shots), synthesis_errors(v, shots)))
    whole = F.struct(F.struct(F.lit("creative_ir").alias("name"), F.lit("0.1").alias("version")).alias("schema"), F.col("source"), F.col("decompilation"), observed.withField("shots", merged_shots(a, shots)).alias("observed"), inferred.alias("inferred"), generation.alias("generation"))
    return rows.withColumn("document", F.when(F.size("merge_errors") == 0, whole))
