"""Projection of a rich video description to the compact feature vector, in array functions: no explode, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliplake.functions import arrays as A
from cliplake.functions import scalars as S

SHOT = "struct<start_seconds:double,end_seconds:double,subjects:array<string>,camera_movement:string,transition_in:string,on_screen_text:array<struct<text:string,exact:boolean>>,spoken_dialogue:array<struct<speaker:string,text:string,exact:boolean>>,audio:struct<music:string,music_certainty:string,sfx:string,sfx_certainty:string,ambience:string,ambience_certainty:string>>"
LABEL = "struct<value:string,label:string,confidence:string,rationale:string>"
DOCUMENT = f"struct<source:struct<platform:string,video_id:string,source_url:string>,decompilation:struct<pipeline_version:string,prompt_version:string,annotation_mode:string>,observed:struct<shots:array<{SHOT}>,hook:struct<description:string,start_seconds:double,end_seconds:double,evidence:array<string>>>,inferred:struct<commercial:struct<status:string,details:struct<product_presence:string,first_product_appearance_seconds:double,proof_type:string,trust_signals:array<string>,cta:struct<text:string,text_exact:boolean,type:string>>>,hook_type:{LABEL},narrative_structure:{LABEL},attention_mechanisms:array<{LABEL}>,persuasion_mechanisms:array<{LABEL}>>>"


def _list(c: Column, kind: str = "array<string>") -> Column:
    return F.coalesce(c, F.array().cast(kind))


def features(doc: Column) -> Column:
    """Struct of the features of a DOCUMENT."""
    observed, inferred = doc["observed"], doc["inferred"]
    shots = observed["shots"]
    lengths = F.transform(shots, lambda s: s["end_seconds"] - s["start_seconds"])
    flat = lambda f, kind: F.flatten(F.transform(shots, lambda s: _list(s[f], kind)))
    subjects = flat("subjects", "array<string>")
    texts = flat("on_screen_text", "array<struct<text:string,exact:boolean>>")
    spoken = flat("spoken_dialogue", "array<struct<speaker:string,text:string,exact:boolean>>")
    classed = A.ordered_distinct(F.transform(subjects, S.subject_category))
    heard = lambda f: F.filter(F.transform(shots, lambda s: s["audio"][f]), lambda c: c.isNotNull() & (c != ""))
    deal = inferred["commercial"]
    details = deal["details"]
    sold = (deal["status"] == "commercial") & details.isNotNull()
    free = deal["status"] == "non_commercial"
    proof = F.when(sold & details["proof_type"].isNotNull() & (details["proof_type"] != "unknown"), F.array(details["proof_type"]))
    hook = observed["hook"]
    described = F.coalesce(hook["description"], F.lit("")) != ""
    evidence = F.coalesce(F.size(hook["evidence"]), F.lit(0)) > 0
    labels = lambda f: A.sorted_labels(F.transform(_list(inferred[f], "array<" + LABEL + ">"), lambda m: m["label"]))
    return F.struct(
        F.when(described, True).when(~evidence, False).alias("hook_present"),
        inferred["hook_type"]["value"].alias("hook_type"),
        hook["end_seconds"].alias("hook_end_seconds"),
        F.size(shots).alias("shot_count"),
        F.array_min(lengths).alias("shot_duration_min_seconds"),
        F.array_max(lengths).alias("shot_duration_max_seconds"),
        F.try_divide(F.aggregate(lengths, F.lit(0.0), lambda a, x: a + x), F.size(lengths)).alias("shot_duration_mean_seconds"),
        F.when(F.size(subjects) == 0, F.array(F.lit("none_visible"))).otherwise(classed).alias("subject_categories"),
        deal["status"].alias("commercial_status"),
        F.when(sold, details["product_presence"].isNotNull()).when(free, False).alias("product_present"),
        F.when(sold, details["first_product_appearance_seconds"]).alias("first_product_appearance_seconds"),
        (F.size(texts) > 0).alias("visible_text_present"),
        A.ordered_distinct(F.transform(texts, lambda t: S.text_role(t["text"]))).alias("visible_text_roles"),
        (F.size(spoken) > 0).alias("spoken_dialogue_present"),
        A.ordered_distinct(F.transform(shots, lambda s: s["camera_movement"])).alias("camera_motion_categories"),
        A.ordered_distinct(F.transform(shots, lambda s: s["transition_in"])).alias("transition_categories"),
        A.presence(heard("music_certainty")).alias("music_present"),
        A.presence(heard("sfx_certainty")).alias("sfx_present"),
        inferred["narrative_structure"]["value"].alias("narrative_structure"),
        labels("attention_mechanisms").alias("attention_mechanism_labels"),
        F.when(sold, details["cta"]["type"]).when(free, "not_applicable").alias("cta_type"),
        _list(proof).alias("proof_labels"),
        _list(F.when(sold, details["trust_signals"])).alias("trust_labels"),
        labels("persuasion_mechanisms").alias("persuasion_labels"),
    )


def canonical(doc: Column) -> Column:
    """The canonical document of a DOCUMENT."""
    return F.struct(F.struct(F.lit("canonical_ir").alias("name"), F.lit("0.1").alias("version")).alias("schema"), doc["source"].alias("source"), doc["decompilation"].alias("decompilation_ref"), features(doc).alias("features"))


def claims(shots: Column) -> Column:
    """Claims made with certainty, in shot order, then text, quotes, sounds: array of struct(kind, text)."""
    claim = lambda kind, t: F.struct(F.lit(kind).alias("kind"), t.alias("text"))

    def of(s: Column) -> Column:
        texts = F.transform(F.filter(s["on_screen_text"], lambda t: t["exact"]), lambda t: claim("on_screen_text", t["text"]))
        quotes = F.transform(F.filter(s["spoken_dialogue"], lambda t: t["exact"]), lambda t: claim("spoken_dialogue", t["text"]))
        sounds = F.array(*[F.when(s["audio"][f"{k}_certainty"] == "observed", claim(k, s["audio"][k])) for k in ("music", "sfx", "ambience")])
        empty = F.array().cast("array<struct<kind:string,text:string>>")
        return F.concat(F.coalesce(texts, empty), F.coalesce(quotes, empty), F.filter(sounds, lambda x: x.isNotNull()))

    return F.flatten(F.transform(shots, of))


def performance_snapshot(rows: DataFrame, platform: str, collector: str = "collector") -> DataFrame:
    """Adds `performance` to normalised rows with video_id, observed_at: null metrics stay null, a negative age is an error."""
    seen, out = F.try_to_timestamp("observed_at"), F.try_to_timestamp("published_at")
    age = S.age_seconds(seen, out)
    metrics = F.struct(*[F.col(c) for c in ("views", "likes", "comments", "shares", "saves")])
    made = F.struct(F.lit(platform).alias("platform"), F.col("video_id"), F.col("published_at"), F.col("observed_at"), age.alias("age_since_publish_seconds"), metrics.alias("metrics"), F.struct(F.lit(collector).alias("name"), F.col("observed_at").alias("collected_at")).alias("collector"))
    problem = F.when(F.col("video_id").isNull() | (F.col("video_id") == ""), "video_id is missing").when(seen.isNull(), "observed_at is not a timestamp").when(age < 0, "observed before it was published")
    return rows.withColumn("performance_error", problem).withColumn("performance", F.when(F.col("performance_error").isNull(), made))
