"""More registered queries: payloads, documents, merges, contracts and evaluations over the supplied tables, with their SQL.

Nested inputs are built from the tables' keys, so that every case of a rule occurs
and SQL can state what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from cliplake.functions import arrays as A
from cliplake.functions import scalars as S
from cliplake.operators import contracts, evaluation, merge, metrics, normalize, perception, project, relational, validate
from cliplake.plans.catalogue import _SHIP, _SHIP_SQL, _joined, _runs, _STATUS_SQL, _t, query


def _text(c):
    return c.cast("string")


def _case(by: str, *texts: str):
    """One of the SQL expressions, by a remainder."""
    out = F.when(F.expr(f"{by} % {len(texts)} = 0"), F.expr(texts[0]))
    for k, t in enumerate(texts[1:], 1):
        out = out.when(F.expr(f"{by} % {len(texts)} = {k}"), F.expr(t))
    return out


def _sql_case(by: str, *texts: str) -> str:
    return "CASE " + " ".join(f"WHEN {by} % {len(texts)} = {k} THEN {t}" for k, t in enumerate(texts)) + " END"


# ---- payloads and sources

_PAYLOADS = (
    """concat('{"author":{"unique_id":"@', source, '","uid":', doc_id, '},"desc":"a #', lang, ' b ##x","stats":{"play_count":', n_chars, ',"digg_count":"abc"},"digg_count":7,"create_time":', 1700000000 + doc_id, ',"video":{"duration":', doc_id, '.5}}')""",
    """concat('{"uploader":"', source, '","title":"t #', lang, '","hashtags":[],"view_count":', n_chars, '.7,"like_count":"12.5","comment_count":"3","timestamp":"","track":"","artist":"a"}')""",
    """concat('{"channel":5,"description":"no tags","text_extra":[{"hashtag_name":"', lang, '"},{"name":"#', lang, '"},"##z",{"other":1}],"views":null,"play_count":0,"repost_count":4,"createTime":"2024-01-01T00:00:00+00:00","duration":"7.25"}')""",
    "'{}'",
)


@query(f"""SELECT doc_id, CASE WHEN doc_id % 4 < 2 THEN source END AS creator_handle, CASE WHEN doc_id % 4 = 0 THEN CAST(doc_id AS VARCHAR) END AS creator_id,
 {_sql_case("doc_id", "concat('a #', lang, ' b ##x')", "concat('t #', lang)", "'no tags'", "NULL")} AS caption, {_sql_case("doc_id", "concat(lang, ',x')", "''", "concat(lang, ',', lang, ',z')", "''")} AS hashtags,
 CASE doc_id % 4 WHEN 0 THEN strftime(to_timestamp(1700000000 + doc_id) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S') || '+00:00' WHEN 2 THEN '2024-01-01T00:00:00+00:00' END AS published_at,
 CASE doc_id % 4 WHEN 0 THEN doc_id + 0.5 WHEN 2 THEN 7.25 END::DOUBLE AS duration_seconds, CASE doc_id % 4 WHEN 0 THEN n_chars WHEN 1 THEN n_chars WHEN 2 THEN 0 END AS views, NULL::BIGINT AS likes, CASE WHEN doc_id % 4 = 1 THEN 3 END::BIGINT AS comments, CASE WHEN doc_id % 4 = 2 THEN 4 END::BIGINT AS shares,
 NULL::VARCHAR AS music_title, CASE WHEN doc_id % 4 = 1 THEN 'a' END AS music_author FROM documents""")
def payload_fields(spark, sf):
    rows = _t(spark, sf, "documents").select("doc_id", F.parse_json(_case("doc_id", *_PAYLOADS)).alias("payload"))
    names = ("creator_handle", "creator_id", "caption", "published_at", "duration_seconds", "views", "likes", "comments", "shares", "music_title", "music_author")
    return normalize.normalize(rows).select("doc_id", *names, _joined(F.col("hashtags")).alias("hashtags"))


@query("""SELECT concat('u', doc_id) AS url, source AS creator_handle, concat(lang, ',b') AS hashtags, CASE WHEN doc_id % 2 = 0 THEN n_chars END AS views, lang AS mood FROM documents""")
def source_entries(spark, sf):
    from cliplake.sources import readers

    raw = _t(spark, sf, "documents").select(F.concat(F.lit("u"), "doc_id").alias("url"), F.concat(F.lit(" @@"), "source").alias("creator_handle"), F.concat("lang", F.lit("; ##b ;;")).alias("hashtags"), F.when(F.col("doc_id") % 2 == 0, _text(F.col("n_chars"))).otherwise("12.5").alias("views"), F.col("lang").alias("mood"))
    got = readers.entries(raw)
    return got.select("url", "creator_handle", _joined(F.col("hashtags")).alias("hashtags"), "views", F.col("extra")["mood"].alias("mood"))


@query(f"""SELECT page_id, CASE WHEN page_id % 4 < 3 THEN CAST(100000 + page_id AS VARCHAR) END AS ident, CASE WHEN page_id % 4 < 3 THEN concat('https://v.example/video/', 100000 + page_id) END AS canonical FROM pages""")
def video_ids(spark, sf):
    forms = ("concat('', 100000 + page_id)", "concat('https://v.example/video/', 100000 + page_id, '/more')", "concat('HTTPS://V.example/@u/video/', 100000 + page_id, '/?x=1')", "url")
    ident = S.video_id(_case("page_id", *forms), ("v.example",))
    rows = _t(spark, sf, "pages").select("page_id", ident.alias("ident"))
    return rows.withColumn("canonical", F.when(F.col("ident").isNotNull(), S.canonical_url(F.col("ident"), "https://v.example/video/%s")))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 > 0 THEN 10.5 END::DOUBLE AS duration_seconds, CASE WHEN p_partkey % 5 > 0 THEN p_size * 16 END::INT AS width, CASE WHEN p_partkey % 5 > 0 THEN concat(p_size * 16 // gcd(p_size * 16, 720), ':', 720 // gcd(p_size * 16, 720)) END AS aspect_ratio,
 CASE p_partkey % 5 WHEN 1 THEN round(30000 / 1001, 6) WHEN 4 THEN 25 END::DOUBLE AS fps, CASE p_partkey % 5 WHEN 1 THEN '30000/1001' WHEN 3 THEN 'N/A' WHEN 4 THEN '25/1' END AS fps_text, CASE WHEN p_partkey % 5 > 0 THEN 300 END::BIGINT AS frame_count FROM part""")
def media_facts(spark, sf):
    rate = _case("p_partkey", "''", "'30000/1001'", "'0/0'", "'N/A'", "'25/1'")
    raw = F.when(F.col("p_partkey") % 5 == 0, F.lit("no json")).otherwise(F.concat(F.lit('{"streams":[{"codec_type":"audio"},{"codec_type":"video","codec_name":"h264","width":'), F.col("p_size") * 16, F.lit(',"height":720,"avg_frame_rate":"'), rate, F.lit('","nb_frames":"300"}],"format":{"duration":"10.5"}}')))
    got = normalize.probe_facts(_t(spark, sf, "part").select("p_partkey", raw.alias("probe_json")))
    f = F.col("media_facts")
    return got.select("p_partkey", f["duration_seconds"].alias("duration_seconds"), f["width"].alias("width"), f["aspect_ratio"].alias("aspect_ratio"), F.round(f["fps"], 6).alias("fps"), f["fps_text"].alias("fps_text"), f["frame_count"].alias("frame_count"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 2 = 0 THEN 'é' ELSE 'x y z' END AS t FROM events""")
def escape_repair(spark, sf):
    body = F.when(F.col("event_id") % 2 == 0, F.lit("\\u00e9")).otherwise(F.lit("x\\u12 y\\ud83d z"))
    raw = F.concat(F.lit('```json\n{"k": '), F.get_json_object("props", "$.k"), F.lit(', "t": "'), body, F.lit('"}\n```'))
    v = S.parse_object_lenient(raw)
    return _t(spark, sf, "events").select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"), F.try_variant_get(v, "$.t", "string").alias("t"))


@query("""SELECT doc_id, CASE WHEN quality IS NULL THEN concat('{"doc_id":', doc_id, '}') ELSE concat('{"doc_id":', doc_id, ',"quality":', quality, '}') END AS dropped, concat('{"doc_id":', doc_id, ',"quality":', coalesce(CAST(quality AS VARCHAR), 'null'), '}') AS kept FROM documents LEFT JOIN labels USING (doc_id)""")
def null_modes(spark, sf):
    rows = _t(spark, sf, "documents").select("doc_id").join(_t(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return rows.select("doc_id", normalize.to_json(F.struct("doc_id", "quality"), False).alias("dropped"), normalize.to_json(F.struct("doc_id", "quality"), True).alias("kept"))


@query(f"""SELECT event_id, {_sql_case("event_id", "'ingestion_failed'", "'perception_failed'", "'decompilation_failed'", "'validation_failed'", "'other_failed'")} AS status, CASE WHEN event_id % 2 = 0 THEN 5.5 ELSE least(60.0, 5 * pow(2, event_id % 6)) END AS delay, concat(event_id, '.x') AS stem,
 concat(strftime(ts, '%Y%m%dT%H%M%SZ'), '_', left(md5(CAST(event_id AS VARCHAR)), 8)) AS run_id, concat(event_id, ' of ', event_type) AS prompt, round_even(event_id % 10 + 0.04 * 0.4, 6) AS second_try FROM events""")
def stage_texts(spark, sf):
    stage = _case("event_id", "'performance_snapshot'", "'perception'", "'decompile'", "'project_canonical'", "'other'")
    message = F.when(F.col("event_id") % 2 == 0, "please retry in 3.5 s").otherwise("no answer")
    ladder = S.seek_candidates((F.col("event_id") % 10).cast("double"), F.lit(0.01))
    return _t(spark, sf, "events").select("event_id", S.stage_failure(stage).alias("status"), S.retry_delay(message, F.col("event_id") % 6 + 1).alias("delay"), S.file_stem(F.concat(F.lit("/a.b/"), "event_id", F.lit(".x.mp4"))).alias("stem"), S.run_id(F.col("ts"), F.col("event_id")).alias("run_id"), S.render("{id} of {kind}", {"id": _text(F.col("event_id")), "kind": F.col("event_type")}).alias("prompt"), F.get(ladder, F.lit(1)).alias("second_try"))


@query("""SELECT l_orderkey, count(DISTINCT l_linenumber) = count(*) AS numbers_unique, bool_or(l_returnflag = 'A') AND bool_or(l_returnflag = 'R') AS has_both FROM lineitem GROUP BY l_orderkey""")
def unique_and_subset(spark, sf):
    rows = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("n"), F.collect_set("l_returnflag").alias("f"))
    return rows.select("l_orderkey", A.all_unique(F.col("n")).alias("numbers_unique"), A.subset(F.array(F.lit("A"), F.lit("R")), F.col("f")).alias("has_both"))


# ---- documents


_DETAILS = "o_orderpriority IN ('1-URGENT', '2-HIGH')"
_FEATURES_SQL = f"""
WITH s AS (SELECT l.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_SHIP_SQL}) AS p, coalesce(max(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY {_SHIP_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS e FROM lineitem l),
g AS (SELECT l_orderkey, count(*) AS shot_count, min(l_quantity - l_discount) AS shortest, max(l_quantity - l_discount) AS longest, round(avg(l_quantity - l_discount), 6) AS mean, CASE WHEN bool_or(l_returnflag = 'R') THEN true WHEN bool_and(l_returnflag = 'N') THEN false END AS music_present, bool_or(l_tax > 0.06) AS visible_text_present,
 count(*) FILTER (l_quantity <= l_discount) + count(*) FILTER (l_discount < greatest(e, 0.0)) + count(*) FILTER (l_discount < 0) AS n_errors FROM s GROUP BY l_orderkey),
f AS (SELECT l_orderkey, string_agg(l_linestatus, ',' ORDER BY p) AS motions FROM (SELECT l_orderkey, l_linestatus, min(p) AS p FROM s GROUP BY ALL) GROUP BY l_orderkey),
c AS (SELECT l_orderkey, string_agg(k, ',' ORDER BY p) AS subjects FROM (SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 'person_creator' ELSE 'food' END AS k, min(p) AS p FROM s WHERE l_returnflag <> 'N' GROUP BY ALL) GROUP BY l_orderkey),
r AS (SELECT l_orderkey, string_agg(k, ',' ORDER BY p) AS roles FROM (SELECT l_orderkey, CASE WHEN l_linenumber % 2 = 0 THEN 'promotional' ELSE 'instructional' END AS k, min(p) AS p FROM s WHERE l_tax > 0.06 GROUP BY ALL) GROUP BY l_orderkey)
SELECT o_orderkey AS video_id, shot_count, shortest, longest, mean, music_present, motions, n_errors, visible_text_present, coalesce(subjects, '') AS subjects, coalesce(roles, '') AS text_roles, CASE WHEN shot_count > 3 THEN true END AS hook_present,
 CASE o_orderstatus WHEN 'F' THEN {_DETAILS} WHEN 'O' THEN false END AS product_present, CASE o_orderstatus WHEN 'F' THEN 'shop_now' WHEN 'O' THEN 'not_applicable' END AS cta_type
FROM orders JOIN g ON o_orderkey = g.l_orderkey JOIN f ON o_orderkey = f.l_orderkey LEFT JOIN c ON o_orderkey = c.l_orderkey LEFT JOIN r ON o_orderkey = r.l_orderkey"""


@query(_FEATURES_SQL)
def canonical_features(spark, sf):
    """Flagship: shots in order per video, its document's compact features, and the shot rules, in one shuffle per table."""
    shots = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*_SHIP))).alias("s"))
    rows = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").join(shots, F.col("o_orderkey") == F.col("l_orderkey"))
    flag = lambda x, a, b, c: F.when(x["l_returnflag"] == "R", a).when(x["l_returnflag"] == "A", b).otherwise(c)
    none = F.lit(None).cast("string")
    labels = F.array().cast(f"array<{project.LABEL}>")

    def shot(x):
        text = F.struct(F.when(x["l_linenumber"] % 2 == 0, "Shop now").otherwise("Mix well").alias("text"), F.lit(True).alias("exact"))
        music = F.when(x["l_returnflag"] == "R", "observed").when(x["l_returnflag"] == "N", "absent").otherwise("unknown")
        return F.struct(
            x["l_discount"].alias("start_seconds"),
            x["l_quantity"].alias("end_seconds"),
            F.array(flag(x, F.lit("A hand"), F.lit("bread"), F.lit("sky"))).alias("subjects"),
            x["l_linestatus"].alias("camera_movement"),
            none.alias("transition_in"),
            F.when(x["l_tax"] > 0.06, F.array(text)).otherwise(F.array().cast("array<struct<text:string,exact:boolean>>")).alias("on_screen_text"),
            F.array().cast("array<struct<speaker:string,text:string,exact:boolean>>").alias("spoken_dialogue"),
            F.struct(none.alias("music"), music.alias("music_certainty"), none.alias("sfx"), none.alias("sfx_certainty"), none.alias("ambience"), none.alias("ambience_certainty")).alias("audio"),
        )

    rows = rows.withColumn("shots", F.transform("s", shot)).drop("s")
    hook = F.struct(F.when(F.size("shots") > 3, "d").alias("description"), F.lit(None).cast("double").alias("start_seconds"), F.lit(None).cast("double").alias("end_seconds"), F.array(F.lit("e")).alias("evidence"))
    details = F.struct(F.when(F.expr(_DETAILS), "shown").alias("product_presence"), F.lit(1.0).alias("first_product_appearance_seconds"), F.lit("unknown").alias("proof_type"), F.array().cast("array<string>").alias("trust_signals"), F.struct(none.alias("text"), F.lit(False).alias("text_exact"), F.lit("shop_now").alias("type")).alias("cta"))
    status = F.when(F.col("o_orderstatus") == "F", "commercial").when(F.col("o_orderstatus") == "O", "non_commercial").otherwise("uncertain")
    label = F.lit(None).cast(project.LABEL)
    inferred = F.struct(F.struct(status.alias("status"), F.when(status == "commercial", details).alias("details")).alias("commercial"), label.alias("hook_type"), label.alias("narrative_structure"), labels.alias("attention_mechanisms"), labels.alias("persuasion_mechanisms"))
    f = project.features(F.struct(F.struct(F.col("shots"), hook.alias("hook")).alias("observed"), inferred.alias("inferred")))
    return rows.select(
        F.col("o_orderkey").alias("video_id"),
        f["shot_count"].cast("bigint").alias("shot_count"),
        f["shot_duration_min_seconds"].alias("shortest"),
        f["shot_duration_max_seconds"].alias("longest"),
        F.round(f["shot_duration_mean_seconds"], 6).alias("mean"),
        f["music_present"].alias("music_present"),
        _joined(f["camera_motion_categories"]).alias("motions"),
        F.size(validate.shot_errors(F.col("shots"))).cast("bigint").alias("n_errors"),
        f["visible_text_present"].alias("visible_text_present"),
        _joined(f["subject_categories"]).alias("subjects"),
        _joined(f["visible_text_roles"]).alias("text_roles"),
        f["hook_present"].alias("hook_present"),
        f["product_present"].alias("product_present"),
        f["cta_type"].alias("cta_type"),
    )


_MERGE_SQL = """
WITH t AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
v AS (SELECT conv_id, count(*) AS k, string_agg(CASE n % 3 WHEN 0 THEN 'medium' ELSE 'unknown' END, ',' ORDER BY n) AS framings, count(*) FILTER (n % 2 = 0) AS quotes FROM t GROUP BY conv_id)
SELECT conv_id, CASE conv_id % 6 WHEN 1 THEN printf('shots without analysis: shot_%03d', k) WHEN 2 THEN 'unknown shots: shot_999' WHEN 3 THEN 'measured bounds overwritten: shot_001' WHEN 4 THEN 'non_commercial, but its evidence names a call to action' WHEN 5 THEN printf('shots without instructions: shot_%03d', k) ELSE '' END AS errors,
 CASE WHEN conv_id % 6 = 0 THEN k END AS shots, CASE WHEN conv_id % 6 = 0 THEN framings END AS framings, CASE WHEN conv_id % 6 = 0 THEN quotes END AS exact_quotes, CASE WHEN conv_id % 6 = 0 THEN 2 * k END AS evidence, CASE WHEN conv_id % 6 = 0 THEN 'unknown,low' END AS hook_type, CASE WHEN conv_id % 6 = 0 THEN 'bare,l' END AS attention, CASE WHEN conv_id % 6 = 0 THEN 'one' END AS constraints, CASE WHEN conv_id % 6 = 0 THEN 'non_commercial' END AS status FROM v"""


@query(_MERGE_SQL)
def document_merge(spark, sf):
    """Turns as shots: analyses and syntheses with every kind of error by conv_id, merged with the measured shots."""
    from pyspark.sql import Window as W

    n = F.row_number().over(W.partitionBy("conv_id").orderBy("turn"))
    rows = _t(spark, sf, "conversations").select("conv_id", "role", n.alias("n"))
    rows = rows.withColumn("shot_id", F.format_string("shot_%03d", "n"))
    framing = F.when(F.col("n") % 3 == 0, '"medium"').when(F.col("n") % 3 == 1, '"huge"').otherwise("null")
    entry = lambda ident, more: F.concat(F.lit('{"shot_id":"'), ident, F.lit('","subjects":["'), F.col("role"), F.lit('",5],"actions":[],"visual_description":"d","framing":'), framing, F.lit(',"camera_movement":"pan","on_screen_text":[{"text":"Buy","exact":true},{"text":" "}],"spoken_dialogue":[{"speaker":"a","text":"hi","exact":true,"confidence":"'), F.when(F.col("n") % 2 == 0, "high").otherwise("low"), F.lit('"}],"audio":{"music":"m","music_certainty":"loud"},"transition_in":"cut"'), more, F.lit("}"))
    moved = F.when((F.col("conv_id") % 6 == 3) & (F.col("n") == 1), ',"end_seconds":99').otherwise("")
    intent = F.concat(F.lit('{"shot_id":"'), "shot_id", F.lit('","reconstruction_intent":"' + "x" * 40 + '"}'))
    shot = F.struct("shot_id", (F.col("n") - 1).cast("double").alias("start_seconds"), F.col("n").cast("double").alias("end_seconds"))
    rows = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(shot)).alias("shots"), F.array_sort(F.collect_list(F.struct("n", entry(F.col("shot_id"), moved).alias("e"), entry(F.lit("shot_999"), F.lit("")).alias("x"), intent.alias("i")))).alias("t"))
    case = F.col("conv_id") % 6
    most = lambda drop: F.slice("t", F.lit(1), F.size("t") - F.when(case == drop, 1).otherwise(0))
    entries = F.concat(F.transform(most(1), lambda x: x["e"]), F.when(case == 2, F.transform(F.slice("t", 1, 1), lambda x: x["x"])).otherwise(F.array().cast("array<string>")))
    analysis = F.concat(F.lit('{"shots":['), F.array_join(entries, ","), F.lit("]}"))
    hint = F.when(case == 4, ',"marketing_evidence":"says link in bio"').otherwise("")
    synthesis = F.concat(F.lit('{"observed_summary":"s","hook":{"description":"h","start_seconds":0,"end_seconds":1.5},"inferred":{"commercial":{"status":"non_commercial","details":{"offer":"x"}},"hook_type":{"value":"loud","confidence":"sure"},"attention_mechanisms":["bare",{"label":"l","confidence":"high"},7]}'), hint, F.lit(',"generation":{"global_brief":"b","shots":['), F.array_join(F.transform(most(5), lambda x: x["i"]), ","), F.lit('],"continuity_constraints":"one"}}'))
    none = F.lit(None).cast("string")
    rows = rows.select("conv_id", "shots", F.parse_json(analysis).alias("analysis"), F.parse_json(synthesis).alias("synthesis"), F.struct(F.lit("p").alias("platform"), _text(F.col("conv_id")).alias("video_id"), none.alias("source_url")).alias("source"), F.struct(F.lit("1").alias("pipeline_version")).alias("decompilation"))
    rows = merge.creative_document(rows)
    d = F.col("document")
    shots = d["observed"]["shots"]
    count = lambda f: F.aggregate(shots, F.lit(0), lambda a, s: a + F.size(f(s))).cast("bigint")
    return rows.select(
        "conv_id",
        F.array_join("merge_errors", "; ").alias("errors"),
        F.when(d.isNotNull(), F.size(shots)).cast("bigint").alias("shots"),
        _joined(F.transform(shots, lambda s: s["framing"])).alias("framings"),
        count(lambda s: F.filter(s["spoken_dialogue"], lambda q: q["exact"])).alias("exact_quotes"),
        count(lambda s: s["evidence"]).alias("evidence"),
        F.when(d.isNotNull(), F.concat_ws(",", d["inferred"]["hook_type"]["value"], d["inferred"]["hook_type"]["confidence"])).alias("hook_type"),
        _joined(F.transform(d["inferred"]["attention_mechanisms"], lambda m: m["label"])).alias("attention"),
        _joined(d["generation"]["continuity_constraints"]).alias("constraints"),
        d["inferred"]["commercial"]["status"].alias("status"),
    )


@query(f"""SELECT o_orderkey, {_sql_case("o_orderkey", "NULL", "'observed before it was published'", "'observed_at is not a timestamp'", "'video_id is missing'")} AS error, CASE WHEN o_orderkey % 4 = 0 THEN 86400.0 END::DOUBLE AS age, CASE WHEN o_orderkey % 4 = 0 THEN o_custkey END AS views, NULL::BIGINT AS likes,
 CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 3 = 2 THEN 'age does not match the timestamps' END AS age_error FROM orders""")
def snapshot_records(spark, sf):
    day = lambda d: F.concat(F.date_format(F.col("o_orderdate") + F.expr(f"INTERVAL '{d}' DAY"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    seen = F.when(F.col("o_orderkey") % 4 == 1, day(-1)).when(F.col("o_orderkey") % 4 == 2, "x").otherwise(day(1))
    rows = _t(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 3, _text(F.col("o_orderkey"))).alias("video_id"), seen.alias("observed_at"), day(0).alias("published_at"), F.col("o_custkey").alias("views"), *[F.lit(None).cast("bigint").alias(c) for c in ("likes", "comments", "shares", "saves")])
    got = project.performance_snapshot(rows, "p")
    p = F.col("performance")
    claimed = F.element_at(F.array(F.lit(86400.0), F.lit(86400.5), F.lit(86410.0)), (F.col("o_orderkey") % 3 + 1).cast("int"))
    wrong = validate.age_error(F.try_to_timestamp(p["observed_at"]), F.try_to_timestamp(p["published_at"]), claimed)
    return got.select("o_orderkey", F.col("performance_error").alias("error"), p["age_since_publish_seconds"].alias("age"), p["metrics"]["views"].alias("views"), p["metrics"]["likes"].alias("likes"), wrong.alias("age_error"))


_KEYWORDS = {
    "type": "object",
    "required": ["a", "s", "l", "c"],
    "additionalProperties": False,
    "$defs": {"n": {"type": "integer", "minimum": 10}},
    "properties": {
        "a": {"$ref": "#/$defs/n"},
        "s": {"type": "string", "minLength": 9},
        "l": {"type": "array", "minItems": 2, "maxItems": 3, "uniqueItems": True, "items": {"type": "integer"}},
        "c": {"const": "k"},
        "e": {"enum": [None, "x"]},
        "x": {"type": ["number", "null"], "exclusiveMinimum": 0},
    },
}


@query("""SELECT p_partkey, array_to_string(list_sort(list_filter([CASE WHEN p_size < 10 THEN '$.a: less than 10' END, CASE WHEN length(p_brand) < 9 THEN '$.s: shorter than 9' END,
 CASE p_partkey % 4 WHEN 0 THEN '$.l: fewer than 2 items' WHEN 2 THEN '$.l: items are not unique' WHEN 3 THEN '$.l: more than 3 items' END, CASE WHEN p_partkey % 4 = 3 THEN '$.l[3]: expected integer' END,
 CASE WHEN p_partkey % 11 = 0 THEN '$: lacks c' WHEN p_partkey % 5 = 0 THEN '$.c: not one of k' END, CASE WHEN p_partkey % 3 = 2 THEN '$.e: not one of null, x' END, CASE WHEN p_partkey % 3 < 2 THEN '$.x: not more than 0' END, CASE WHEN p_partkey % 7 = 0 THEN '$: does not allow zz' END], lambda m: m IS NOT NULL)), '; ') AS errors FROM part""")
def schema_keywords(spark, sf):
    items = _case("p_partkey", "'[1]'", "'[1,2]'", "'[2,2]'", "'[1,2,3,\"4\"]'")
    const = F.when(F.col("p_partkey") % 11 == 0, "").when(F.col("p_partkey") % 5 == 0, ',"c":"z"').otherwise(',"c":"k"')
    extra = F.when(F.col("p_partkey") % 7 == 0, ',"zz":1').otherwise("")
    raw = F.concat(F.lit('{"a":'), "p_size", F.lit(',"s":"'), "p_brand", F.lit('","l":'), items, const, F.lit(',"e":'), _case("p_partkey", "'null'", "'\"x\"'", "'\"y\"'"), F.lit(',"x":'), F.col("p_partkey") % 3 - 1, extra, F.lit("}"))
    return _t(spark, sf, "part").select("p_partkey", F.array_join(validate.errors(F.parse_json(raw), _KEYWORDS), "; ").alias("errors"))


@query(f"""SELECT o_orderkey, {_sql_case("o_orderkey", "'true'", "'$.features.shot_count: less than 1'", "'$.features: does not allow generation'", "'$.features.subject_categories: items are not unique'", "'$.features.cta_type: fits none of the alternatives'")} AS verdict FROM orders""")
def contract_verdicts(spark, sf):
    cell = lambda good, bad, k: F.when(F.col("o_orderkey") % 5 == k, bad).otherwise(good)
    raw = F.concat(
        F.lit('{"schema":{"name":"canonical_ir","version":"0.1"},"source":{"platform":"short_video","video_id":"'),
        "o_orderkey",
        F.lit('"},"decompilation_ref":{"pipeline_version":"1","prompt_version":"1"},"features":{"hook_present":null,"shot_count":'),
        cell("1", "0", 1),
        F.lit(',"shot_duration_mean_seconds":1.0,"subject_categories":'),
        cell('["food"]', '["food","food"]', 3),
        F.lit(',"commercial_status":"uncertain","visible_text_present":false,"spoken_dialogue_present":false,"camera_motion_categories":[],"transition_categories":["cut"],"music_present":null,"sfx_present":false,"cta_type":'),
        cell("null", '"shout"', 4),
        cell("", ',"generation":"x"', 2),
        F.lit(',"proof_labels":[],"trust_labels":[],"persuasion_labels":[]}}'),
    )
    got = _t(spark, sf, "orders").select("o_orderkey", contracts.verdict(F.parse_json(raw), "canonical_ir_v0_1").alias("v"))
    said = F.array_join(F.transform("v.errors", lambda e: F.concat(e["path"], F.lit(": "), e["message"])), "; ")
    return got.select("o_orderkey", F.when(F.col("v.valid"), "true").otherwise(said).alias("verdict"))


@query("SELECT l_orderkey, count(*) FILTER (l_tax <= l_discount) AS wrong FROM lineitem GROUP BY l_orderkey")
def hook_errors(spark, sf):
    rows = _t(spark, sf, "lineitem").select("l_orderkey", validate.hook_error(F.col("l_discount"), F.col("l_tax")).alias("e"))
    return rows.groupBy("l_orderkey").agg(F.count("e").alias("wrong"))


# ---- ordered state


@query("""SELECT conv_id, turn, CASE WHEN n = 1 THEN 0.0 ELSE n END::DOUBLE AS start_seconds, CASE WHEN n = k AND conv_id % 2 = 0 THEN k + 1.5 ELSE n + 1 END::DOUBLE AS end_seconds FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, count(*) OVER (PARTITION BY conv_id) AS k FROM conversations)""")
def fixed_bounds(spark, sf):
    from pyspark.sql import Window as W

    w = W.partitionBy("conv_id")
    rows = _t(spark, sf, "conversations").select("conv_id", "turn", F.row_number().over(w.orderBy("turn")).alias("n"), F.count("*").over(w).alias("k"))
    rows = rows.select("conv_id", "turn", F.col("n").cast("double").alias("start_seconds"), (F.col("n") + 1.0).alias("end_seconds"), (F.col("k") + F.when(F.col("conv_id") % 2 == 0, 1.5).otherwise(1.01)).alias("d"), F.lit(30.0).alias("fps"))
    return relational.fix_bounds(rows, "conv_id", ["turn"], "d", "fps").select("conv_id", "turn", "start_seconds", "end_seconds")


@query(f"""WITH c AS (SELECT l_orderkey AS k, l_discount * 10 AS s, l_quantity AS e, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_SHIP_SQL}) AS n, count(*) OVER (PARTITION BY l_orderkey) AS m FROM lineitem WHERE l_quantity > 40)
SELECT k AS video_id, printf('shot_%03d', n) AS shot_id, CASE WHEN n = 1 THEN 0.0 ELSE round_even(s, 6) END AS start_seconds, CASE WHEN n = m AND abs(e - 45) > 0.5 / 30 THEN 45.0 ELSE e END AS end_seconds FROM c
UNION ALL SELECT o_orderkey, 'shot_001', 0.0, 45.0 FROM orders WHERE o_orderkey NOT IN (SELECT k FROM c) UNION ALL SELECT DISTINCT l_orderkey, 'shot_001', 0.0, 45.0 FROM lineitem WHERE l_orderkey NOT IN (SELECT k FROM c) AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def detected_shots(spark, sf):
    cut = F.struct((F.col("l_discount") * 10).alias("start_seconds"), F.col("l_quantity").alias("end_seconds"), F.lit(0).cast("bigint").alias("start_frame"), F.lit(0).cast("bigint").alias("end_frame"))
    cuts = _t(spark, sf, "lineitem").where("l_quantity > 40").groupBy(F.col("l_orderkey").alias("video_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct(*_SHIP, cut.alias("cut")))), lambda x: x["cut"]).alias("cuts"))
    videos = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("video_id")).union(_t(spark, sf, "lineitem").select("l_orderkey")).distinct()
    detected = videos.join(cuts, "video_id", "left").withColumn("cuts", F.coalesce("cuts", F.array().cast("array<struct<start_seconds:double,end_seconds:double,start_frame:bigint,end_frame:bigint>>")))
    facts = videos.select("video_id", F.lit(45.0).alias("duration_seconds"), F.lit(30.0).alias("fps"))
    return perception.shots(detected, facts).select("video_id", "shot_id", "start_seconds", "end_seconds")


# ---- aggregates and evaluation


@query("""SELECT user_id AS run_id, sum(CASE WHEN event_type = 'click' THEN 0 ELSE event_id % 1000 END)::BIGINT AS tokens_in, sum(event_id % 7)::BIGINT AS tokens_out, CASE WHEN bool_or(user_id % 5 = 0 AND event_type = 'view') THEN NULL ELSE round(sum((event_id % 100) / 64.0), 6) END AS cost_usd, round(sum((event_id % 50) / 8.0), 3) AS latency_seconds FROM events GROUP BY user_id""")
def usage_totals(spark, sf):
    e = F.col("event_id")
    rows = _t(spark, sf, "events").select(F.col("user_id").alias("run_id"), F.when(F.col("event_type") != "click", e % 1000).alias("tokens_in"), (e % 7).alias("tokens_out"), F.when(~((F.col("user_id") % 5 == 0) & (F.col("event_type") == "view")), (e % 100) / 64.0).alias("cost_usd"), ((e % 50) / 8.0).alias("latency_seconds"))
    return metrics.usage_totals(rows)


_SCORES = {"single": "CASE WHEN (c + k) % 6 > 0 THEN (c + k) % 5 + 1 END", "multi": "CASE WHEN (c + k) % 7 > 0 THEN (c * 7 + k * 3) % 4 + 2 END"}
_NAMES = "[" + ", ".join(f"'{c}'" for c in evaluation.RUBRIC) + "]"


@query(f"""
WITH s AS (SELECT c, k, {_NAMES}[k + 1] AS name, {_SCORES['single']} AS a, {_SCORES['multi']} AS b FROM (SELECT c_custkey AS c, unnest(range(0, 11)) AS k FROM customer)),
v AS (SELECT c, round(avg(a), 3) AS single_average, round(avg(b), 3) AS multi_average, sum(b - a)::BIGINT AS delta, string_agg(concat(name, '=', b), ',' ORDER BY k) FILTER (b < 3) AS low, max(a) FILTER (k = 7) AS ha, max(b) FILTER (k = 7) AS hb, max(a) FILTER (k = 8) AS na, max(b) FILTER (k = 8) AS nb, coalesce(max(a) FILTER (k = 10), 0) AS ra, coalesce(max(b) FILTER (k = 10), 0) AS rb FROM s GROUP BY c)
SELECT CAST(c AS VARCHAR) AS video_id, single_average, multi_average, delta, coalesce(low, '') AS low, c % 3 AS single_claims, c % 4 AS multi_claims,
 nullif(array_to_string(list_filter([CASE WHEN multi_average < 4 THEN 'overall_average_gte_4' END, CASE WHEN low IS NOT NULL THEN 'no_category_below_3' END, CASE WHEN NOT coalesce(hb >= ha, false) THEN 'hook_at_least_baseline' END, CASE WHEN NOT coalesce(nb >= na, false) THEN 'narrative_at_least_baseline' END,
  CASE WHEN NOT (rb > ra OR rb >= 4) THEN 'reconstruction_improved_or_gte4' END, CASE WHEN NOT (c % 4 < c % 3 OR (c % 3 = 0 AND c % 4 = 0)) THEN 'fewer_unsupported_claims_than_baseline' END, CASE WHEN c % 9 = 0 THEN 'cost_and_latency_recorded' END], lambda m: m IS NOT NULL), '; '), '') AS follow_up FROM v""")
def comparison_decisions(spark, sf):
    """Two evaluations of every customer's video, compared and decided on."""
    c = F.col("c_custkey")
    score = lambda rule: F.map_from_entries(F.transform(F.sequence(F.lit(0), F.lit(10)), lambda k: F.struct(F.get(F.array(*[F.lit(x) for x in evaluation.RUBRIC]), k), F.struct(rule(k).cast("int").alias("score"), F.lit("n").alias("notes"), F.lit("e").alias("evidence")))))
    claims = lambda n: F.slice(F.array(*[F.create_map(F.lit("claim"), F.lit("x"))] * 3), F.lit(1), n.cast("int"))
    none = F.array().cast(evaluation.CLAIM)

    def rows(rule, n, cost):
        cells = {"template_version": F.lit("0.1"), "categories": score(rule), "unsupported_claims": claims(n), "missed_important_facts": none, "schema_validation_success": F.lit(True), "canonical_projection_success": F.lit(True), "deterministic_fact_checks": F.create_map(F.lit("boundaries_equal"), F.lit(True)), "certain_fabricated_claims": none, "latency_seconds": F.lit(1.0), "api_usage": F.create_map().cast("map<string,bigint>"), "cost_usd": cost, "model_call_count": F.lit(2)}
        return _t(spark, sf, "customer").select(_text(c).alias("video_id"), *[v.alias(k) for k, v in cells.items()])

    single = rows(lambda k: F.when((c + k) % 6 > 0, (c + k) % 5 + 1), c % 3, F.lit(0.1))
    multi = rows(lambda k: F.when((c + k) % 7 > 0, (c * 7 + k * 3) % 4 + 2), c % 4, F.when(c % 9 != 0, 0.2))
    got = evaluation.decide(evaluation.comparison(single, multi))
    delta = F.aggregate("categories", F.lit(0).cast("bigint"), lambda a, r: a + F.coalesce(r["delta"], F.lit(0)))
    low = F.transform("low_categories", lambda r: F.concat_ws("=", r["category"], r["score"]))
    return got.select("video_id", F.col("overall_average.single_pass").alias("single_average"), F.col("overall_average.multi_step").alias("multi_average"), delta.alias("delta"), _joined(low).alias("low"), F.col("unsupported_claims.single_pass_count").cast("bigint").alias("single_claims"), F.col("unsupported_claims.multi_step_count").cast("bigint").alias("multi_claims"), "follow_up")


@query(f"""SELECT l_orderkey, l_orderkey % 2 = 0 AS duration_equal, l_orderkey % 3 > 0 AS boundaries_equal, count(*) FILTER (l_tax > 0.04) + count(*) FILTER (l_returnflag = 'R') AS claims FROM lineitem GROUP BY l_orderkey""")
def fact_checks(spark, sf):
    """What an evaluation can check mechanically: a document's duration, shots and certain claims against what was measured."""
    shots = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*_SHIP))).alias("s"))
    none = F.lit(None).cast("string")

    def shot(x, i, moved):
        text = F.struct(F.lit("t").alias("text"), (x["l_tax"] > 0.04).alias("exact"))
        sound = lambda k: [none.alias(k), none.alias(f"{k}_certainty")]
        music = [F.lit("m").alias("music"), F.when(x["l_returnflag"] == "R", "observed").otherwise("uncertain").alias("music_certainty")]
        return F.struct(F.format_string("shot_%03d", i + 1).alias("shot_id"), x["l_discount"].alias("start_seconds"), (x["l_quantity"] + moved).alias("end_seconds"), F.array(text).alias("on_screen_text"), F.array().cast("array<struct<speaker:string,text:string,exact:boolean>>").alias("spoken_dialogue"), F.struct(*music, *sound("sfx"), *sound("ambience")).alias("audio"))

    moved = F.when(F.col("l_orderkey") % 3 == 0, 1.0).otherwise(0.0)
    source = F.struct(_text(F.col("l_orderkey")).alias("video_id"), F.lit(10.0).alias("duration_seconds"), none.alias("artifact_sha256"))
    rows = shots.withColumns({
        "document": F.struct(source.alias("source"), F.struct(F.transform("s", lambda x, i: shot(x, i, moved)).alias("shots")).alias("observed")),
        "shots": F.reverse(F.transform("s", lambda x, i: F.struct(F.format_string("shot_%03d", i + 1).alias("shot_id"), x["l_discount"].alias("start_seconds"), x["l_quantity"].alias("end_seconds")))),
        "media_facts": F.struct(F.when(F.col("l_orderkey") % 2 == 0, 10.0).otherwise(9.0).alias("duration_seconds"), none.alias("sha256")),
        "usage": F.struct(F.lit(1.0).alias("total_latency_seconds"), F.create_map().cast("map<string,bigint>").alias("total_usage"), F.lit(0.1).alias("total_cost_usd"), F.lit(2).alias("model_call_count")),
    })
    got = evaluation.scaffold(rows).select("l_orderkey", "evaluation.*")
    return got.select("l_orderkey", F.col("deterministic_fact_checks")["duration_equal"].alias("duration_equal"), F.col("deterministic_fact_checks")["boundaries_equal"].alias("boundaries_equal"), F.size("certain_claim_inventory").cast("bigint").alias("claims"))


@query(f"""
WITH v AS (SELECT count(*) AS reviewed, count(*) FILTER (toxic = 1) AS t, round(avg((quality * 5 + (1 - toxic) * 5) / 2), 3) AS avg FROM labels),
e AS (SELECT count(*) FILTER (o_orderpriority = '1-URGENT') AS m, count(*) FILTER (o_orderpriority = '2-HIGH') AS d FROM orders WHERE {_STATUS_SQL} <> 'success'), n AS (SELECT count(*) AS n FROM orders)
SELECT n AS requested, reviewed, avg AS average_overall, concat('download_failure=', d, ',model_provider=', m, ',toxic=', t) AS errors FROM v, e, n""")
def report_row(spark, sf):
    from cliplake.plans import pilot

    runs = _runs(spark, sf)
    scores = F.create_map(F.lit("quality"), (F.col("quality") * 5).cast("double"), F.lit("safety"), ((1 - F.col("toxic")) * 5).cast("double"))
    reviews = _t(spark, sf, "labels").select(_text(F.col("doc_id")).alias("video_id"), scores.alias("scores"), F.when(F.col("toxic") == 1, F.array(F.lit("toxic"))).otherwise(F.array().cast("array<string>")).alias("errors"))
    got = pilot.build_report(runs, runs.count(), reviews)
    errors = F.transform(F.array_sort(F.map_entries("error_counts_by_category")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return got.select("requested", F.col("manual_review.reviewed_count").alias("reviewed"), F.col("manual_review.average_overall").alias("average_overall"), _joined(errors).alias("errors"))


# ---- ingestion and reviews


@query("""SELECT doc_id, NOT (doc_id % 3 = 0 OR strlen(coalesce(text, '')) < 4) AND doc_id % 4 <> 2 AS ok, CASE WHEN doc_id % 3 = 0 OR strlen(coalesce(text, '')) < 4 THEN 'download_failure' WHEN doc_id % 4 = 2 THEN 'artifact_mismatch' END AS error_category, doc_id % 2 = 0 AS reused FROM documents""")
def media_checks(spark, sf):
    """Texts as media, two thirds of them behind the mark of an MP4; every other one is there already, half of those with other bytes."""
    from cliplake.operators import ingest

    rows = _t(spark, sf, "documents")
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    content = F.when(F.col("doc_id") % 3 == 0, body).otherwise(F.concat(F.unhex(F.lit("0000001866747970")), body))
    rows = rows.select("doc_id", _text(F.col("doc_id")).alias("video_id"), content.alias("content"), F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error_category"), F.lit(None).cast("string").alias("error_message"))
    media = rows.where("doc_id % 2 = 0").select("video_id", F.when(F.col("doc_id") % 4 == 0, F.sha2("content", 256)).otherwise("other").alias("sha256"))
    return ingest.checked(rows, media).select("doc_id", "ok", "error_category", "reused")


@query("""SELECT doc_id, CAST(doc_id AS VARCHAR) AS video_id, CASE WHEN doc_id % 3 = 1 THEN concat('https://v.example/p/', doc_id) ELSE concat('https://v.example/', doc_id) END AS source_url, CASE WHEN doc_id % 3 < 2 THEN source END AS handle,
 CASE WHEN doc_id % 3 < 2 THEN lang ELSE '' END AS hashtags, CASE doc_id % 3 WHEN 0 THEN '2023-11-14T22:13:20+00:00' WHEN 1 THEN '2024-01-01T00:00:00+00:00' END AS published_at, n_chars::DOUBLE AS duration_seconds FROM documents""")
def source_blocks(spark, sf):
    raw = _case("doc_id", """concat('{"raw":{"id":"', doc_id, '","uploader":"@', source, '","description":"x #', lang, '","timestamp":1700000000}}')""", """concat('{"video_id":"', doc_id, '","source_url":"https://v.example/p/', doc_id, '","creator_handle":"', source, '","caption":"#', lang, ' y","published_at":"2024-01-01T00:00:00+00:00"}')""", """concat('{"id":', doc_id, ',"timestamp":"soon"}')""")
    facts = F.struct(F.col("n_chars").cast("double").alias("duration_seconds"), F.lit(None).cast("string").alias("sha256"))
    rows = _t(spark, sf, "documents").select("doc_id", merge.source_block(F.parse_json(raw), facts, "p", "https://v.example/%s").alias("b"))
    return rows.select("doc_id", "b.video_id", "b.source_url", F.col("b.creator_handle").alias("handle"), _joined(F.col("b.hashtags")).alias("hashtags"), "b.published_at", "b.duration_seconds")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS video_id, CASE WHEN c_custkey % 2 = 0 THEN 'audio=2,hook=4' ELSE '' END AS scores, c_custkey % 2 = 1 AS pending, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS claims, CASE WHEN c_custkey % 2 = 0 THEN 3.0 END AS average FROM customer""")
def manual_scores(spark, sf):
    rows = _t(spark, sf, "customer").select(_text(F.col("c_custkey")).alias("video_id"), F.col("c_custkey").alias("c"))
    none = F.array().cast(evaluation.CLAIM)
    evaluated = rows.select("video_id", F.create_map().cast(f"map<string,{evaluation.SCORE}>").alias("categories"), none.alias("unsupported_claims"), none.alias("missed_important_facts"), F.lit(True).alias("scores_pending_manual_review"))
    score = lambda n: F.struct(F.lit(n).alias("score"), F.lit("n").alias("notes"), F.lit("e").alias("evidence"))
    reviews = rows.where("c % 2 = 0").select("video_id", F.create_map(F.lit("hook"), score(4), F.lit("audio"), score(2)).alias("categories"), F.array(F.create_map(F.lit("claim"), F.lit("x"))).alias("unsupported_claims"), F.lit(None).cast(evaluation.CLAIM).alias("missed_important_facts"))
    got = evaluation.record_manual_scores(evaluated, reviews)
    scored = evaluation.scores(F.col("categories"))
    said = F.transform(F.array_sort(F.map_entries(scored)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return got.select("video_id", _joined(said).alias("scores"), F.col("scores_pending_manual_review").alias("pending"), evaluation.listed(F.col("unsupported_claims")).cast("bigint").alias("claims"), evaluation.average(scored).alias("average"))
