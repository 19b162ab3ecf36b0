"""The registered queries of the video analytics operators over the supplied tables, with the SQL that gives the same rows.

Stand-ins: an order is a video, its line items are shots; a conversation's turns
are shots with captions; documents are captions and source entries; events are
observations and stage results; labels are reviews."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.functions import arrays as A
from cliplake.functions import scalars as S
from cliplake.operators import cohort, metrics, normalize, relational, validate

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _joined(a):
    return F.array_join(a, ",")


def _epoch(c):
    """Whole seconds of a timestamp without time zone, taken as UTC."""
    return F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', {c})")


def _sql_any(words) -> str:
    return "(" + " OR ".join(f"contains(lower(text), '{w}')" for w in words) + ")"


_SUBJECT_SQL = "CASE " + " ".join(f"WHEN {_sql_any(w)} THEN '{n}'" for n, w in S.SUBJECT_RULES) + " END"
_ROLE_SQL = f"CASE WHEN {_sql_any(S.PROMOTIONAL)} THEN 'promotional' ELSE 'instructional' END"
_SHIP = ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
_SHIP_SQL = ", ".join(_SHIP)


# ---- scalars


@query(f"SELECT doc_id, {_SUBJECT_SQL} AS category FROM documents")
def subject_category(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", S.subject_category(F.col("text")).alias("category"))


@query(f"SELECT conv_id, turn, CASE WHEN text IS NOT NULL THEN {_ROLE_SQL} END AS text_role FROM conversations")
def text_role(spark, sf):
    return _t(spark, sf, "conversations").select("conv_id", "turn", S.text_role(F.col("text")).alias("text_role"))


@query("SELECT doc_id, array_to_string(list_transform(list_filter(string_split_regex(trim(text), '[ \\t\\n\\v\\f\\r]+'), lambda x: starts_with(x, '#')), lambda x: ltrim(x, '#')), ',') AS tags FROM documents")
def caption_hashtags(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", _joined(S.caption_hashtags(F.col("text"))).alias("tags"))


_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1))"


@query(f"SELECT page_id, {_HOST} AS host, nullif(regexp_extract(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/+$', ''), '([^/]*)$', 1), '') AS segment, coalesce({_HOST} IN ('www.ththly.example.org', 'blog.tiontion.example.com') , false) AS allowed FROM pages")
def url_last_segment(spark, sf):
    u = F.col("url")
    return _t(spark, sf, "pages").select("page_id", S.url_host(u).alias("host"), S.last_segment(u).alias("segment"), S.allowed_url(u, ("www.ththly.example.org", "blog.tiontion.example.com")).alias("allowed"))


@query("SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5 FROM documents")
def content_hash(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.md5("text").alias("md5"))


@query("SELECT event_id, CAST(coalesce(json_extract_string(props, '$.missing'), json_extract_string(props, '$.k')) AS BIGINT) AS k FROM events")
def payload_coalesce(spark, sf):
    rows = _t(spark, sf, "events").select("event_id", F.try_parse_json("props").alias("payload"))
    return rows.select("event_id", normalize.as_int(normalize.first(F.col("payload"), "missing", "k")).alias("k"))


@query("SELECT e.event_id, strftime(to_timestamp(floor(epoch(e.ts))::BIGINT) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S') || '+00:00' AS seen_iso, (epoch_us(e.ts) - epoch_us(o.o_orderdate)) / 1e6 AS age FROM events e JOIN orders o ON e.event_id = o.o_orderkey")
def epoch_iso_age(spark, sf):
    e = _t(spark, sf, "events").select("event_id", "ts", _epoch("ts").alias("seen"))
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return e.join(o, F.col("event_id") == F.col("o_orderkey")).select("event_id", S.epoch_iso(F.col("seen")).alias("seen_iso"), S.age_seconds(F.col("ts"), F.col("o_orderdate")).alias("age"))


@query("SELECT p_partkey, concat(p_size // gcd(p_size, g), ':', g // gcd(p_size, g)) AS ratio, round(p_size::DOUBLE / g, 6) AS value FROM (SELECT p_partkey, p_size, (p_partkey % 48 + 1)::INT AS g FROM part)")
def rational_ratio(spark, sf):
    rows = _t(spark, sf, "part").select("p_partkey", "p_size", (F.col("p_partkey") % 48 + 1).cast("int").alias("g"))
    text = F.concat_ws("/", "p_size", "g")
    return rows.select("p_partkey", S.aspect_ratio(F.col("p_size"), F.col("g")).alias("ratio"), F.round(S.rational(text)["value"], 6).alias("value"))


@query(f"SELECT {_SHIP_SQL}, l_orderkey, round(l_quantity * 1000 / 1e6 * 1.5 + floor(l_extendedprice) / 1e6 * 8.0, 6) AS cost FROM lineitem")
def unit_cost(spark, sf):
    cost = S.usage_cost(F.col("l_quantity") * 1000, F.floor("l_extendedprice"), F.lit(1.5), F.lit(8.0))
    return _t(spark, sf, "lineitem").select(*_SHIP, "l_orderkey", cost.alias("cost"))


@query(f"SELECT {_SHIP_SQL}, l_orderkey, round_even((l_discount + l_tax) / 2, 6) AS mid, greatest(l_linenumber, least(l_linenumber + 24, CAST(round_even(l_quantity * 0.5, 0) AS BIGINT))) AS frame FROM lineitem")
def midpoint_clamp(spark, sf):
    mid = S.midpoint(F.col("l_discount"), F.col("l_tax"))
    start = F.col("l_linenumber").cast("bigint")
    return _t(spark, sf, "lineitem").select(*_SHIP, "l_orderkey", mid.alias("mid"), S.frame_index(F.col("l_quantity"), F.lit(0.5), start, start + 25).alias("frame"))


@query("SELECT conv_id, turn, regexp_matches(text, '(?i)\\b(the|is)\\b[^\\n]*\\b(of|to)\\b') AS hint FROM conversations")
def pattern_flag(spark, sf):
    return _t(spark, sf, "conversations").select("conv_id", "turn", F.col("text").rlike(r"(?i)\b(the|is)\b[^\n]*\b(of|to)\b").alias("hint"))


@query(f"SELECT conv_id, turn, coalesce(regexp_matches(text, '(?i)\\b(cta|call[s]? to action|comment[- ]?bait|engagement prompt|ask[s]?(ing)? viewers|comment your|drop a comment|follow for|link in bio)\\b'), false) AS cta FROM (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN text || ' Link in bio!' ELSE text END AS text FROM conversations)")
def cta_flag(spark, sf):
    rows = _t(spark, sf, "conversations").withColumn("text", F.when(F.col("turn") % 3 == 0, F.concat("text", F.lit(" Link in bio!"))).otherwise(F.col("text")))
    return rows.select("conv_id", "turn", S.mentions_cta(F.col("text")).alias("cta"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def fenced_json(spark, sf):
    rows = _t(spark, sf, "events").select("event_id", F.concat(F.lit("```json\n"), "props", F.lit("\n```")).alias("raw"))
    return rows.select("event_id", F.try_variant_get(S.parse_object_lenient(F.col("raw")), "$.k", "bigint").alias("k"))


# ---- arrays and aggregates


@query("SELECT user_id, CASE WHEN bool_or(event_type = 'click') THEN true WHEN bool_and(event_type = 'view') THEN false END AS present FROM events GROUP BY user_id")
def presence_tristate(spark, sf):
    certainty = F.when(F.col("event_type") == "click", "observed").when(F.col("event_type") == "view", "absent").otherwise("unknown")
    rows = _t(spark, sf, "events").groupBy("user_id").agg(F.collect_set(certainty).alias("certainties"))
    return rows.select("user_id", A.presence(F.col("certainties")).alias("present"))


@query(f"SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY p) AS flags FROM (SELECT l_orderkey, l_returnflag, min(p) AS p FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_SHIP_SQL}) AS p FROM lineitem) GROUP BY ALL) GROUP BY l_orderkey")
def ordered_distinct(spark, sf):
    rows = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*_SHIP))).alias("shots"))
    return rows.select("l_orderkey", _joined(A.ordered_distinct(F.transform("shots", lambda s: s["l_returnflag"]))).alias("flags"))


@query("SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS labels FROM events GROUP BY user_id")
def sorted_labels(spark, sf):
    rows = _t(spark, sf, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("l"))
    return rows.select("user_id", _joined(A.sorted_labels(F.col("l"))).alias("labels"))


@query("SELECT l_orderkey, count(*) AS shot_count, min(l_quantity) AS shortest, max(l_quantity) AS longest, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY l_orderkey")
def shot_stats(spark, sf):
    q = F.col("l_quantity")
    return _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("shot_count"), F.min(q).alias("shortest"), F.max(q).alias("longest"), F.round(F.avg(q), 6).alias("mean"))


_RANK_SQL = "SELECT l_returnflag, list_sort(list(l_extendedprice))[1 + CAST(round_even(0.95 * (count(*) - 1), 0) AS BIGINT)] AS p95 FROM lineitem GROUP BY l_returnflag"


@query(_RANK_SQL)
def nearest_rank_pct(spark, sf):
    got = metrics.nearest_rank_rows(_t(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", 95)
    return got.withColumnRenamed("value", "p95")


@query("SELECT l_orderkey, list_sort(list(l_quantity))[1 + CAST(round_even(0.5 * (count(*) - 1), 0) AS BIGINT)] AS p50 FROM lineitem GROUP BY l_orderkey")
def nearest_rank_small_groups(spark, sf):
    return _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(A.nearest_rank(F.col("l_quantity"), 50).alias("p50"))


_STATUS_SQL = "CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'ingestion_failed' ELSE 'rejected_by_cohort' END"


def _runs(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "ingestion_failed").otherwise("rejected_by_cohort")
    return _t(spark, sf, "orders").select(F.col("o_orderkey").alias("video_id"), status.alias("status"), (F.col("o_totalprice") / 1000).alias("total_latency_seconds"), (F.col("o_totalprice") / 1e6).alias("total_usage_cost_usd"), F.lit(True).alias("schema_valid"), F.when(F.col("o_orderpriority") == "1-URGENT", "model_provider").when(F.col("o_orderpriority") == "2-HIGH", "download_failure").alias("failure_category"))


@query(f"""
WITH r AS (SELECT {_STATUS_SQL} AS status, o_totalprice / 1000 AS lat, o_totalprice / 1e6 AS cost, o_orderpriority AS p FROM orders), s AS (SELECT * FROM r WHERE status = 'success')
SELECT (SELECT count(*) FROM r) AS requested, count(*) FILTER (status = 'rejected_by_cohort') AS cohort_rejections, count(*) FILTER (status = 'success') AS ingested, count(*) FILTER (status = 'success') AS fully_processed,
 round(count(*) FILTER (status = 'success') / count(*) FILTER (status <> 'rejected_by_cohort'), 6) AS success_rate, 1.0::DOUBLE AS schema_validation_rate,
 round((SELECT list_sort(list(lat))[1 + CAST(round_even(0.5 * (count(*) - 1), 0) AS BIGINT)] FROM s), 6) AS p50_latency_seconds, round((SELECT list_sort(list(lat))[1 + CAST(round_even(0.95 * (count(*) - 1), 0) AS BIGINT)] FROM s), 6) AS p95_latency_seconds,
 round((SELECT avg(cost) FROM s), 6) AS mean_cost_usd, round((SELECT median(cost) FROM s), 6) AS median_cost_usd, round((SELECT sum(cost) FROM s), 4) AS total_cost_usd,
 count(*) FILTER (p = '1-URGENT') AS model_provider_failures, count(*) FILTER (status = 'ingestion_failed') AS collection_failures FROM r""")
def pilot_metrics(spark, sf):
    got = metrics.run_metrics(_runs(spark, sf), F.count("*"))
    digits = {"total_cost_usd": 4}
    return got.select(*[F.round(c, digits.get(c, 6)).alias(c) if t == "double" else F.col(c) for c, t in got.dtypes])


@query(f"SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'model_provider' ELSE 'download_failure' END AS category, count(*) AS n FROM orders WHERE {_STATUS_SQL} <> 'success' AND o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY ALL")
def error_counts(spark, sf):
    return metrics.error_counts(_runs(spark, sf))


@query("SELECT category, sum(n)::BIGINT AS n FROM (SELECT 'quality' AS category, count(*) AS n FROM labels WHERE quality = 0 UNION ALL SELECT 'toxic', count(*) FROM labels WHERE toxic = 1 UNION ALL SELECT event_type, count(*) FROM events GROUP BY ALL) GROUP BY category")
def merged_error_counts(spark, sf):
    errors = F.filter(F.array(F.when(F.col("quality") == 0, F.lit("quality")), F.when(F.col("toxic") == 1, F.lit("toxic"))), lambda x: x.isNotNull())
    reviews = _t(spark, sf, "labels").select(errors.alias("errors"))
    events = _t(spark, sf, "events").groupBy(F.col("event_type").alias("category")).agg(F.count("*").alias("n"))
    return metrics.merge_counts(metrics.review_error_counts(reviews), events)


@query("SELECT count(*) AS reviewed_count, round(avg((quality * 5 + (1 - toxic) * 5) / 2), 3) AS average_overall FROM labels")
def review_macro_mean(spark, sf):
    rows = _t(spark, sf, "labels")
    scores = F.create_map(F.lit("quality"), (F.col("quality") * 5).cast("double"), F.lit("safety"), ((1 - F.col("toxic")) * 5).cast("double"))
    return metrics.review_summary(rows.select(scores.alias("scores")))


@query("SELECT user_id, round(sum(value), 4) AS cost, string_agg(concat(event_type, '=', n), ',' ORDER BY event_type) AS stages FROM (SELECT user_id, event_type, sum(value) AS value, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id")
def manifest_rollup(spark, sf):
    stages = _t(spark, sf, "events").groupBy("user_id", F.col("event_type").alias("stage")).agg(F.sum("value").alias("usage_cost_usd"), F.count("*").cast("double").alias("latency_seconds"))
    stages = stages.withColumns({"model_id": F.lit(None).cast("string"), "prompt_version": F.lit(None).cast("string"), "schema_version": F.lit("0.1")})
    got = metrics.manifest_rollup(stages, "user_id")
    entries = F.transform(F.map_entries("stage_latencies"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("bigint").cast("string")))
    return got.select("user_id", F.round("total_usage_cost_usd", 4).alias("cost"), _joined(entries).alias("stages"))


@query("SELECT d.source, CASE WHEN count(*) = count(l.quality) THEN sum(l.quality)::DOUBLE END AS strict_total, sum(coalesce(l.quality, 0))::BIGINT AS lenient_total FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.source")
def null_strict_total(spark, sf):
    rows = _t(spark, sf, "documents").select("doc_id", "source").join(_t(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return rows.groupBy("source").agg(A.null_strict_sum(F.col("quality").cast("double")).alias("strict_total"), F.sum(F.coalesce("quality", F.lit(0))).alias("lenient_total"))


@query(f"""
WITH m AS (SELECT count(*) FILTER ({_STATUS_SQL} = 'success') AS n, count(*) FILTER ({_STATUS_SQL} <> 'rejected_by_cohort') AS a FROM orders),
v AS (SELECT count(*) AS r, round(avg((quality * 5 + (1 - toxic) * 5) / 2), 3) AS avg, count(*) FILTER (toxic = 1) AS t FROM labels)
SELECT array_to_string(list_filter([CASE WHEN n < 20 THEN concat('only ', n, ' fully-processed videos (< 20)') END, CASE WHEN n / a < 0.85 THEN printf('success rate %.2f%% < 85%%', n / a * 100) END, CASE WHEN avg < 4.0 THEN concat('manual review average ', avg, ' < 4.0') END,
 CASE WHEN r < greatest(5, ceil(0.2 * n)) THEN concat('manual review coverage ', r, ' < required ', CAST(greatest(5, ceil(0.2 * n)) AS BIGINT), ' (max(5, ceil(20% of successes)))') END, CASE WHEN t >= 2 AND 2 * t > r THEN 'systematic' END], lambda x: x IS NOT NULL), '; ') AS blockers,
 CASE WHEN n < 20 OR n / a < 0.85 OR avg < 4.0 OR r < greatest(5, ceil(0.2 * n)) OR (t >= 2 AND 2 * t > r) THEN 'decompiler-needs-more-work' ELSE 'ready-for-modeling-dataset' END AS decision FROM m, v""")
def gate_decision(spark, sf):
    labels = _t(spark, sf, "labels")
    scores = F.create_map(F.lit("quality"), (F.col("quality") * 5).cast("double"), F.lit("safety"), ((1 - F.col("toxic")) * 5).cast("double"))
    errors = F.when(F.col("toxic") == 1, F.array(F.lit("toxic"))).otherwise(F.array().cast("array<string>"))
    reviews = labels.select(scores.alias("scores"), errors.alias("errors"))
    runs = _runs(spark, sf).withColumn("total_latency_seconds", F.lit(None).cast("double"))
    got = metrics.gate(metrics.run_metrics(runs, F.count("*")), metrics.review_summary(reviews), metrics.review_error_counts(reviews))
    return got.select(F.array_join("blockers", "; ").alias("blockers"), "decision")


@query("""
WITH u AS (SELECT user_id, avg(value) AS a, avg(value) FILTER (event_type = 'click') AS h, avg(value) FILTER (event_type = 'view') AS n FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN a / 20 >= 4 AND NOT (coalesce(h / 20 < 3, false) OR coalesce(n / 20 < 3, false)) AND coalesce(h / 20 >= 2, false) AND coalesce(n / 20 >= 2, false) THEN 'validated-for-pilot' ELSE 'needs-one-video-fix' END AS decision FROM u""")
def decision_gates(spark, sf):
    of = lambda k: F.avg(F.when(F.col("event_type") == k, F.col("value"))) / 20
    rows = _t(spark, sf, "events").groupBy("user_id").agg((F.avg("value") / 20).alias("multi_average"), of("click").alias("h"), of("view").alias("n"))
    rows = rows.withColumns({"multi": F.create_map(F.lit("hook"), F.col("h"), F.lit("narrative"), F.col("n"), F.lit("reconstruction_quality"), F.lit(4.5)), "base": F.create_map(F.lit("hook"), F.lit(2.0), F.lit("narrative"), F.lit(2.0)), "schema_valid": F.lit(True), "projection_ok": F.lit(True), "facts": F.create_map(F.lit("shots"), F.lit(True)), "fabricated": F.lit(0), "multi_unsupported": F.lit(0), "base_unsupported": F.lit(0), "latency_seconds": F.lit(1.0), "cost_usd": F.lit(0.1)})
    return metrics.decision_gates(rows).select("user_id", "decision")


# ---- joins, windows, sets


@query("SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0")
def left_join_frames(spark, sf):
    frames = _t(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return relational.shots_with_frames(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), frames, ["o_custkey"], "c_name").select("o_orderkey", "c_name")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def coverage_missing(spark, sf):
    return relational.missing(_t(spark, sf, "documents"), _t(spark, sf, "labels"), ["doc_id"])


@query("SELECT l.doc_id FROM labels l ANTI JOIN documents d ON l.doc_id = d.doc_id AND d.lang = 'en'")
def coverage_extra(spark, sf):
    return relational.missing(_t(spark, sf, "labels"), _t(spark, sf, "documents").where("lang = 'en'"), ["doc_id"])


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def required_match(spark, sf):
    right = _t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return relational.required_join(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), right, ["o_custkey"], "customer").select("o_orderkey", "c_name")


@query("SELECT bool_and(x) AS equal, count(*) AS rows, count(*) FILTER (NOT x) AS different FROM (SELECT min(l_quantity) = min(l_quantity) AND count(*) < 7 AS x FROM lineitem GROUP BY l_orderkey)")
def map_equality(spark, sf):
    rows = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min("l_quantity").alias("start"), F.count("*").alias("n"))
    return relational.maps_equal(rows, rows.withColumn("n", F.least("n", F.lit(6))), ["l_orderkey"], ["start", "n"])


@query("SELECT event_type AS category, round(avg(value) FILTER (user_id % 2 = 0), 3) AS base_score, round(avg(value) FILTER (user_id % 2 = 1), 3) AS multi_score, round(round(avg(value) FILTER (user_id % 2 = 1), 3) - round(avg(value) FILTER (user_id % 2 = 0), 3), 3) AS delta FROM events GROUP BY event_type")
def rubric_delta(spark, sf):
    events = _t(spark, sf, "events").withColumn("category", F.col("event_type"))
    side = lambda k: events.where(F.col("user_id") % 2 == k).groupBy("category").agg(F.round(F.avg("value"), 3).alias("score"))
    got = relational.rubric_delta(events.select("category").distinct(), side(0), side(1), "category", "score")
    return got.withColumn("delta", F.round("delta", 3))


@query("""
WITH RECURSIVE g AS (SELECT user_id, coalesce(list_sort(list(s) FILTER (event_type = 'click')), []) AS d, coalesce(list_sort(list(s) FILTER (event_type = 'view')), []) AS a FROM (SELECT user_id, event_type, (CAST(floor(epoch(ts)) AS BIGINT) % 1000)::DOUBLE AS s FROM events) GROUP BY user_id),
st AS (SELECT user_id, 1 AS i, a AS free, []::DOUBLE[] AS errors FROM g
 UNION ALL SELECT user_id, i + 1, CASE WHEN b IS NULL THEN free ELSE list_concat(free[1:b - 1], free[b + 1:len(free)]) END, CASE WHEN b IS NULL THEN errors ELSE list_append(errors, abs(d[i] - free[b])) END
 FROM (SELECT st.user_id, st.i, st.free, st.errors, g.d, list_sort(list_transform(list_filter(range(1, len(st.free) + 1), lambda j: abs(g.d[st.i] - st.free[j]) <= 20), lambda j: {'e': abs(g.d[st.i] - st.free[j]), 'j': j}))[1].j AS b FROM st JOIN g ON st.user_id = g.user_id WHERE st.i <= len(g.d))),
f AS (SELECT g.user_id, len(d) AS nd, len(a) AS na, len(errors) AS tp, list_sort(errors) AS e FROM st JOIN g ON st.user_id = g.user_id AND st.i = len(g.d) + 1),
p AS (SELECT *, tp / nullif(nd, 0) AS p, tp / nullif(na, 0) AS r FROM f)
SELECT user_id, tp AS true_positives, nd - tp AS false_positives, na - tp AS missed, p AS precision, r AS recall, CASE WHEN tp > 0 THEN (e[(tp + 1) // 2] + e[tp // 2 + 1]) / 2 END AS median_error, 2 * p * r / nullif(p + r, 0) AS f1 FROM p""")
def boundary_eval(spark, sf):
    second = (_epoch("ts") % 1000).cast("double")
    pick = lambda k: F.collect_list(F.when(F.col("event_type") == k, second))
    rows = _t(spark, sf, "events").groupBy("user_id").agg(pick("click").alias("detected"), pick("view").alias("annotated"))
    return relational.boundary_evaluation(rows, "user_id", "detected", "annotated", 20.0)


@query(f"""
SELECT l_orderkey, count(*) FILTER (l_discount * 100 < greatest(p, 0.0) OR l_quantity <= l_discount * 100) AS bad FROM (SELECT *, coalesce(max(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY {_SHIP_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS p FROM lineitem) GROUP BY l_orderkey""")
def overlap_violations(spark, sf):
    rows = _t(spark, sf, "lineitem").withColumn("start", F.col("l_discount") * 100)
    got = relational.overlap_violations(rows, "l_orderkey", list(_SHIP), "start", "l_quantity")
    return got.groupBy("l_orderkey").agg(F.count_if("bad").alias("bad"))


@query("SELECT conv_id, turn, printf('shot_%03d', row_number() OVER (PARTITION BY conv_id ORDER BY turn)) AS shot_id FROM conversations")
def sequential_ids(spark, sf):
    return relational.sequential_ids(_t(spark, sf, "conversations"), "conv_id", ["turn"]).select("conv_id", "turn", "shot_id")


@query("SELECT conv_id, turn * 1.5 AS cut FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) WHERE n > 1 AND turn > 0")
def cut_points(spark, sf):
    rows = _t(spark, sf, "conversations").select("conv_id", "turn", (F.col("turn") * F.lit(1.5).cast("double")).alias("start_seconds"))
    return relational.cut_points(rows, "conv_id", ["turn"])


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_record(spark, sf):
    return relational.latest(_t(spark, sf, "events"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 3 AS batch FROM conversations")
def batches(spark, sf):
    return relational.batches(_t(spark, sf, "conversations"), "conv_id", ["turn"], 3).select("conv_id", "turn", "batch")


@query("SELECT event_id FROM (SELECT *, min(event_id) FILTER (event_type = 'purchase') OVER (PARTITION BY user_id) AS stop FROM events) WHERE stop IS NULL OR event_id <= stop")
def first_failure(spark, sf):
    rows = _t(spark, sf, "events").withColumn("ok", F.col("event_type") != "purchase")
    return relational.until_failure(rows, "user_id", "event_id", "ok").select("event_id")


@query("SELECT user_id, min(event_id) FILTER (value > 50) AS event_id, count(*) AS tried, count(*) FILTER (value > 50) AS successes FROM events GROUP BY user_id")
def first_success(spark, sf):
    got = relational.first_success(_t(spark, sf, "events").select("user_id", "event_id", "value"), "user_id", "event_id", F.col("value") > 50)
    return got.select("user_id", F.col("best.event_id").alias("event_id"), F.size("attempts").cast("bigint").alias("tried"), "successes")


@query("SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS BIGINT) AS gap_seconds FROM events")
def throttle_gaps(spark, sf):
    return relational.gaps(_t(spark, sf, "events").select("event_id", "user_id", "ts"), "user_id", "ts", "event_id").select("event_id", "gap_seconds")


@query(f"SELECT o_orderkey AS video_id FROM orders WHERE {_STATUS_SQL} = 'ingestion_failed' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) UNION ALL SELECT o_orderkey FROM orders WHERE {_STATUS_SQL} = 'success'")
def unrecorded_union(spark, sf):
    rows = _runs(spark, sf).join(_t(spark, sf, "orders").select(F.col("o_orderkey").alias("video_id"), F.col("o_custkey").cast("string").alias("url")), "video_id")
    index = _t(spark, sf, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").cast("string").alias("source_url"))
    return rows.where("status = 'success'").unionByName(relational.unrecorded(rows, index), allowMissingColumns=True).select("video_id")


@query("SELECT conv_id, string_agg(k, ',' ORDER BY turn) AS claims FROM (SELECT conv_id, turn, concat(CASE role WHEN 'user' THEN 'spoken_dialogue' ELSE 'on_screen_text' END, ':', turn) AS k FROM conversations WHERE length(text) > 100) GROUP BY conv_id")
def claim_inventory(spark, sf):
    from cliplake.operators import project

    exact = F.length("text") > 100
    quote = F.struct(F.lit(None).cast("string").alias("speaker"), F.col("turn").cast("string").alias("text"), exact.alias("exact"))
    text = F.struct(F.col("turn").cast("string").alias("text"), exact.alias("exact"))
    none = F.lit(None).cast("string")
    audio = F.struct(*[none.alias(k) for k in ("music", "music_certainty", "sfx", "sfx_certainty", "ambience", "ambience_certainty")])
    user = F.col("role") == "user"
    shot = F.struct("turn", F.when(user, F.array().cast("array<struct<text:string,exact:boolean>>")).otherwise(F.array(text)).alias("on_screen_text"), F.when(user, F.array(quote)).otherwise(F.array().cast("array<struct<speaker:string,text:string,exact:boolean>>")).alias("spoken_dialogue"), audio.alias("audio"))
    rows = _t(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(shot), lambda a, b: (a["turn"] - b["turn"]).cast("int")).alias("shots"))
    rows = rows.select("conv_id", project.claims(F.col("shots")).alias("c")).where(F.size("c") > 0)
    return rows.select("conv_id", _joined(F.transform("c", lambda x: F.concat_ws(":", x["kind"], x["text"]))).alias("claims"))


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels WHERE quality = 1")
def set_difference(spark, sf):
    return _t(spark, sf, "documents").select("doc_id").exceptAll(_t(spark, sf, "labels").where("quality = 1").select("doc_id").distinct())


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def resume_pending(spark, sf):
    done = _t(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 1, "success").otherwise("validation_failed").alias("status"))
    return relational.pending(_t(spark, sf, "documents").select("doc_id"), done, "doc_id")


_POLICY = cohort.Policy("pilot", "1", required_hashtags=("en", "fr"), handles=tuple(f"src{i}" for i in range(12)), min_views=300, max_views=20_000)
_REASON_SQL = "CASE WHEN lang NOT IN ('en', 'fr') THEN 'missing_required_hashtag' WHEN source IS NOT NULL AND NOT regexp_matches(source, '^src([0-9]|1[01])$') THEN 'creator_not_allowed' WHEN coalesce(n_chars < 300, true) THEN 'below_min_views' WHEN n_chars > 20000 THEN 'above_max_views' ELSE 'eligible' END"


def _entries(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.array("lang").alias("hashtags"), F.col("source").alias("creator_handle"), F.col("n_chars").alias("views"))


@query(f"SELECT doc_id, {_REASON_SQL} AS reason, {_REASON_SQL} = 'eligible' AS accepted FROM documents")
def cohort_decisions(spark, sf):
    return cohort.decide(_entries(spark, sf), _POLICY).select("doc_id", "reason", "accepted")


@query(f"SELECT {_REASON_SQL} AS reason, count(*) AS n FROM documents GROUP BY ALL")
def cohort_reason_counts(spark, sf):
    return cohort.decide(_entries(spark, sf), _POLICY).groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT doc_id, ntile(3) OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS stratum FROM documents")
def cohort_strata(spark, sf):
    return cohort.strata(_t(spark, sf, "documents"), ["n_chars", "doc_id"], 3, "source").select("doc_id", F.col("stratum").cast("bigint").alias("stratum"))


@query("SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 3")
def creator_cap(spark, sf):
    return cohort.cap_per_creator(_t(spark, sf, "documents"), "source", [F.desc("n_chars"), "doc_id"], 3).select("doc_id")


@query("SELECT sha256(text) AS sha256, count(*) AS n FROM documents GROUP BY ALL HAVING count(*) > 1")
def duplicate_guard(spark, sf):
    return relational.duplicates(_t(spark, sf, "documents").select(F.sha2("text", 256).alias("sha256")), ["sha256"])


@query("SELECT a.doc_id, b.doc_id AS other FROM documents a JOIN documents b ON a.doc_id = b.doc_id + 1 WHERE sha256(a.text) <> sha256(b.text) AND a.lang <> b.lang")
def hash_mismatch(spark, sf):
    docs = _t(spark, sf, "documents")
    old = docs.select(F.col("doc_id").alias("k"), F.sha2("text", 256).alias("d"), "lang")
    new = docs.select((F.col("doc_id") + 1).alias("k"), F.sha2("text", 256).alias("d"), F.col("lang").alias("new_lang"))
    bad = relational.mismatched_hashes(old, new, "k", "d")
    return bad.join(old.select("k", "lang"), "k").join(new.select("k", "new_lang"), "k").where("lang <> new_lang").select(F.col("k").alias("doc_id"), (F.col("k") - 1).alias("other"))


_SCHEMA = {"type": "object", "required": ["k", "name"], "additionalProperties": False, "properties": {"k": {"type": "integer", "minimum": 20, "maximum": 80}, "name": {"type": ["string", "null"]}}}


@query("SELECT event_id, concat_ws('; ', CASE WHEN k > 80 THEN '$.k: more than 80' WHEN k < 20 THEN '$.k: less than 20' END, '$: lacks name') AS errors, CASE WHEN k > 80 THEN '$.k: more than 80' WHEN k < 20 THEN '$.k: less than 20' ELSE '$: lacks name' END AS first FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)")
def validation_errors(spark, sf):
    rows = _t(spark, sf, "events").select("event_id", F.try_parse_json("props").alias("v"))
    rows = rows.select("event_id", validate.errors(F.col("v"), _SCHEMA).alias("e"))
    return rows.select("event_id", F.array_join("e", "; ").alias("errors"), validate.first_error(F.col("e")).alias("first"))


@query("SELECT doc_id, concat_ws(',', CASE WHEN quality IS NULL THEN 'quality' END, CASE WHEN toxic IS NULL THEN 'toxic' END) AS missing FROM documents LEFT JOIN labels USING (doc_id)")
def missing_fields(spark, sf):
    rows = _t(spark, sf, "documents").select("doc_id").join(_t(spark, sf, "labels"), "doc_id", "left")
    return rows.select("doc_id", _joined(validate.missing_fields({"quality": F.col("quality"), "toxic": F.col("toxic")})).alias("missing"))


@query("SELECT user_id AS video_id, CAST(user_id AS VARCHAR) AS creator_id, 'success' AS status, count(*) AS views, concat('{', string_agg(concat('\"', event_type, '\":', n), ',' ORDER BY event_type), '}') AS schema_versions FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id")
def index_projection(spark, sf):
    from cliplake.sources import writers

    rows = _t(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    rows = rows.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("schema_versions"), F.count("*").alias("views"))
    got = writers.index_rows(rows.select(F.col("user_id").cast("string").alias("video_id"), F.col("user_id").cast("string").alias("creator_id"), F.lit("success").alias("status"), "views", "schema_versions"))
    return got.select(F.col("video_id").cast("bigint").alias("video_id"), "creator_id", "status", "views", "schema_versions")


@query("SELECT o.o_orderkey, arg_max(e.value, (e.ts, e.event_id)) AS value FROM orders o LEFT JOIN events e ON e.user_id = o.o_custkey GROUP BY o.o_orderkey")
def latest_snapshot(spark, sf):
    snaps = _t(spark, sf, "events").select(F.col("user_id").alias("o_custkey"), F.struct("ts", "event_id").alias("at"), "value")
    return relational.latest_snapshot(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), snaps, "o_custkey", "at").select("o_orderkey", "value")


from cliplake.plans import catalogue_documents as _more  # noqa: E402,F401  registers its queries
from cliplake.plans import catalogue_series as _series  # noqa: E402,F401  registers its queries
