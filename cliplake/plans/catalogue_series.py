"""More registered queries: matches and cuts of groups of any size, near-duplicate media, write-once outcomes, with their SQL."""

from __future__ import annotations

import uuid
from itertools import combinations

from pyspark.sql import functions as F

from cliplake.operators import matching, neighbours, scenes
from cliplake.operators.perception import Detector
from cliplake.plans.catalogue import _SQL, _epoch, _t, query
from cliplake.sources.commits import Table

NEAR = 0.9


@query(_SQL["boundary_eval"])
def boundary_eval_rows(spark, sf):
    """boundary_eval without an array a video."""
    rows = _t(spark, sf, "events").select("user_id", "event_type", (_epoch("ts") % 1000).cast("double").alias("at"))
    none = F.when(F.lit(False), F.lit(0.0))  # a user without either event has a row as well
    pick = lambda k: rows.select("user_id", F.when(F.col("event_type") == k, F.col("at")).otherwise(none).alias("at"))
    return matching.evaluation(pick("click"), pick("view"), "user_id", "at", 20.0)


@query("""
WITH RECURSIVE f AS (SELECT user_id AS video_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame, (event_id % 180)::DOUBLE AS hue, (event_id * 7 % 256)::DOUBLE AS saturation, value AS luma FROM events),
s AS (SELECT video_id, frame, (abs(hue - lag(hue) OVER w) + abs(saturation - lag(saturation) OVER w) + abs(luma - lag(luma) OVER w)) / 3.0 AS score FROM f WINDOW w AS (PARTITION BY video_id ORDER BY frame)),
c AS (SELECT video_id, frame FROM s WHERE score >= 60 AND frame >= 4),
r AS (SELECT video_id, min(frame) AS frame FROM c GROUP BY video_id UNION ALL SELECT r.video_id, (SELECT min(c.frame) FROM c WHERE c.video_id = r.video_id AND c.frame >= r.frame + 4) FROM r WHERE r.frame IS NOT NULL)
SELECT video_id, frame FROM r WHERE frame IS NOT NULL""")
def content_cuts(spark, sf):
    """Events as frames."""
    from pyspark.sql import Window as W

    frame = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    rows = _t(spark, sf, "events").select(F.col("user_id").alias("video_id"), frame.alias("frame"), (F.col("event_id") % 180).cast("double").alias("hue"), (F.col("event_id") * 7 % 256).cast("double").alias("saturation"), F.col("value").alias("luma"))
    return scenes.cuts(rows, Detector(threshold=60.0, min_scene_length=4))


@query(f"""
WITH m AS (SELECT 2 * vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings UNION ALL SELECT 2 * vec_id + 1, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(x * 8 + 0.5) / 8) FROM embeddings)
SELECT a.id AS a, b.id AS b, round(list_cosine_similarity(a.v, b.v), 6) AS cosine FROM m a JOIN m b ON a.id < b.id WHERE list_cosine_similarity(a.v, b.v) >= {NEAR}""")
def near_duplicate_media(spark, sf):
    """Every medium and a copy that was encoded again, coarsely: all pairs, those of copies that became equal, too."""
    rows = _t(spark, sf, "embeddings")
    v, kind = F.col("embedding").cast("array<double>"), "array<float>" if dict(rows.dtypes)["embedding"] == "array<float>" else "array<double>"  # floats and their eighths are exact as floats
    again = rows.select((2 * F.col("vec_id") + 1).alias("id"), F.transform(v, lambda x: F.floor(x * 8 + 0.5) / F.lit(8.0)).cast(kind).alias("v"))
    both = rows.select((2 * F.col("vec_id")).alias("id"), F.col("embedding").cast(kind).alias("v")).unionByName(again)
    return neighbours.all_pairs(both, "id", "v", NEAR).withColumn("cosine", F.round("cosine", 6))


@query("""
SELECT CASE WHEN grouping(user_id % 3) = 0 THEN CAST(user_id % 3 AS VARCHAR) END AS cohort_id, CASE WHEN grouping(event_type) = 0 THEN event_type END AS model_id, CASE WHEN grouping(strftime(ts, '%Y-%m-%d')) = 0 THEN strftime(ts, '%Y-%m-%d') END AS day,
 concat_ws(',', CASE WHEN grouping(user_id % 3) = 0 THEN 'cohort_id' END, CASE WHEN grouping(event_type) = 0 THEN 'model_id' END, CASE WHEN grouping(strftime(ts, '%Y-%m-%d')) = 0 THEN 'day' END) AS level,
 count(*) AS n, count(*) FILTER (event_id % 4 <> 0) AS successes, count(*) FILTER (event_id % 4 <> 0 AND event_id % 8 <> 1) AS valid, round(sum(value) / count(value), 6) AS latency_mean, true AS median_near
FROM events GROUP BY CUBE (user_id % 3, event_type, strftime(ts, '%Y-%m-%d'))""")
def metric_cube(spark, sf):
    """Events as records: states by cohort, model and day, written once, merged to all levels. median_near: the merged median's rank is within 3 % of the middle, counted over the records."""
    from cliplake.operators import states

    records = _t(spark, sf, "events").select(
        (F.col("user_id") % 3).cast("string").alias("cohort_id"), F.col("event_type").alias("model_id"), F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.when(F.col("event_id") % 4 == 0, "failed").otherwise("success").alias("status"), (F.col("event_id") % 8 != 1).alias("schema_valid"), F.col("value").alias("total_latency_seconds"), F.lit(None).cast("double").alias("total_usage_cost_usd"),
    )
    path = f"{_scratch(spark)}/states-{uuid.uuid4().hex}"
    states.store(states.partial(records), path)
    got = states.metrics(states.merged(spark.read.parquet(path)))
    levels = got.select(*states.DIMENSIONS, "level", "latency_p50")
    every = [",".join(c) for k in range(4) for c in combinations(states.DIMENSIONS, k)]
    met = records.select(*states.DIMENSIONS, F.col("total_latency_seconds").alias("v"), F.explode(F.array(*[F.lit(x) for x in every])).alias("l"))
    keys = [F.when(F.array_contains(F.split("l", ","), d), F.col(d)).alias(f"_{d}") for d in states.DIMENSIONS]
    met = met.select("l", "v", *keys).join(levels, (F.col("l") == F.col("level")) & F.col("_cohort_id").eqNullSafe(F.col("cohort_id")) & F.col("_model_id").eqNullSafe(F.col("model_id")) & F.col("_day").eqNullSafe(F.col("day")))
    near = met.groupBy("level", *states.DIMENSIONS).agg((F.avg(F.when(F.col("v") < F.col("latency_p50"), 1.0).otherwise(0.0)) <= 0.53).alias("a"), (F.avg(F.when(F.col("v") <= F.col("latency_p50"), 1.0).otherwise(0.0)) >= 0.47).alias("b"))
    near = near.select(F.col("level").alias("_l"), *[F.col(d).alias(f"_{d}") for d in states.DIMENSIONS], (F.col("a") & F.col("b")).alias("median_near"))
    out = got.join(near, (F.col("level") == F.col("_l")) & F.col("cohort_id").eqNullSafe(F.col("_cohort_id")) & F.col("model_id").eqNullSafe(F.col("_model_id")) & F.col("day").eqNullSafe(F.col("_day")))
    return out.select(*states.DIMENSIONS, "level", "n", "successes", "valid", F.round("latency_mean", 6).alias("latency_mean"), "median_near")


@query("""
WITH d AS (SELECT doc_id, doc_id % 97 AS k, sha256(coalesce(text, '')) AS sha256 FROM documents),
one AS (SELECT k, min(sha256) AS kept FROM d WHERE doc_id % 2 = 0 GROUP BY k),
two AS (SELECT d.k, arg_min(sha256, doc_id) AS kept FROM d ANTI JOIN one USING (k) GROUP BY d.k),
held AS (SELECT *, 1 AS w FROM one UNION ALL SELECT *, 2 FROM two)
SELECT DISTINCT CAST(d.k AS VARCHAR) AS video_id, sha256, CASE WHEN sha256 <> kept THEN 'artifact_mismatch' WHEN w = 2 THEN 'new' ELSE 'reused' END AS outcome FROM d JOIN held ON d.k = held.k""")
def write_once_outcomes(spark, sf):
    """Texts as media of 97 videos: half of them are written, then all."""
    rows = _t(spark, sf, "documents").select((F.col("doc_id") % 97).cast("string").alias("video_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"), "doc_id")
    media = Table(spark, f"{_scratch(spark)}/media-{uuid.uuid4().hex}", "video_id string, sha256 string")
    media.add_once(rows.where("doc_id % 2 = 0"), "video_id", "sha256")
    return media.add_once(rows, "video_id", "sha256", F.col("doc_id"))


def _scratch(spark) -> str:
    """The shared folder of the cluster; a folder of its own for a local session without one."""
    import tempfile

    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"file://{tempfile.mkdtemp(prefix='cliplake-')}"
