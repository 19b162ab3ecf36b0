"""Run metrics, manual reviews and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cliplake.functions import arrays as A

# Fixed values of the gates.
MIN_SUCCESS = 20
MIN_SUCCESS_RATE = 0.85
MIN_REVIEW = 4.0
MIN_REVIEWS = 5
REVIEW_SHARE = 0.2
MIN_REPORTS = 2
CATEGORIES = ("hook", "narrative", "reconstruction_quality")


def run_metrics(rows: DataFrame, requested: int | Column) -> DataFrame:
    """One row over status, total_latency_seconds, total_usage_cost_usd, schema_valid, failure_category."""
    good, rejected = F.col("status") == "success", F.col("status") == "rejected_by_cohort"
    cost = F.when(good, F.coalesce("total_usage_cost_usd", F.lit(0.0)))
    n = F.count_if(good)
    requested = F.lit(requested) if isinstance(requested, int) else requested
    total = rows.agg(
        requested.cast("bigint").alias("requested"),
        F.count_if(rejected).alias("cohort_rejections"),
        F.count_if(~rejected & (F.col("status") != "ingestion_failed")).alias("ingested"),
        n.alias("fully_processed"),
        A.share(n, F.count_if(~rejected)).alias("success_rate"),
        A.share(F.count_if(good & F.coalesce("schema_valid", F.lit(False))), n).alias("schema_validation_rate"),
        F.coalesce(F.avg(cost), F.lit(0.0)).alias("mean_cost_usd"),
        F.coalesce(F.sum(cost), F.lit(0.0)).alias("total_cost_usd"),
        F.count_if(F.col("failure_category") == "model_provider").alias("model_provider_failures"),
        F.count_if(F.col("status") == "ingestion_failed").alias("collection_failures"),
    )
    done = rows.where("status = 'success'").select(F.lit(1).alias("_k"), F.coalesce("total_latency_seconds", F.lit(0.0)).alias("_latency"), F.coalesce("total_usage_cost_usd", F.lit(0.0)).alias("_cost"))
    latency = at_ranks(done, "_k", "_latency", {"p50_latency_seconds": nearest(50), "p95_latency_seconds": nearest(95)})
    middle = at_ranks(done, "_k", "_cost", {"_lower": lambda n: F.floor((n - 1) / 2), "_upper": lambda n: F.floor(n / 2)})
    middle = middle.select("_k", ((F.col("_lower") + F.col("_upper")) / 2).alias("median_cost_usd"))
    out = total.withColumn("_k", F.lit(1)).join(latency, "_k", "left").join(middle, "_k", "left")
    filled = ("p50_latency_seconds", "p95_latency_seconds", "median_cost_usd")
    return out.select(*[c for c in total.columns], *[F.coalesce(c, F.lit(0.0)).alias(c) for c in filled])


def nearest(pct: float):
    """The nearest rank (from 0) of a percentile among n values, halves to even."""
    return lambda n: F.bround((n - 1) * (pct / 100)).cast("bigint")


#: Parts of the range of a group's values in which the first pass counts.
_PARTS = 1024


def at_ranks(rows: DataFrame, by: str, value: str, ranks: dict) -> DataFrame:
    """by, and for each name the value at ranks[name](n), from 0, of the n sorted values of a group that are not null.

    Groups may be of any size: values are counted by equal parts of the group's
    range, then only the part that holds a rank is looked into. Each pass moves
    counts, never the values, and a task sorts at most _PARTS counts of a group or
    the distinct values of one part."""
    known = rows.where(F.col(value).isNotNull()).select(by, F.col(value).cast("double").alias("_v"))
    bounds = known.groupBy(by).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("*").alias("_n"))
    share = (F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low"))
    part = F.when(F.col("_high") > F.col("_low"), F.least(F.lit(_PARTS - 1), F.floor(share * _PARTS))).otherwise(0).cast("int")
    parted = known.join(bounds, by).withColumn("_part", part)
    upto = F.sum("_c").over(W.partitionBy(by).orderBy("_part").rowsBetween(W.unboundedPreceding, 0))
    hist = parted.groupBy(by, "_part").agg(F.count("*").alias("_c"), F.first("_n").alias("_n")).withColumn("_upto", upto)
    wanted = F.array(*[F.struct(F.lit(k).alias("name"), f(F.col("_n")).cast("bigint").alias("rank")) for k, f in ranks.items()])
    hist = hist.withColumn("_w", F.filter(wanted, lambda w: (w["rank"] < F.col("_upto")) & (w["rank"] >= F.col("_upto") - F.col("_c")))).where(F.size("_w") > 0)
    picks = hist.select(by, "_part", (F.col("_upto") - F.col("_c")).alias("_before"), "_w")
    inside = parted.join(picks, [by, "_part"]).groupBy(by, "_part", "_v").agg(F.count("*").alias("_c"), F.first("_before").alias("_before"), F.first("_w").alias("_w"))
    upto = F.col("_before") + F.sum("_c").over(W.partitionBy(by, "_part").orderBy("_v").rowsBetween(W.unboundedPreceding, 0))
    found = inside.withColumn("_upto", upto).select(by, "_v", "_c", "_upto", F.explode("_w").alias("_w"))
    found = found.where((F.col("_w.rank") < F.col("_upto")) & (F.col("_w.rank") >= F.col("_upto") - F.col("_c")))
    return found.groupBy(by).agg(*[F.max(F.when(F.col("_w.name") == k, F.col("_v"))).alias(k) for k in ranks])


def nearest_rank_rows(rows: DataFrame, by: str, value: str, pct: float) -> DataFrame:
    """by and value: the nearest-rank percentile of groups of any size."""
    return at_ranks(rows, by, value, {"value": nearest(pct)})


def error_counts(rows: DataFrame) -> DataFrame:
    return rows.where("status <> 'success' AND failure_category IS NOT NULL").groupBy(F.col("failure_category").alias("category")).agg(F.count("*").alias("n"))


def review_error_counts(reviews: DataFrame) -> DataFrame:
    return reviews.select(F.explode("errors").alias("category")).groupBy("category").agg(F.count("*").alias("n"))


def merge_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("category").agg(F.sum("n").alias("n"))


def review_summary(reviews: DataFrame) -> DataFrame:
    """reviewed_count and average_overall: the mean of the means of each review's scores, rounded to 3."""
    scores = F.map_values("scores")
    mean = F.try_divide(F.aggregate(scores, F.lit(0.0), lambda a, x: a + x), F.size(scores))
    return reviews.agg(F.count("*").alias("reviewed_count"), F.round(F.avg(mean), 3).alias("average_overall"))


def manual_review(reviews: DataFrame) -> DataFrame:
    """One row with manual_review: reviewed_count, average_overall, video_ids, errors_by_category and per_review, for the report of a batch, whose reviews are few."""
    counts = review_error_counts(reviews).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("errors_by_category"))
    each = reviews.agg(F.array_sort(F.collect_list(F.struct("video_id", F.array_sort(F.map_entries("scores")).alias("scores"), "errors"))).alias("r"))
    rows = review_summary(reviews).withColumn("_k", F.lit(1)).join(counts.withColumn("_k", F.lit(1)), "_k").join(each.withColumn("_k", F.lit(1)), "_k")
    per = F.transform("r", lambda r: F.struct(r["video_id"].alias("video_id"), F.map_from_entries(r["scores"]).alias("scores"), r["errors"].alias("errors")))
    return rows.select(F.struct("reviewed_count", "average_overall", F.transform("r", lambda r: r["video_id"]).alias("video_ids"), "errors_by_category", per.alias("per_review")).alias("manual_review"))


def required_reviews(successes: Column) -> Column:
    return F.greatest(F.lit(MIN_REVIEWS), F.ceil(successes * REVIEW_SHARE))


def gate(metrics: DataFrame, review: DataFrame, review_errors: DataFrame) -> DataFrame:
    """blockers (array) and decision, from one row each of run_metrics() and review_summary() and the review error counts."""
    bad = review_errors.agg(F.array_sort(F.collect_list(F.struct("category", "n"))).alias("errors"))
    rows = metrics.withColumn("_k", F.lit(1)).join(review.withColumn("_k", F.lit(1)), "_k").join(bad.withColumn("_k", F.lit(1)), "_k")
    n, reviewed = F.col("fully_processed"), F.col("reviewed_count")
    percent = lambda x, d: F.format_string(f"%.{d}f%%", x * 100)
    severe = F.filter("errors", lambda e: (e["n"] >= MIN_REPORTS) & (e["n"] * 2 > reviewed))
    said = F.transform(severe, lambda e: F.concat(F.lit("systematic severe errors in category '"), e["category"], F.lit("' ("), e["n"].cast("string"), F.lit("/"), reviewed.cast("string"), F.lit(" reviews report it, > half)")))
    checks = F.array(
        F.when(n < MIN_SUCCESS, F.concat(F.lit("only "), n.cast("string"), F.lit(f" fully-processed videos (< {MIN_SUCCESS})"))),
        F.when(F.col("success_rate") < MIN_SUCCESS_RATE, F.concat(F.lit("success rate "), percent(F.col("success_rate"), 2), F.lit(f" < {MIN_SUCCESS_RATE:.0%}"))),
        F.when(F.col("schema_validation_rate") < 1.0, F.lit("CreativeIR/CanonicalIR validation below 100% among success records")),
        F.when(F.coalesce(F.col("average_overall") < MIN_REVIEW, F.lit(True)), F.concat(F.lit("manual review average "), F.coalesce(F.col("average_overall").cast("string"), F.lit("None")), F.lit(f" < {MIN_REVIEW}"))),
        F.when(reviewed < required_reviews(n), F.concat(F.lit("manual review coverage "), reviewed.cast("string"), F.lit(" < required "), required_reviews(n).cast("string"), F.lit(" (max(5, ceil(20% of successes)))"))),
    )
    rows = rows.withColumn("blockers", F.concat(F.filter(checks, lambda m: m.isNotNull()), said))
    return rows.select("blockers", F.when(F.size("blockers") == 0, "ready-for-modeling-dataset").otherwise("decompiler-needs-more-work").alias("decision"))


def decision_gates(comparison: DataFrame) -> DataFrame:
    """gates (array of gate, passed), decision and follow_up per run.

    Needs: schema_valid, projection_ok, facts (map of booleans), fabricated
    (count), multi_average, multi and base (maps of category to score),
    multi_unsupported, base_unsupported, latency_seconds, cost_usd."""
    m, b = F.col("multi"), F.col("base")
    at = lambda x, k: F.try_element_at(x, F.lit(k))
    not_worse = lambda k: F.coalesce(at(m, k) >= at(b, k), F.lit(False))
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    few = (F.col("multi_unsupported") < F.col("base_unsupported")) | ((F.col("base_unsupported") == 0) & (F.col("multi_unsupported") == 0))
    last = CATEGORIES[2]
    checks = {
        "creative_ir_schema_validation": F.coalesce("schema_valid", F.lit(False)),
        "canonical_ir_projection": F.coalesce("projection_ok", F.lit(True)),
        "deterministic_facts_exact": F.coalesce(F.forall(F.map_values("facts"), lambda x: F.coalesce(x, F.lit(False))), F.lit(True)),
        "no_certain_fabricated_quotes_or_audio": F.coalesce("fabricated", F.lit(0)) == 0,
        "overall_average_gte_4": F.coalesce(F.col("multi_average") >= 4.0, F.lit(False)),
        "no_category_below_3": ~F.exists(F.map_values(m), lambda x: F.coalesce(x < 3, F.lit(False))),
        "hook_at_least_baseline": not_worse(CATEGORIES[0]),
        "narrative_at_least_baseline": not_worse(CATEGORIES[1]),
        "reconstruction_improved_or_gte4": (zero(at(m, last)) > zero(at(b, last))) | (zero(at(m, last)) >= 4),
        "fewer_unsupported_claims_than_baseline": few,
        "cost_and_latency_recorded": F.col("latency_seconds").isNotNull() & F.col("cost_usd").isNotNull(),
    }
    gates = F.array(*[F.struct(F.lit(k).alias("gate"), v.alias("passed")) for k, v in checks.items()])
    out = comparison.withColumn("gates", gates)
    failed = F.transform(F.filter("gates", lambda g: ~g["passed"]), lambda g: g["gate"])
    return out.withColumn("decision", F.when(F.size(failed) == 0, "validated-for-pilot").otherwise("needs-one-video-fix")).withColumn("follow_up", F.when(F.size(failed) > 0, F.array_join(failed, "; ")))


def manifest_rollup(stages: DataFrame, key: str = "video_id") -> DataFrame:
    """Per video: summed cost and latency and sorted maps stage -> value without nulls. A video has a handful of stages."""
    pairs = lambda c: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("stage", c)))))
    return stages.groupBy(key).agg(
        F.round(F.sum(F.coalesce("usage_cost_usd", F.lit(0.0))), 6).alias("total_usage_cost_usd"),
        F.round(F.sum(F.coalesce("latency_seconds", F.lit(0.0))), 6).alias("total_latency_seconds"),
        pairs("usage_cost_usd").alias("stage_costs"),
        pairs("latency_seconds").alias("stage_latencies"),
        pairs("model_id").alias("model_ids"),
        pairs("prompt_version").alias("prompt_versions"),
        pairs("schema_version").alias("schema_versions"),
    )


def usage_totals(passes: DataFrame, key: str = "run_id") -> DataFrame:
    """Tokens with null as 0; the cost is null if any pass has none."""
    return passes.groupBy(key).agg(F.sum(F.coalesce("tokens_in", F.lit(0))).alias("tokens_in"), F.sum(F.coalesce("tokens_out", F.lit(0))).alias("tokens_out"), A.null_strict_sum(F.col("cost_usd")).alias("cost_usd"), F.round(F.sum("latency_seconds"), 3).alias("latency_seconds"))


def low_categories(scores: DataFrame, least: float = 3.0) -> DataFrame:
    """(category, score) below `least`, in spine order, as one array."""
    rows = F.collect_list(F.when(F.col("score") < least, F.struct("position", "category", "score")))
    return scores.agg(F.transform(F.array_sort(rows), lambda r: F.struct(r["category"].alias("category"), r["score"].alias("score"))).alias("low"))
