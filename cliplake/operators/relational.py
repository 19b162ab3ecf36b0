"""Joins, set operations and ordered-state operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cliplake.functions import arrays as A


def shots_with_frames(shots: DataFrame, frames: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Left join; of several frames of a shot the last by `order` wins, which must tell any two apart."""
    fields = [c for c in frames.columns if c not in keys]
    last = frames.groupBy(*keys).agg(F.max_by(F.struct(*fields), F.struct(order)).alias("_frame"))
    return shots.join(last, keys, "left").select(*shots.columns, *[F.col(f"_frame.{c}").alias(c) for c in fields if c not in shots.columns])


def required_join(left: DataFrame, right: DataFrame, keys: list[str], what: str = "row") -> DataFrame:
    """Inner join that fails the run if a left row has no match."""
    hit = right.withColumn("_hit", F.lit(True))
    out = left.join(hit, keys, "left")
    return out.withColumn("_hit", F.when(F.col("_hit").isNull(), F.raise_error(F.lit(f"no {what} for a key")).cast("boolean")).otherwise(F.col("_hit"))).where("_hit").drop("_hit")


def missing(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    return expected.select(*keys).distinct().join(actual.select(*keys), keys, "left_anti")


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of more than one row, with their number."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def refuse_duplicates(rows: DataFrame, key: str, named: int = 20) -> DataFrame:
    """rows; an error that names the first duplicate keys, and how many more there are, if there are any."""
    bad = duplicates(rows, [key]).select(key)
    first = [r[0] for r in bad.orderBy(key).limit(named + 1).collect()]
    if first:
        more = f" and {bad.count() - named} more" if len(first) > named else ""
        raise ValueError(f"duplicates of {key}: {', '.join(map(str, first[:named]))}{more}")
    return rows


def maps_equal(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row: equal, rows, different."""
    a = left.select(*keys, F.struct(*values).alias("_l"), F.lit(True).alias("_in_l"))
    b = right.select(*keys, F.struct(*values).alias("_r"), F.lit(True).alias("_in_r"))
    same = F.coalesce(F.col("_l").eqNullSafe(F.col("_r")) & F.col("_in_l") & F.col("_in_r"), F.lit(False))
    got = a.join(b, keys, "full_outer").agg(F.count("*").alias("rows"), F.count_if(~same).alias("different"))
    return got.select((F.col("different") == 0).alias("equal"), "rows", "different")


def rubric_delta(spine: DataFrame, base: DataFrame, multi: DataFrame, key: str, score: str) -> DataFrame:
    """Every category of the spine, both scores, and their difference where both are there."""
    b = base.select(key, F.col(score).alias("base_score"))
    m = multi.select(key, F.col(score).alias("multi_score"))
    return spine.join(b, key, "left").join(m, key, "left").withColumn("delta", F.col("multi_score") - F.col("base_score"))


def mismatched_hashes(existing: DataFrame, new: DataFrame, key: str, digest: str) -> DataFrame:
    n = new.select(key, F.col(digest).alias("new_hash"))
    return existing.select(key, F.col(digest).alias("old_hash")).join(n, key).where("old_hash <> new_hash")


def boundary_evaluation(rows: DataFrame, by: str, detected: str, annotated: str, tolerance: float) -> DataFrame:
    """Per group: true and false positives, missed, precision, recall, f1, median absolute error. `detected` and `annotated` are array columns."""
    pairs = A.greedy_matches(F.col(detected), F.col(annotated), tolerance)
    got = rows.select(by, F.size(detected).alias("n_d"), F.size(annotated).alias("n_a"), pairs.alias("pairs"))
    tp = F.size("pairs")
    errors = F.array_sort(F.transform("pairs", lambda p: F.abs(p["d"] - p["a"])))
    middle = lambda k: F.get(errors, F.floor((F.size(errors) - 1 + k) / 2).cast("int"))
    got = got.select(by, tp.alias("true_positives"), (F.col("n_d") - tp).alias("false_positives"), (F.col("n_a") - tp).alias("missed"), F.try_divide(tp, F.col("n_d")).alias("precision"), F.try_divide(tp, F.col("n_a")).alias("recall"), ((middle(0) + middle(1)) / 2).alias("median_error"))
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return got.withColumn("f1", f1)


def overlap_violations(rows: DataFrame, by: str, order: list, start: str, end: str) -> DataFrame:
    """Rows with prev_end, the greatest end before (0.0 at first), and bad: starts before it or does not end after it starts."""
    w = W.partitionBy(by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    prev = F.coalesce(F.max(end).over(w), F.lit(0.0))
    out = rows.withColumn("prev_end", F.greatest(prev, F.lit(0.0)))
    return out.withColumn("bad", (F.col(start) < F.col("prev_end")) | (F.col(end) <= F.col(start)))


def sequential_ids(rows: DataFrame, by: str, order: list, prefix: str = "shot") -> DataFrame:
    return rows.withColumn("shot_id", F.format_string(prefix + "_%03d", F.row_number().over(W.partitionBy(by).orderBy(*order))))


def whole_shots(videos: DataFrame, shots: DataFrame, by: str, duration: str, fps: str) -> DataFrame:
    """shots, and for each video without any one that spans all of it: `by`, shot_id, start_seconds, end_seconds, start_frame, end_frame."""
    none = videos.join(shots.select(by), by, "left_anti")
    length = F.coalesce(F.round(duration, 6), F.lit(0.0))
    frames = F.coalesce(F.bround(F.col(duration) * F.coalesce(fps, F.lit(30.0))).cast("bigint"), F.lit(0))
    one = none.select(by, F.lit("shot_001").alias("shot_id"), F.lit(0.0).alias("start_seconds"), length.alias("end_seconds"), F.lit(0).cast("bigint").alias("start_frame"), frames.alias("end_frame"))
    return shots.select(*one.columns).unionByName(one)


def fix_bounds(shots: DataFrame, by: str, order: list, duration: str, fps: str) -> DataFrame:
    """The first shot starts at 0; the last ends at the duration if it is off by more than half a frame."""
    w = W.partitionBy(by).orderBy(*order)
    first, last = F.row_number().over(w) == 1, F.lead(F.lit(1)).over(w).isNull()
    far = F.abs(F.col("end_seconds") - F.col(duration)) > 0.5 / F.col(fps)
    return shots.withColumns({"_first": first, "_last": last}).withColumns({"start_seconds": F.when(F.col("_first"), 0.0).otherwise(F.col("start_seconds")), "end_seconds": F.when(F.col("_last") & far, F.col(duration)).otherwise(F.col("end_seconds"))}).drop("_first", "_last")


def cut_points(shots: DataFrame, by: str, order: list) -> DataFrame:
    """Starts of all shots but the first, above 0, rounded."""
    n = F.row_number().over(W.partitionBy(by).orderBy(*order))
    return shots.withColumn("_n", n).where((F.col("_n") > 1) & (F.col("start_seconds") > 0)).select(by, F.bround("start_seconds", 6).alias("cut"))


def latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key by `order`, which must tell any two rows of a key apart: an aggregate, combined before the shuffle, not a sort of each key's rows."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), F.struct(*order)).alias("_r")).select(key, "_r.*")


def batches(rows: DataFrame, by: str, order: list, size: int) -> DataFrame:
    return rows.withColumn("batch", F.floor((F.row_number().over(W.partitionBy(by).orderBy(*order)) - 1) / size))


def until_failure(rows: DataFrame, by: str, order: str, ok: str) -> DataFrame:
    """Rows up to and with the first that is not ok."""
    first = F.min(F.when(~F.col(ok), F.col(order))).over(W.partitionBy(by))
    return rows.withColumn("_stop", first).where(F.col("_stop").isNull() | (F.col(order) <= F.col("_stop"))).drop("_stop")


def gaps(rows: DataFrame, by: str, order: str, tie: str | None = None) -> DataFrame:
    """Adds gap_seconds since the row before, for throttling checks. tie: a column that orders rows of one time."""
    seconds = lambda c: F.unix_timestamp(c.cast("timestamp"))
    w = W.partitionBy(by).orderBy(order, *([tie] if tie else []))
    return rows.withColumn("gap_seconds", seconds(F.col(order)) - seconds(F.lag(order).over(w)))


def first_success(attempts: DataFrame, key: str, priority: str, ok: Column) -> DataFrame:
    """The successful attempt of least priority of each key, with the number of attempts and all of them in order."""
    tried = F.array_sort(F.collect_list(F.struct(priority, ok.alias("ok"))))
    best = F.min_by(F.struct(*[c for c in attempts.columns if c != key]), F.when(ok, F.col(priority)))
    return attempts.groupBy(key).agg(best.alias("best"), tried.alias("attempts"), F.count_if(ok).alias("successes"))


def pending(entries: DataFrame, done: DataFrame, key: str, reprocess: bool = False) -> DataFrame:
    """Entries without a successful record; all if reprocess is set."""
    if reprocess:
        return entries
    return entries.join(done.where("status = 'success'").select(key), key, "left_anti")


def unrecorded(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Failed rows whose url is not in the index."""
    left = rows.where(~F.coalesce(F.col("status").isin("success", "rejected_by_cohort"), F.lit(False)))
    return left.join(index.select(F.col("source_url").alias("_u")), F.col("url") == F.col("_u"), "left_anti")


def latest_snapshot(features: DataFrame, snapshots: DataFrame, key: str, at: str, until: Column | None = None) -> DataFrame:
    """features with the last snapshot of each video (at most `until`): both sides shuffle by the key once, the snapshots as one row per video."""
    seen = snapshots if until is None else snapshots.where(F.col(at) <= until)
    return features.join(latest(seen, key, [at]), key, "left")
