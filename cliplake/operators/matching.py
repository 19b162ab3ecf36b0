"""One-to-one matches of detections and annotations within a tolerance, as rows: for groups of any size."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliplake.operators import metrics, series

#: Tolerances in a stretch of the axis.
STRETCH = 1024


def matches(detected: DataFrame, annotated: DataFrame, by: str, at: str, tolerance: float) -> DataFrame:
    """by, detected, annotated: detections in ascending order each take the nearest free annotation within the tolerance, the earlier of two equally near.

    Points further apart than the tolerance don't touch: groups are cut there, and
    each run is scanned in order with the annotations that are still free within
    the tolerance as its state. Rows without a time are left out."""
    kind = dict(detected.dtypes)[by]
    points = detected.select(F.col(by).alias("by"), F.col(at).cast("double").alias("at"), F.lit(1).alias("kind"))
    points = points.unionByName(annotated.select(F.col(by).alias("by"), F.col(at).cast("double").alias("at"), F.lit(0).alias("kind")))
    cut = series.runs(points, "by", "at", tolerance, STRETCH * tolerance or 1.0)

    def step():
        free: list[float] = []
        waiting: deque[tuple] = deque()

        def settle(upto: float | None) -> list[tuple]:
            """Decide detections of which all annotations in reach have been seen."""
            out = []
            while waiting and (upto is None or upto - waiting[0][1] > tolerance):
                key, d = waiting.popleft()
                at = bisect_left(free, d)
                near = [(abs(d - free[i]), i) for i in (at - 1, at) if 0 <= i < len(free) and abs(d - free[i]) <= tolerance]
                if near:
                    error, i = min(near)
                    while i and free[i - 1] == free[i]:
                        i -= 1
                    out.append((key, d, free.pop(i)))
                # later detections don't reach back further
                gone = 0
                while gone < len(free) and d - free[gone] > tolerance:
                    gone += 1
                del free[:gone]
            return out

        def take(row) -> list[tuple]:
            key, t, kind, _ = row
            out = settle(t)
            if kind:
                waiting.append((key, t))
            else:
                insort(free, t)
            return out

        return take, lambda: settle(None)

    got = series.scan(cut, ["by", "run"], ["at", "kind"], step, f"by {kind}, detected double, annotated double")
    return got.withColumnRenamed("by", by)


def evaluation(detected: DataFrame, annotated: DataFrame, by: str, at: str, tolerance: float) -> DataFrame:
    """What relational.boundary_evaluation() gives, of rows instead of arrays: a row for each group that either side has."""
    counts = detected.select(by, F.lit(1).alias("d"), F.when(F.col(at).isNotNull(), 1).otherwise(0).alias("n_d"), F.lit(0).alias("n_a"))
    counts = counts.unionByName(annotated.select(by, F.lit(0).alias("d"), F.lit(0).alias("n_d"), F.when(F.col(at).isNotNull(), 1).otherwise(0).alias("n_a")))
    counts = counts.groupBy(by).agg(F.sum("n_d").alias("n_d"), F.sum("n_a").alias("n_a"))
    pairs = matches(detected, annotated, by, at, tolerance).withColumn("error", F.abs(F.col("detected") - F.col("annotated")))
    found = pairs.groupBy(F.col(by).alias("_by")).agg(F.count("*").alias("tp"))
    middle = metrics.at_ranks(pairs.withColumn("_key", F.struct(by)), "_key", "error", {"low": lambda n: F.floor((n - 1) / 2), "high": lambda n: F.floor(n / 2)})
    middle = middle.select(F.col(f"_key.{by}").alias("_of"), ((F.col("low") + F.col("high")) / 2).alias("median_error"))
    rows = counts.join(found, F.col(by).eqNullSafe(F.col("_by")), "left").join(middle, F.col(by).eqNullSafe(F.col("_of")), "left")
    tp = F.coalesce("tp", F.lit(0)).cast("int")
    rows = rows.select(by, tp.alias("true_positives"), (F.col("n_d") - tp).cast("int").alias("false_positives"), (F.col("n_a") - tp).cast("int").alias("missed"), F.try_divide(tp, F.col("n_d")).alias("precision"), F.try_divide(tp, F.col("n_a")).alias("recall"), "median_error")
    return rows.withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
