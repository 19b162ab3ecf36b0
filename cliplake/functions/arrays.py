"""Array and aggregate column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def presence(certainties: Column) -> Column:
    """True if any is observed; false if all are absent (an empty list too); else null."""
    known = F.filter(certainties, lambda x: x.isNotNull())
    return F.when(F.array_contains(known, "observed"), True).when(F.forall(known, lambda x: x == "absent"), False)


def ordered_distinct(values: Column, skip: str = "unknown") -> Column:
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != skip)))


def sorted_labels(values: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(values, lambda x: x.isNotNull())))


def nearest_rank(value: Column, pct: float) -> Column:
    """Aggregate: the element at round-half-even(pct/100 * (n - 1)) of the sorted values; 0.0 if there are none.

    It holds a group's values in one row: for groups bounded by a batch of
    videos. nearest_rank_rows() of operators.metrics has no such bound."""
    values = F.array_sort(F.collect_list(value))
    return F.coalesce(F.get(values, F.bround((F.size(values) - 1) * (pct / 100)).cast("int")), F.lit(0.0))


def greedy_matches(detected: Column, annotated: Column, tolerance: float) -> Column:
    """Pairs (d, a): detections in ascending order each take the nearest free annotation within the tolerance, the earlier of two equally near."""
    free = F.transform(F.array_sort(annotated), lambda a, i: F.struct(i.alias("i"), a.alias("a")))
    start = F.struct(free.alias("free"), F.array().cast("array<struct<d:double,a:double>>").alias("pairs"))

    def step(acc: Column, d: Column) -> Column:
        near = F.filter(acc["free"], lambda f: F.abs(d - f["a"]) <= tolerance)
        best = F.array_min(F.transform(near, lambda f: F.struct(F.abs(d - f["a"]).alias("e"), f["i"].alias("i"), f["a"].alias("a"))))
        took = F.struct(F.filter(acc["free"], lambda f: f["i"] != best["i"]).alias("free"), F.array_append(acc["pairs"], F.struct(d.alias("d"), best["a"].alias("a"))).alias("pairs"))
        return F.when(best.isNull(), acc).otherwise(took)

    return F.aggregate(F.array_sort(detected), start, step)["pairs"]


def all_unique(values: Column) -> Column:
    """Whether no two items have the same JSON."""
    return F.size(F.array_distinct(F.transform(values, lambda x: F.to_json(F.struct(x))))) == F.size(values)


def subset(required: Column, keys: Column) -> Column:
    return F.size(F.array_except(required, keys)) == 0


def null_strict_sum(value: Column, digits: int = 6) -> Column:
    """Aggregate: the sum, or null if any value is null."""
    return F.when(F.count("*") == F.count(value), F.round(F.sum(value), digits))


def share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))
