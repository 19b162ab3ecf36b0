"""Run metrics as states that merge: kept per cohort, model and day, added up to any coarser level without the records.

Counts and sums add exactly. Latencies and costs are KLL sketches, which merge too;
a percentile read from one has a rank error of about 1.3 % for K = 200, whatever the
number of records, and is exact below K of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch: the rank error falls as its inverse.
K = 200
DIMENSIONS = ("cohort_id", "model_id", "day")
MEASURES = {"latency": "total_latency_seconds", "cost": "total_usage_cost_usd"}


def partial(records: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, measures: dict[str, str] = MEASURES, k: int = K) -> DataFrame:
    """A state for each group of records (status, schema_valid and the measures): one pass, combined before the shuffle.

    Null measures count as unknown: they are in n, not in the sums and sketches."""
    success = F.col("status") == "success"
    parts = [F.count("*").alias("n"), F.count_if(success).alias("successes"), F.count_if(success & F.col("schema_valid")).alias("valid")]
    for name, column in measures.items():
        v = F.col(column).cast("double")
        parts += [F.count(v).alias(f"{name}_n"), F.sum(v).alias(f"{name}_sum"), F.kll_sketch_agg_double(v, k).alias(f"{name}_sketch")]
    return records.groupBy(*dimensions).agg(*parts)


def merged(states: DataFrame, sets: list[tuple[str, ...]] | None = None, dimensions: tuple[str, ...] = DIMENSIONS, measures: dict[str, str] = MEASURES, k: int = K) -> DataFrame:
    """States at every level of `sets` (by default all combinations of the dimensions), in one shuffle; level: which dimensions a row is of, joined by commas.

    A dimension that a level leaves out is null."""
    parts: list[Column] = [F.sum(c).alias(c) for c in ("n", "successes", "valid")]
    for name in measures:
        parts += [F.sum(f"{name}_n").alias(f"{name}_n"), F.sum(f"{name}_sum").alias(f"{name}_sum"), F.kll_merge_agg_double(f"{name}_sketch", k).alias(f"{name}_sketch")]
    level = F.concat_ws(",", *[F.when(F.grouping(d) == 0, d) for d in dimensions]).alias("level")
    grouped = states.cube(*dimensions) if sets is None else states.groupingSets([[F.col(d) for d in s] for s in sets], *[F.col(d) for d in dimensions])
    return grouped.agg(level, *parts)


def metrics(states: DataFrame, measures: dict[str, str] = MEASURES, ranks: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """Rates, means and percentiles of states, beside their other columns. A group without values has no mean and no percentile."""
    out = states.withColumns({"success_rate": F.try_divide("successes", "n"), "schema_validation_rate": F.try_divide("valid", "successes")})
    for name in measures:
        known = F.col(f"{name}_n") > 0
        out = out.withColumn(f"{name}_mean", F.try_divide(f"{name}_sum", f"{name}_n"))
        for r in ranks:
            out = out.withColumn(f"{name}_p{round(100 * r)}", F.when(known, F.kll_sketch_get_quantile_double(F.col(f"{name}_sketch"), F.lit(r))))
    return out.drop(*[f"{name}_sketch" for name in measures])


def store(states: DataFrame, path: str) -> None:
    """Append states, in folders by day: a day may be written in several parts."""
    states.withColumn("_day", F.coalesce("day", F.lit("unknown"))).repartition("_day").write.mode("append").partitionBy("_day").parquet(path)
