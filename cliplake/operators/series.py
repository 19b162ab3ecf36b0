"""Rows in order of time, in groups of any size: the row before, runs that a gap ends, and scans with a small state.

A window over a group sorts it in one task. Here a group is cut into stretches of
its axis: windows run inside a stretch, and over one summary row a stretch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def lagged(rows: DataFrame, by: str, at: str, values: list[str], stretch: float) -> DataFrame:
    """rows with prev_<value>: the values of the row before by `at`, which tells any two rows of a group apart; null for the first.

    stretch: a length of the axis that holds some thousand rows; the result doesn't depend on it."""
    cut = rows.withColumn("_s", F.floor(F.col(at) / F.lit(stretch)))
    last = cut.groupBy(by, "_s").agg(F.max_by(F.struct(*values), at).alias("_last"))
    last = last.withColumn("_last", F.lag("_last").over(W.partitionBy(by).orderBy("_s")))
    inside = W.partitionBy(by, "_s").orderBy(at)
    cut = cut.withColumn("_prev", F.lag(F.struct(*values)).over(inside)).withColumn("_first", F.row_number().over(inside) == 1)
    carried = last.select(F.col(by).alias("_by"), F.col("_s").alias("_of"), "_last")
    out = cut.join(carried, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_s") == F.col("_of")), "left")
    before = F.when(F.col("_first"), F.col("_last")).otherwise(F.col("_prev"))
    return out.withColumn("_before", before).select(*rows.columns, *[F.col(f"_before.{v}").alias(f"prev_{v}") for v in values])


def runs(rows: DataFrame, by: str, at: str, gap: float, stretch: float, closed: bool = False) -> DataFrame:
    """rows with `run`: the `at` at which their run begins. A gap of more than `gap` (at least, if closed) between neighbours ends one.

    Nothing that reaches over a shorter distance crosses runs, so that each can be
    worked off by itself. Rows without `at` are left out."""
    far = (lambda d: d >= gap) if closed else (lambda d: d > gap)
    cut = rows.where(F.col(at).isNotNull()).withColumn("_s", F.floor(F.col(at) / F.lit(stretch)))
    inside = W.partitionBy(by, "_s").orderBy(at)
    cut = cut.withColumn("_begin", F.when(far(F.col(at) - F.lag(at).over(inside)), F.col(at)))
    parts = cut.groupBy(by, "_s").agg(F.min(at).alias("low"), F.max(at).alias("high"), F.max("_begin").alias("begin"))
    along = W.partitionBy(by).orderBy("_s")
    fresh = F.when(F.lag("high").over(along).isNull() | far(F.col("low") - F.lag("high").over(along)), F.col("low"))
    parts = parts.withColumn("fresh", fresh).withColumn("last", F.coalesce("begin", "fresh"))
    parts = parts.withColumn("carried", F.coalesce("fresh", F.last("last", ignorenulls=True).over(along.rowsBetween(W.unboundedPreceding, -1))))
    parts = parts.select(F.col(by).alias("_by"), F.col("_s").alias("_of"), "carried")
    out = cut.join(parts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_s") == F.col("_of")))
    begun = F.max("_begin").over(inside.rangeBetween(W.unboundedPreceding, W.currentRow))
    return out.withColumn("run", F.coalesce(begun, "carried")).select(*rows.columns, "run")


def scan(rows: DataFrame, keys: list[str], order: list[str | Column], step: Callable[[], tuple[Callable, Callable]], schema: str) -> DataFrame:
    """Rows of each key in order, through a scan with a state: step() makes (take, end) for a key; both return rows of `schema`.

    A task reads its rows as sorted batches and holds the state of one key: a key
    may have any number of rows, and is never collected."""
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, take, end = None, None, None
        for b in batches:
            out: list[tuple] = []
            cells = [b.column(c).to_pylist() for c in columns]
            for row in zip(*cells):
                here = tuple(row[columns.index(k)] for k in keys)
                if end is None or here != key:
                    if end is not None:
                        out += end()
                    key, (take, end) = here, step()
                out += take(row)
            if out:
                yield batch(out)
        if end is not None and (rest := list(end())):
            yield batch(rest)

    kinds = pa.schema([(f.name, _arrow(f.dataType)) for f in rows.sparkSession.createDataFrame([], schema).schema.fields])

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kinds.field(i).type) for i, c in enumerate(zip(*out))], schema=kinds)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
