"""A ledger of calls that leave the engine: what a call returned is kept under (key, stage, hash of its input), so that nothing is called twice.

The rows of a stage are worked off in batches, each a Spark job that appends its
results before the next begins. A run that ends in mid-stage, for whatever reason,
loses the batch it was in; the next one calls what the ledger doesn't have."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from cliplake.sources import calls
from cliplake.sources.pacing import Pace, lanes, paced

#: Rows of a batch: what a lost job calls again at most.
BATCH = 1000


def _plain(value: Column, kind: DataType) -> Column:
    """value with maps as sorted entries at every depth, so that equal inputs have equal JSON."""
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*[_plain(value[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _plain(x, kind.elementType))
    if isinstance(kind, MapType):
        return F.array_sort(F.transform(F.map_entries(value), lambda e: F.struct(e["key"].alias("key"), _plain(e["value"], kind.valueType).alias("value"))))
    return value


def input_hash(rows: DataFrame) -> Column:
    """SHA-256 of a row's JSON, columns by name."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    return F.sha2(F.to_json(F.struct(*[_plain(F.col(c), kinds[c]).alias(c) for c in sorted(kinds)]), {"ignoreNullFields": "false"}), 256)


def _read(rows: DataFrame, path: str, schema: str | StructType) -> DataFrame:
    try:
        return rows.sparkSession.read.schema(schema).parquet(path)
    except Exception as e:  # the first batch makes the folder
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return rows.sparkSession.createDataFrame([], schema)


def call(
    rows: DataFrame,
    function: Callable[[dict], dict],
    schema: str,
    path: str,
    stage: str,
    key: str = "video_id",
    retry: calls.Retry = calls.Retry(),
    unexpected: str | None = None,
    batch_rows: int = BATCH,
    pace: Pace | None = None,
    fresh: bool = False,
) -> DataFrame:
    """calls.call_out(rows, function, schema) by way of the ledger at `path`: a row for each of rows.

    Only calls that went well are taken from the ledger; failed ones are made again
    in the next run. Equal rows are called once. With fresh, nothing is taken from
    earlier runs. function may be another than that which made the ledger: a stage
    whose results would differ needs another name."""
    result = f"{schema}, {calls.CALLED}"
    kept = f"_key string, _hash string, _run string, {result}"
    run, where = uuid4().hex, f"{path}/stage={stage}"
    todo = rows.withColumns({"_key": F.coalesce(F.col(key).cast("string"), F.lit("")), "_hash": input_hash(rows)})
    asked = f"{path}/asked/{stage}-{run}"
    todo.write.parquet(asked)
    todo = rows.sparkSession.read.schema(todo.schema).parquet(asked)
    known = _read(rows, where, kept).where("ok")
    if fresh:
        known = known.limit(0)
    left = todo.join(known.select("_key", "_hash"), ["_key", "_hash"], "left_anti").dropDuplicates(["_key", "_hash"])
    count = left.count()
    batches = -(-count // batch_rows)
    if batches > 1:  # the batches are folders, so that each job reads its own only
        left.withColumn("_batch", F.pmod(F.xxhash64("_key", "_hash"), F.lit(batches)).cast("int")).repartition("_batch").write.partitionBy("_batch").parquet(f"{asked}-batches")
    names = [f.name for f in rows.sparkSession.createDataFrame([], result).schema]
    for k in range(batches):
        part = left if batches == 1 else _read(rows, f"{asked}-batches/_batch={k}", todo.schema)
        made = calls.call_out(lanes(part, pace) if pace else part.repartition(min(batch_rows, rows.sparkSession.sparkContext.defaultParallelism)), _with_keys(paced(function, pace) if pace else function), f"_key string, _hash string, {schema}", retry, unexpected)
        made.withColumn("_run", F.lit(run)).select("_key", "_hash", "_run", *names).write.mode("append").parquet(where)
    # of two runs at once, or a call that failed before, the good one; of equals the first run by name
    found = _read(rows, where, kept)
    found = found.where((F.col("_run") == run) if fresh else (F.col("ok") | (F.col("_run") == run)))
    best = found.groupBy("_key", "_hash").agg(F.max_by(F.struct(*names), F.struct("ok", F.col("_run") == run)).alias("_got"))
    return todo.select("_key", "_hash").join(best, ["_key", "_hash"]).select("_got.*")


def _with_keys(function: Callable[[dict], dict]) -> Callable[[dict], dict]:
    def run(row: dict) -> dict:
        return function({k: v for k, v in row.items() if k not in ("_key", "_hash")})

    return run
