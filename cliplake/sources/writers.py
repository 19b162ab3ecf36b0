"""Writers: the index, append-only logs, write-once records, documents, snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from cliplake.sources.calls import Failure
from cliplake.sources.commits import Table

INDEX = "video_id string, creator_id string, creator_handle string, source_url string, cohort_id string, published_at string, observed_at string, views bigint, likes bigint, comments bigint, shares bigint, duration_seconds double, status string, creative_ir_path string, canonical_ir_path string, pipeline_version string, schema_versions string, model_ids string, total_usage_cost_usd double, total_latency_seconds double"

#: Rows of an index file.
INDEX_ROWS = 5_000_000


def index_rows(manifests: DataFrame) -> DataFrame:
    """Rows of INDEX; columns that the manifests lack are null, maps become JSON with sorted keys."""
    from cliplake.functions.scalars import sorted_json

    kinds = dict(manifests.dtypes)
    cells = []
    for field in INDEX.split(", "):
        name, kind = field.split()
        if name not in kinds:
            cells.append(F.lit(None).cast(kind).alias(name))
        elif kinds[name].startswith("map"):
            cells.append(sorted_json(F.col(name)).alias(name))
        else:
            cells.append(F.col(name).cast(kind).alias(name))
    return manifests.select(*cells)


def write_index(rows: DataFrame, path: str, files: int = 1) -> None:
    """Rebuild the index, in ranges of video_id. Without rows there is still a file with the schema. INDEX_ROWS fit a file."""
    parts = rows.coalesce(1) if files <= 1 else rows.repartitionByRange(files, "video_id")
    parts.sortWithinPartitions("video_id").write.mode("overwrite").parquet(path)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a whole table is at path: its job has committed."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def writing(path: str, call: Callable[[], None]) -> None:
    """call(), which writes to path; what goes wrong is a file_write_failure."""
    try:
        call()
    except Exception as e:
        raise Failure(f"could not write {path}: {e}", "file_write_failure", detail={"path": path}) from e


def _sorted(value: Column, kind: DataType) -> Column:
    """value with the fields of its structs and the keys of its maps in order, at every depth."""
    if isinstance(kind, StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(value.isNotNull(), F.struct(*[_sorted(value[f.name], f.dataType).alias(f.name) for f in fields]))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _sorted(x, kind.elementType))
    if isinstance(kind, MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(e["key"], _sorted(e["value"], kind.valueType)))
        return F.map_from_entries(F.array_sort(entries, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)))
    return value


def pretty_json(rows: DataFrame, column: str) -> Column:
    """Indented JSON of a struct column, keys in order, nulls kept."""
    return F.to_json(_sorted(F.col(column), rows.schema[column].dataType), {"ignoreNullFields": "false", "pretty": "true"})


def write_documents(rows: DataFrame, path: str, column: str, key: str = "video_id") -> None:
    """One folder a video, key=<id>, with its document as indented JSON text."""
    writing(path, lambda: rows.select(F.col(key), pretty_json(rows, column).alias("value")).write.mode("append").partitionBy(key).text(path))


def append_log(rows: DataFrame, path: str) -> None:
    """Rejections and failures, one JSON object a line."""
    rows.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_once(rows: DataFrame, path: str, key: str, digest: str = "sha256", order: Column | None = None) -> DataFrame:
    """Keep rows whose key is new, as one transaction; returns the key and digest of those that are kept with another digest (artifact_mismatch), of earlier writes, of others at the same time, or of this batch (the least `order` is kept)."""
    table = Table(rows.sparkSession, path, rows.schema)
    return table.add_once(rows, key, digest, order).where("outcome = 'artifact_mismatch'").select(key, digest)


def write_snapshots(rows: DataFrame, path: str) -> None:
    """Append performance snapshots, in folders by day of observation."""
    rows.withColumn("day", F.left("observed_at", F.lit(10))).write.mode("append").partitionBy("day").parquet(path)
