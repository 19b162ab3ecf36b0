"""Readers: source lists, manifests, reviews, perception results, documents, binary media. Schemas are fixed, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.functions import scalars as S
from cliplake.operators.relational import refuse_duplicates

KNOWN = ("url", "video_id", "creator_handle", "hashtags", "views", "published_at")
REVIEW = "video_id string, scores map<string,double>, errors array<string>"


def source_list(spark: SparkSession, path: str) -> DataFrame:
    """url, video_id, creator_handle, hashtags, views, published_at, extra (map of other columns) of a CSV or JSONL list.

    Fails on another suffix, an empty list, a missing url or a url given twice."""
    if path.endswith(".csv"):
        raw = spark.read.option("header", True).csv(path)
    elif path.endswith((".jsonl", ".json")):
        lines = spark.read.text(path).where("trim(value) <> ''").select(F.parse_json("value").alias("v"))
        names = [r[0] for r in lines.select(F.explode(F.map_keys(F.try_variant_get("v", "$", "map<string,variant>")))).distinct().collect()]
        get = lambda c: F.when(F.schema_of_variant(F.try_variant_get("v", f"$['{c}']", "variant")).startswith("ARRAY"), F.array_join(F.try_variant_get("v", f"$['{c}']", "array<string>"), ";")).otherwise(F.try_variant_get("v", f"$['{c}']", "string"))
        raw = lines.select(*[get(c).alias(c) for c in sorted(names)])
    else:
        raise ValueError(f"source lists are .csv or .jsonl: {path}")
    return entries(raw)


def entries(raw: DataFrame) -> DataFrame:
    blank = lambda c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")) if c in raw.columns else F.lit(None).cast("string")
    other = [c for c in raw.columns if c not in KNOWN]
    extra = F.map_from_arrays(F.array(*[F.lit(c) for c in other]), F.array(*[F.col(f"`{c}`") for c in other])) if other else F.create_map().cast("map<string,string>")
    out = raw.select(blank("url").alias("url"), blank("video_id").alias("video_id"), S.handle(blank("creator_handle")).alias("creator_handle"), S.split_hashtags(blank("hashtags")).alias("hashtags"), S.to_int(blank("views")).alias("views"), blank("published_at").alias("published_at"), extra.alias("extra"))
    if out.isEmpty():
        raise ValueError("the source list is empty")
    if not out.where("url IS NULL").isEmpty():
        raise ValueError("an entry lacks a url")
    return refuse_duplicates(out, "url")


def flat(rows: DataFrame, names: list[str]) -> DataFrame:
    """entries() with the named extra columns beside the others, for export; a name that is a column already is left out."""
    more = [n for n in names if n not in rows.columns]
    return rows.select(*[c for c in rows.columns if c != "extra"], *[F.try_element_at("extra", F.lit(n)).alias(n) for n in more])


def reviews(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REVIEW).json(path)


def manifests(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Record manifests with their path; order by it where order counts."""
    return spark.read.schema(schema).option("multiLine", True).json(f"{root}/*/record_manifest.json").withColumn("manifest_path", F.col("_metadata.file_path"))


def media(spark: SparkSession, path: str, pattern: str = "*.mp4") -> DataFrame:
    """path, sha256, is_mp4, n_bytes of media files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(S.file_stem(F.col("path")).alias("video_id"), "path", F.sha2("content", 256).alias("sha256"), S.looks_like_mp4(F.col("content")).alias("is_mp4"), F.col("length").alias("n_bytes"))


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def frame_bytes(spark: SparkSession, path: str) -> DataFrame:
    """path, content of the images of representative frames; fails if there are none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").load(path).select("path", "content")
    if files.isEmpty():
        raise FileNotFoundError(f"no frames below {path}")
    return files


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """path, document (VARIANT; null if it isn't JSON) of JSON files, one document each: evaluations, manifests, run results."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("document"))
    return rows


#: What perception leaves for a video, as JSON below a folder of its name.
FACTS = "duration_seconds double, width int, height int, fps double, video_codec string, sha256 string"
SHOTS = "shots array<struct<shot_id:string,start_seconds:double,end_seconds:double,start_frame:bigint,end_frame:bigint>>"
FRAMES = "shot_id string, path string, timestamp_seconds double, frame_index bigint"


def perception_inputs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(facts, shots, frames) of all videos below root/<video_id>/: media_facts.json and shots.json must be there, frames.json may not.

    Each with video_id; shots have one row a shot with its position."""
    by = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("video_id")
    read = lambda schema, name: spark.read.schema(schema).option("multiLine", True).json(f"{root}/*/{name}")
    facts = read(FACTS, "media_facts.json").select(by, *[x.split()[0] for x in FACTS.split(", ")])
    shots = read(SHOTS, "shots.json").select(by, F.posexplode("shots").alias("position", "shot")).select("video_id", "position", "shot.*")
    try:
        frames = read(FRAMES, "frames.json").select(by, *[x.split()[0] for x in FRAMES.split(", ")])
    except Exception as e:  # no video has any
        if "PATH_NOT_FOUND" not in str(e):
            raise
        frames = spark.createDataFrame([], f"video_id string, {FRAMES}")
    return facts, shots, frames


def latest_run(spark: SparkSession, root: str, name: str = "usage.json") -> str | None:
    """The greatest run id with a file `name` below root/<run_id>/, as ids begin with their time."""
    try:
        files = spark.read.text(f"{root}/*/{name}", wholetext=True)
    except Exception as e:  # no run yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return files.select(F.max(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))).collect()[0][0]
