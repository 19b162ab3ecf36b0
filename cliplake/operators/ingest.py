"""Ingestion of public videos: collect with fallback, check, hash, keep media and raw metadata once, add observations, leave a manifest.

Tables below a root: media (video_id, sha256, n_bytes, content), metadata_raw,
metadata, observations and manifests. Nothing there is ever rewritten; the media
of a video must always hash alike. media, metadata_raw and metadata have commit logs."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.functions import scalars as S
from cliplake.operators import normalize
from cliplake.sources import calls, writers
from cliplake.sources.commits import Table

VERSION = "ingest-1.0.0"
ATTEMPTS = "array<struct<collector:string,ok:boolean,error_category:string,error_message:string>>"
COLLECTED = f"url string, video_id string, creator_handle string, source_url string, collector_name string, collector_version string, collected_at string, payload string, content binary, collector_attempts {ATTEMPTS}"
FIELDS = ("creator_handle", "creator_id", "caption", "hashtags", "published_at", "duration_seconds", "music_title", "music_author", *normalize.COUNTS)


def collect(entries: DataFrame, collectors: list[tuple[str, Callable[[str], dict]]], hosts: tuple[str, ...], retry: calls.Retry = calls.Retry()) -> DataFrame:
    """COLLECTED and how it went, for entries (url, creator_handle): the first collector that returns media, with all attempts. A url on another host is invalid_url and no collector is asked."""
    first = calls.first_of(collectors)

    def one(row: dict) -> dict:
        if not row["allowed"]:
            raise calls.Failure(f"not a url of an allowed host: {row['url']}", "invalid_url")
        got, attempts = first(row["url"])
        return {**got, "creator_handle": row.get("creator_handle") or got.get("creator_handle"), "source_url": got.get("source_url") or row["url"], "collected_at": got.get("collected_at") or datetime.now(UTC).isoformat(timespec="seconds"), "collector_attempts": attempts}

    asked = entries.select("url", "creator_handle", S.allowed_url(F.col("url"), hosts).alias("allowed"))
    return calls.call_out(asked, one, COLLECTED, retry, "ingestion_error")


def _differs() -> Column:
    return F.concat(F.lit("the media of "), F.col("video_id"), F.lit(" differs from what is kept"))


def checked(collected: DataFrame, media: DataFrame) -> DataFrame:
    """collected with sha256, n_bytes, reused (the media is there already), and failures: not an MP4 (download_failure), or other bytes than those kept (artifact_mismatch). media: video_id, sha256."""
    rows = collected.withColumns({"sha256": F.sha2("content", 256), "n_bytes": F.octet_length("content").cast("bigint")})
    kept = media.select(F.col("video_id").alias("_id"), F.col("sha256").alias("_kept"))
    rows = rows.join(kept, F.col("video_id") == F.col("_id"), "left")
    no_mp4 = F.col("ok") & ~S.looks_like_mp4(F.col("content"))
    other = F.col("ok") & ~no_mp4 & (F.col("sha256") != F.col("_kept"))
    category = F.when(no_mp4, "download_failure").when(F.coalesce(other, F.lit(False)), "artifact_mismatch").otherwise(F.col("error_category"))
    message = F.when(no_mp4, "the media is not an MP4 container").when(F.coalesce(other, F.lit(False)), _differs()).otherwise(F.col("error_message"))
    return rows.withColumns({"error_category": category, "error_message": message, "reused": F.col("_kept").isNotNull(), "ok": F.col("ok") & ~no_mp4 & ~F.coalesce(other, F.lit(False))}).drop("_id", "_kept")


def run(entries: DataFrame, collectors: list[tuple[str, Callable[[str], dict]]], root: str, hosts: tuple[str, ...], url_pattern: str, retry: calls.Retry = calls.Retry()) -> DataFrame:
    """Ingest entries (url, creator_handle); returns url, video_id, ok, error_category, error_message, sha256, n_bytes, reused, attempts, observation (time stamp if the video was known) and the normalised fields.

    Collectors are called once: what they return is written first. Of several
    entries of one video in a run the first by url is kept; one with other bytes
    than what is kept, by this run, an earlier one or another at the same time, is
    an artifact_mismatch."""
    spark, stamp = entries.sparkSession, f"{datetime.now(UTC):%Y%m%dT%H%M%SZ}"
    where = f"{root}/collected/{stamp}-{uuid4().hex[:8]}"
    collect(entries, collectors, hosts, retry).write.parquet(where)
    media = Table(spark, f"{root}/media", "video_id string, sha256 string, n_bytes bigint, content binary")
    rows = checked(spark.read.parquet(where), media.read())
    rows = normalize.normalize(rows.withColumn("_payload", F.try_parse_json("payload")), "_payload", "creator_handle").drop("_payload")
    rows.write.parquet(f"{where}-checked")
    rows = spark.read.parquet(f"{where}-checked")
    media.add_once(rows.where("ok"), "video_id", "sha256", F.col("url")).write.parquet(f"{where}-outcomes")
    told = spark.read.parquet(f"{where}-outcomes").select(F.col("video_id").alias("_id"), F.col("sha256").alias("_digest"), "outcome")
    rows = rows.join(told, F.col("ok") & (F.col("video_id") == F.col("_id")) & (F.col("sha256") == F.col("_digest")), "left").drop("_id", "_digest")
    late = F.coalesce(F.col("outcome") == "artifact_mismatch", F.lit(False))
    rows = rows.withColumns({"ok": F.col("ok") & ~late, "error_category": F.when(late, "artifact_mismatch").otherwise(F.col("error_category")), "error_message": F.when(late, _differs()).otherwise(F.col("error_message")), "reused": F.col("reused") | F.coalesce(F.col("outcome") == "reused", F.lit(False))}).drop("outcome")
    rows = rows.withColumn("observation", F.when(F.col("reused"), F.lit(stamp)))
    good = rows.where("ok").groupBy("video_id").agg(F.min_by(F.struct(*[c for c in rows.columns if c not in ("video_id", "content")]), "url").alias("_r")).select("video_id", "_r.*")
    raw = good.where("NOT reused").select("video_id", F.sha2("payload", 256).alias("sha256"), "payload")
    writers.write_once(raw, f"{root}/metadata_raw", "video_id")
    fields = good.select("video_id", "source_url", "collected_at", "collector_name", "collector_version", *FIELDS)
    writers.write_once(fields.withColumn("sha256", F.sha2(F.to_json(F.struct(*FIELDS)), 256)), f"{root}/metadata", "video_id")
    seen = good.where("reused").select("video_id", F.lit(stamp).alias("observation_timestamp"), F.concat("video_id", F.lit("/manifest")).alias("observation_of_manifest"), "payload", F.to_json(F.struct(*FIELDS), {"ignoreNullFields": "false"}).alias("observed_metadata"))
    writers.writing(f"{root}/observations", lambda: seen.write.mode("append").parquet(f"{root}/observations"))
    failed = F.filter("collector_attempts", lambda a: ~a["ok"])
    manifest = good.select(
        F.col("url").alias("source_url"),
        S.canonical_url(F.col("video_id"), url_pattern).alias("canonical_source_url"),
        "video_id",
        F.create_map(*[x for k in ("media", "metadata_raw", "metadata") for x in (F.lit(k), F.concat(F.lit(f"{k}/"), F.col("video_id")))]).alias("artifacts"),
        "sha256",
        F.col("n_bytes").alias("byte_size"),
        F.col("reused").alias("mp4_reused_from_previous_run"),
        "collected_at",
        "collector_name",
        "collector_version",
        F.transform("collector_attempts", lambda a: a["collector"]).alias("attempted_collectors_in_order"),
        F.col("collector_attempts").alias("attempts"),
        F.transform(failed, lambda a: F.struct(a["collector"].alias("collector"), a["error_category"].alias("error_category"), a["error_message"].alias("message"))).alias("fallback_or_error_notes"),
        F.lit(VERSION).alias("package_version"),
    )
    writers.writing(f"{root}/manifests", lambda: manifest.write.mode("append").parquet(f"{root}/manifests"))
    return rows.select("url", "video_id", "ok", "error_category", "error_message", "sha256", "n_bytes", "reused", "collector_attempts", "observation", *FIELDS)


def main() -> None:
    import argparse
    import importlib
    import json
    import sys

    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("url")
    p.add_argument("--root", default="data/raw")
    p.add_argument("--hosts", required=True, help="hosts, joined by commas")
    p.add_argument("--pattern", required=True, help="canonical url with %%s for the id")
    p.add_argument("--collectors", required=True, help="module:function that returns [(name, function)]")
    a = p.parse_args()
    module, name = a.collectors.split(":")
    spark = SparkSession.builder.appName("ingest").getOrCreate()
    entries = spark.createDataFrame([(a.url.strip(), None)], "url string, creator_handle string")
    got = run(entries, getattr(importlib.import_module(module), name)(), a.root, tuple(a.hosts.split(",")), a.pattern).drop("collector_attempts").collect()[0]
    if not got["ok"]:
        print(json.dumps({"error": {"category": got["error_category"], "message": got["error_message"]}}), file=sys.stderr)
        sys.exit(1)
    print(json.dumps({k: got[k] for k in ("video_id", "sha256", "n_bytes", "reused", "observation")}))


if __name__ == "__main__":
    main()
