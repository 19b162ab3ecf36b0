"""Schema-on-read mapping of collector payloads: the first path with a value wins, then it is cast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliplake.functions import scalars as S

# Fallback paths of each field, in order.
PATHS = {
    "creator_handle": ("author.unique_id", "uploader", "channel", "author"),
    "creator_id": ("author.uid", "author_id", "uploader_id", "channel_id"),
    "caption": ("desc", "title", "description", "video_description"),
    "epoch": ("create_time", "timestamp", "release_timestamp"),
    "iso": ("createTime", "upload_date_iso"),
    "duration_seconds": ("video.duration", "duration"),
    "views": ("stats.play_count", "play_count", "view_count", "views"),
    "likes": ("stats.digg_count", "digg_count", "like_count", "likes"),
    "comments": ("stats.comment_count", "comment_count", "comments"),
    "shares": ("stats.share_count", "share_count", "repost_count", "shares"),
    "saves": ("stats.collect_count", "collect_count", "save_count", "favorite_count"),
    "music_title": ("music.title", "music_meta.music_name", "track", "sound_track_name"),
    "music_author": ("music.author", "music_meta.music_author", "artist", "music_author"),
}
COUNTS = ("views", "likes", "comments", "shares", "saves")


def first(payload: Column, *paths: str) -> Column:
    """VARIANT at the first path that exists and is not null; 0 and "" are values. Cast it afterwards, not before."""
    found = [F.try_variant_get(payload, f"$.{p}", "variant") for p in paths]
    return F.coalesce(*[F.when(~F.is_variant_null(x), x) for x in found])


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def text_only(v: Column) -> Column:
    return F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string"))


def as_text(v: Column) -> Column:
    return F.nullif(F.try_variant_get(v, "$", "string"), F.lit(""))


def as_int(v: Column) -> Column:
    """Numbers are truncated; text must be a whole number; anything else is null."""
    kind = _kind(v)
    number = F.try_variant_get(v, "$", "double")
    return F.when(kind == "STRING", S.to_int(F.try_variant_get(v, "$", "string"))).when(kind == "BIGINT", F.try_variant_get(v, "$", "bigint")).when(kind.rlike("^(DOUBLE|DECIMAL|FLOAT)"), F.signum(number).cast("bigint") * F.floor(F.abs(number))).when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("bigint"))


def hashtags(payload: Column, caption: Column) -> Column:
    """From text_extra or hashtags if either is a list (even an empty one), else from the caption."""
    listed = first(payload, "text_extra", "hashtags")
    is_list = F.coalesce(_kind(listed).startswith("ARRAY"), F.lit(False))

    def name(x: Column) -> Column:
        named = F.coalesce(*[F.nullif(F.try_variant_get(x, f"$.{k}", "string"), F.lit("")) for k in ("hashtag_name", "name", "title")])
        return F.when(_kind(x) == "STRING", F.try_variant_get(x, "$", "string")).otherwise(named)

    tags = F.transform(F.try_variant_get(listed, "$", "array<variant>"), lambda x: F.regexp_replace(name(x), "^#+", ""))
    return F.when(is_list, F.filter(tags, lambda t: t.isNotNull() & (t != ""))).otherwise(F.coalesce(S.caption_hashtags(caption), F.array().cast("array<string>")))


def to_json(record: Column, nulls: bool = True) -> Column:
    """JSON of a struct, with its nulls or without."""
    return F.to_json(record, {"ignoreNullFields": str(not nulls).lower()})


def normalize(rows: DataFrame, payload: str = "payload", hint: str | None = None) -> DataFrame:
    """Adds the normalised fields to rows with a VARIANT payload. `hint` is a column with a handle for payloads that have none."""
    p = F.col(payload)
    got = first(p, *PATHS["creator_handle"])
    name = F.when(got.isNotNull(), text_only(got)) if hint is None else F.when(got.isNotNull(), text_only(got)).otherwise(F.col(hint))
    caption = text_only(first(p, *PATHS["caption"]))
    epoch = F.try_variant_get(first(p, *PATHS["epoch"]), "$", "string")
    out = {
        "creator_handle": S.handle(name),
        "creator_id": as_text(first(p, *PATHS["creator_id"])),
        "caption": caption,
        "hashtags": hashtags(p, caption),
        "published_at": F.coalesce(S.epoch_iso(epoch), as_text(first(p, *PATHS["iso"]))),
        "duration_seconds": F.try_variant_get(first(p, *PATHS["duration_seconds"]), "$", "string").try_cast("double"),
        "music_title": as_text(first(p, *PATHS["music_title"])),
        "music_author": as_text(first(p, *PATHS["music_author"])),
    }
    out |= {c: as_int(first(p, *PATHS[c])) for c in COUNTS}
    return rows.withColumns(out)


def probe_facts(rows: DataFrame, raw: str = "probe_json") -> DataFrame:
    """Media facts from prober JSON: the first video stream, duration of the container before that of the stream; null struct if it isn't an object with one.

    Parsed JSON, stream, size and rate are columns of their own, so that each is computed once a row."""
    got = rows.withColumn("_v", F.try_parse_json(S.unfenced(F.col(raw))))
    got = got.withColumn("_v", F.when(F.schema_of_variant("_v").startswith("OBJECT"), F.col("_v")))
    streams = F.filter(F.try_variant_get("_v", "$.streams", "array<variant>"), lambda s: F.try_variant_get(s, "$.codec_type", "string") == "video")
    got = got.withColumn("_video", F.get(streams, F.lit(0)))
    at = lambda k, t="string": F.try_variant_get("_video", f"$.{k}", t)
    got = got.withColumns({"_width": at("width").try_cast("int"), "_height": at("height").try_cast("int"), "_rate": at("avg_frame_rate")})
    got = got.withColumn("_rate", S.rational(F.col("_rate")))
    facts = F.struct(
        F.coalesce(F.try_variant_get("_v", "$.format.duration", "string").try_cast("double"), at("duration").try_cast("double")).alias("duration_seconds"),
        F.col("_width").alias("width"),
        F.col("_height").alias("height"),
        S.aspect_ratio(F.col("_width"), F.col("_height")).alias("aspect_ratio"),
        F.col("_rate.text").alias("fps_text"),
        F.col("_rate.value").alias("fps"),
        F.coalesce(at("nb_read_frames").try_cast("bigint"), at("nb_frames").try_cast("bigint")).alias("frame_count"),
        at("codec_name").alias("video_codec"),
    )
    return got.select(*[F.col(f"`{c}`") for c in rows.columns if c != "media_facts"], F.when(F.col("_video").isNotNull(), facts).alias("media_facts"))
