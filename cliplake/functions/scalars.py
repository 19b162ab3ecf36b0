"""Scalar column functions. null means unknown and stays null; 0 is an observation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rule tables and enumerations that results must agree on.
SUBJECT_RULES = (
    ("person_creator", ("hand", "person", "face", "creator", "man", "woman")),
    ("food", ("bread", "dough", "loaf", "loaves", "crumb", "food")),
    ("environment", ("oven", "kitchen", "counter", "room", "stove")),
    ("product", ("product", "bottle", "box", "packaging")),
)
PROMOTIONAL = ("link", "shop", "buy", "%", "off", "code", "bio")
CTA = r"(?i)\b(cta|call[s]? to action|comment[- ]?bait|engagement prompt|ask[s]?(ing)? viewers|comment your|drop a comment|follow for|link in bio)\b"
STAGE_FAILURE = {"ingest": "ingestion_failed", "performance_snapshot": "ingestion_failed", "perception": "perception_failed", "decompile": "decompilation_failed", "validate": "validation_failed", "project_canonical": "validation_failed"}
STATUSES = ("success", "rejected_by_cohort", "ingestion_failed", "perception_failed", "decompilation_failed", "validation_failed")


def _any_of(text: Column, words: Sequence[str]) -> Column:
    low = F.lower(text)
    out = F.contains(low, F.lit(words[0]))
    for w in words[1:]:
        out = out | F.contains(low, F.lit(w))
    return out


def subject_category(text: Column) -> Column:
    """First rule with a keyword in the text; null if none."""
    out = F.when(_any_of(text, SUBJECT_RULES[0][1]), SUBJECT_RULES[0][0])
    for name, words in SUBJECT_RULES[1:]:
        out = out.when(_any_of(text, words), name)
    return out


def text_role(text: Column) -> Column:
    return F.when(text.isNull(), None).when(_any_of(text, PROMOTIONAL), "promotional").otherwise("instructional")


def caption_hashtags(caption: Column) -> Column:
    """Tags of the tokens that begin with #, in order."""
    tokens = F.filter(F.split(F.trim(caption), r"\s+"), lambda x: x.startswith("#"))
    return F.transform(tokens, lambda x: F.regexp_replace(x, "^#+", ""))


def split_hashtags(cell: Column, sep: str = ";") -> Column:
    """Tags of a separated cell, without blanks, leading # and empty ones; an empty list for null."""
    tags = F.transform(F.split(cell, sep), lambda x: F.regexp_replace(F.trim(x), "^#+", ""))
    return F.coalesce(F.filter(tags, lambda x: x != ""), F.array().cast("array<string>"))


def url_host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def allowed_url(url: Column, hosts: Sequence[str]) -> Column:
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))).isin("http", "https") & url_host(url).isin(*hosts), F.lit(False))


def last_segment(url: Column) -> Column:
    """Last non-empty segment of the path; null without one."""
    path = F.regexp_replace(F.try_parse_url(url, F.lit("PATH")), "^/+|/+$", "")
    return F.nullif(F.element_at(F.split(path, "/"), -1), F.lit(""))


def video_id(ref: Column, hosts: Sequence[str]) -> Column:
    """An id of 6 to 32 digits as it is; else, of a URL on one of the hosts, the digits after a leading /video/ or the last path segment; else null."""
    named = F.nullif(F.regexp_extract(F.try_parse_url(ref, F.lit("PATH")), "^/video/([0-9]+)", 1), F.lit(""))
    return F.when(ref.rlike("^[0-9]{6,32}$"), ref).when(allowed_url(ref, hosts), F.coalesce(named, last_segment(ref)))


def canonical_url(ident: Column, pattern: str) -> Column:
    """pattern, e.g. https://host/video/%s, with an id of digits; raises on others."""
    return F.when(ident.rlike("^[0-9]+$"), F.format_string(pattern, ident)).otherwise(F.raise_error(F.concat(F.lit("not a numeric id: "), F.coalesce(ident, F.lit("null")))).cast("string"))


def handle(name: Column) -> Column:
    return F.nullif(F.regexp_replace(name, "^@+", ""), F.lit(""))


def to_text(value: Column) -> Column:
    return F.nullif(value.cast("string"), F.lit(""))


def to_int(text: Column) -> Column:
    """From text: whole numbers only, other text is null."""
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(text).try_cast("bigint"))


def epoch_iso(seconds: Column) -> Column:
    """Epoch seconds (text or number) as ISO 8601 with +00:00; null, blank, 0 and bad values are null."""
    n = F.nullif(to_int(seconds.cast("string")), F.lit(0))
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.timestamp_seconds(n).cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def age_seconds(observed: Column, published: Column) -> Column:
    """Seconds between two timestamps; negative if observed is earlier."""
    return (F.unix_micros(observed.cast("timestamp")) - F.unix_micros(published.cast("timestamp"))) / 1e6


def rational(text: Column) -> Column:
    """struct(text, value) of n/d: 0/0 is null twice, other bad forms keep the text."""
    parts = F.split(text, "/")
    n, d = F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")
    zero = (n == 0) & (d == 0)
    return F.struct(F.when(~F.coalesce(zero, F.lit(False)), text).alias("text"), F.when(F.size(parts) == 2, F.try_divide(n, d)).alias("value"))


def gcd(a: Column, b: Column) -> Column:
    """Greatest common divisor by a bounded fold: divisions are at most five for each digit of the smaller number (Lamé), and one that swaps."""
    most = 5 * F.least(F.length(a.cast("string")), F.length(b.cast("string"))) + 1
    start = F.struct(a.cast("bigint").alias("x"), b.cast("bigint").alias("y"))
    step = lambda s, _: F.when(s["y"] == 0, s).otherwise(F.struct(s["y"].alias("x"), (s["x"] % F.nullif(s["y"], F.lit(0))).alias("y")))
    return F.aggregate(F.sequence(F.lit(1), most), start, step)["x"]


def aspect_ratio(width: Column, height: Column) -> Column:
    whole = lambda x, g: F.floor(x / g).cast("string")
    text = F.get(F.transform(F.array(gcd(width, height)), lambda g: F.concat(whole(width, g), F.lit(":"), whole(height, g))), F.lit(0))  # g is computed once
    return F.when((width > 0) & (height > 0), text)


def midpoint(start: Column, end: Column) -> Column:
    return F.bround((start + end) / 2, 6)


def frame_index(mid: Column, fps: Column, start_frame: Column, end_frame: Column) -> Column:
    return F.greatest(start_frame, F.least(end_frame - 1, F.bround(mid * fps).cast("bigint")))


def seek_candidates(start: Column, duration: Column) -> Column:
    """Times to try for a representative frame, in order."""
    return F.transform(F.array(*[F.lit(f) for f in (0.5, 0.4, 0.25, 0.1)]), lambda f: F.bround(start + F.greatest(duration, F.lit(0.04)) * f, 6))


def usage_cost(tokens_in: Column, tokens_out: Column, price_in: Column, price_out: Column) -> Column:
    """Prices are per million tokens; null if any input is."""
    return F.round(tokens_in / 1e6 * price_in + tokens_out / 1e6 * price_out, 6)


def unfenced(text: Column) -> Column:
    """Text without one enclosing code fence."""
    inner = F.regexp_extract(text, r"(?s)^\s*```[a-zA-Z0-9_-]*\s*\n?(.*?)\n?\s*```\s*$", 1)
    return F.when(text.rlike(r"(?s)^\s*```.*```\s*$"), inner).otherwise(text)


def parse_object(text: Column) -> Column:
    """VARIANT of a JSON object, with or without a fence; null for anything else."""
    v = F.try_parse_json(unfenced(text))
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)


def parse_object_lenient(text: Column) -> Column:
    """As parse_object; if that fails, once more without cut-off and surrogate escapes."""
    mended = F.regexp_replace(text, r"\\u(?:[0-9a-fA-F]{1,3}(?![0-9a-fA-F])|[dD][89a-fA-F][0-9a-fA-F]{2})", "")
    return F.coalesce(parse_object(text), parse_object(mended))


def mentions_cta(text: Column) -> Column:
    return F.coalesce(text.rlike(CTA), F.lit(False))


def enum_or(value: Column, allowed: Sequence[str], fallback: str | None = "unknown") -> Column:
    return F.when(value.isin(*allowed), value).otherwise(F.lit(fallback))


def looks_like_mp4(content: Column) -> Column:
    return F.coalesce((F.octet_length(content) >= 12) & (F.substring(content, 5, 4) == F.lit(b"ftyp")), F.lit(False))


def retry_delay(message: Column, attempt: Column) -> Column:
    """Seconds that the message asks for plus 2, else 5 doubled per attempt up to 60."""
    asked = F.regexp_extract(message, r"(?i)retry in ([0-9]+(?:\.[0-9]+)?)\s*s", 1).try_cast("double")
    return F.coalesce(asked + 2, F.least(F.lit(60.0), 5 * F.pow(F.lit(2.0), attempt - 1)))


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, "([^/]+)/*$", 1), r"(?<=.)\.[^.]*$", "")


def run_id(at: Column, salt: Column) -> Column:
    return F.concat(F.date_format(at, "yyyyMMdd'T'HHmmss'Z'"), F.lit("_"), F.left(F.md5(salt.cast("string")), F.lit(8)))


def stage_failure(stage: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in STAGE_FAILURE.items() for x in kv])
    return F.coalesce(F.try_element_at(names, stage), F.concat(stage, F.lit("_failed")))


def reference(kind: str, ref: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), ref.alias("reference"))


def exact_quote(exact: Column, confidence: Column) -> Column:
    return F.coalesce(exact & (confidence == "high"), F.lit(False))


def meaningful(text: Column, least: int = 40) -> Column:
    return F.coalesce(F.length(F.trim(text)) >= least, F.lit(False))


def sorted_json(m: Column) -> Column:
    """JSON of a map with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))), {"ignoreNullFields": "false"})


def render(template: str, values: dict[str, Column]) -> Column:
    """template with {name} replaced by the JSON or text of each value."""
    out = F.lit(template)
    for k, v in values.items():
        out = F.replace(out, F.lit("{" + k + "}"), v)
    return out
