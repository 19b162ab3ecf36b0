"""Cohort policy: ordered rules with a reason for each decision."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MOST_VIDEOS = 50


@dataclass(frozen=True)
class Policy:
    cohort_id: str
    version: str
    required_hashtags: tuple[str, ...] = ()
    handles: tuple[str, ...] = ()  # empty: any
    min_views: int | None = None
    max_views: int | None = None
    max_videos: int = MOST_VIDEOS
    approval: str | None = None

    @classmethod
    def from_dict(cls, raw: dict) -> Policy:
        """From the compact form (rules at once) or the full one (eligibility, size_range, approval_status)."""
        rules = raw.get("rules") or raw.get("eligibility") or {}
        size = raw.get("size_range") or {}
        most = raw.get("max_videos", size.get("max", MOST_VIDEOS))
        if not isinstance(most, int) or not 1 <= most <= MOST_VIDEOS:
            raise ValueError(f"max_videos must be from 1 to {MOST_VIDEOS}")
        return cls(
            str(raw["cohort_id"]),
            str(raw["version"]),
            tuple(rules.get("required_hashtags") or ()),
            tuple(h.lstrip("@").lower() for h in rules.get("allowed_creator_handles") or ()),
            rules.get("min_views"),
            rules.get("max_views"),
            most,
            raw.get("approval_status"),
        )

    def require_approved(self) -> Policy:
        if self.approval != "approved":
            raise ValueError(f"cohort {self.cohort_id} is not approved: {self.approval}")
        return self


def reason(policy: Policy, hashtags: Column, handle: Column, views: Column) -> Column:
    """`eligible`, or the first rule that fails. Hashtags compare as they are, handles in lower case; a missing handle passes, missing views fail a bound."""
    out = F.when(F.lit(False), "")
    if policy.required_hashtags:
        wanted = F.array(*[F.lit(h) for h in policy.required_hashtags])
        out = out.when(~F.coalesce(F.arrays_overlap(hashtags, wanted), F.lit(False)), "missing_required_hashtag")
    if policy.handles:
        out = out.when(handle.isNotNull() & ~F.lower(F.regexp_replace(handle, "^@+", "")).isin(*policy.handles), "creator_not_allowed")
    if policy.min_views is not None:
        out = out.when(F.coalesce(views < policy.min_views, F.lit(True)), "below_min_views")
    if policy.max_views is not None:
        out = out.when(F.coalesce(views > policy.max_views, F.lit(True)), "above_max_views")
    return out.otherwise("eligible")


def decide(entries: DataFrame, policy: Policy) -> DataFrame:
    """entries with reason and accepted."""
    why = reason(policy, F.col("hashtags"), F.col("creator_handle"), F.col("views"))
    return entries.withColumn("reason", why).withColumn("accepted", F.col("reason") == "eligible")


def guard_size(entries: DataFrame, policy: Policy) -> DataFrame:
    n = entries.limit(policy.max_videos + 1).count()
    if n > policy.max_videos:
        raise ValueError(f"more than {policy.max_videos} entries")
    return entries


def cap_per_creator(entries: DataFrame, creator: str, order: list, most: int = 3) -> DataFrame:
    """The first `most` entries of each creator (documented policy)."""
    return entries.withColumn("_turn", F.row_number().over(W.partitionBy(creator).orderBy(*order))).where(F.col("_turn") <= most).drop("_turn")


def strata(entries: DataFrame, order: list, parts: int = 3, by: str | None = None) -> DataFrame:
    """Adds stratum 1..parts of about equal size, by the given order (documented policy)."""
    w = (W.partitionBy(by) if by else W.partitionBy()).orderBy(*order)
    return entries.withColumn("stratum", F.ntile(parts).over(w))


def within_duration(entries: DataFrame, least: float, most: float, column: str = "duration_seconds") -> DataFrame:
    return entries.where(F.col(column).between(least, most))
