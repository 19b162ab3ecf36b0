"""Calls that leave the engine (collectors, probers, models): bounded retry, isolation, categories.

A failure is a row, never an exception of the job."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

# Categories of failures that results carry, and what a message says of a passing fault.
INGESTION = ("ingestion_error", "invalid_url", "video_unavailable", "download_failure", "metadata_parse_failure", "file_write_failure", "collector_dependency_unavailable", "artifact_mismatch")
TRANSIENT_MARKERS = ("timeout", "timed out", "connection", "rate limit", "503", "429", "temporary")
#: Of media: no file, not decodable, no video in it, prober absent, detector absent, no frame.
PERCEPTION = ("media_not_found", "unreadable_media", "no_video_stream", "prober_unavailable", "detector_unavailable", "frame_extraction")


class Failure(Exception):
    """A failure with a category, and where it belongs the stage and details."""

    def __init__(self, message: str, category: str = "unexpected", stage: str | None = None, detail: dict | None = None):
        super().__init__(message)
        self.message, self.category, self.stage, self.detail = message, category, stage, detail or {}

    def to_dict(self) -> dict:
        return {"category": self.category, "message": self.message, "detail": self.detail}


class Transient(Failure):
    """A failure that may pass."""


@dataclass
class Outcome:
    value: object
    attempts: int
    succeeded: bool
    errors: list[str] = field(default_factory=list)
    error: Exception | None = None


@dataclass(frozen=True)
class Retry:
    """At most max_attempts, with a pause that grows by backoff_seconds; only failures that may pass are tried again. The last one is kept, not raised."""

    max_attempts: int = 3
    backoff_seconds: float = 1.0
    markers: tuple[str, ...] = TRANSIENT_MARKERS
    sleep: Callable[[float], None] = time.sleep

    def passing(self, e: Exception) -> bool:
        if isinstance(e, (Transient, TimeoutError, ConnectionError)):
            return True
        return not (isinstance(e, Failure) and e.category in INGESTION[:2]) and any(m in str(e).lower() for m in self.markers)

    def run(self, call: Callable[[], object]) -> Outcome:
        errors: list[str] = []
        for k in range(1, self.max_attempts + 1):
            try:
                return Outcome(call(), k, True, errors)
            except Exception as e:  # a row's failure is data
                errors.append(f"attempt {k}: {type(e).__name__}: {e}")
                if k == self.max_attempts or not self.passing(e):
                    return Outcome(None, k, False, errors, e)
                self.sleep(self.backoff_seconds * k)
        return Outcome(None, 0, False, errors)

    def to_dict(self) -> dict:
        return {"max_attempts": self.max_attempts, "backoff_seconds": self.backoff_seconds, "markers": list(self.markers)}


CALLED = "ok boolean, error_category string, error_message string, attempts int, errors array<string>"


def call_out(rows: DataFrame, function: Callable[[dict], dict], schema: str, retry: Retry = Retry(), unexpected: str | None = None) -> DataFrame:
    """`function` gets a row as a dict and returns a dict of `schema`; columns that it leaves out are the row's.

    Adds ok, error_category, error_message, attempts and errors. A function may
    return ok = False with a category of its own. Other exceptions than Failure
    have the category `unexpected`, or the name of their class. Rows of a lost
    executor are called again, so `function` should be idempotent; write the
    result before two others read it, or it is called twice."""
    names = [f.name for f in rows.sparkSession.createDataFrame([], schema).schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row in b.astype(object).where(b.notna(), None).to_dict("records"):
                done = retry.run(lambda row=row: function(row))
                got = done.value or {}
                ok = done.succeeded and bool(got.get("ok", True))
                error = done.error
                category = None if ok else (got.get("error_category") or "unknown") if error is None else error.category if isinstance(error, Failure) else unexpected or type(error).__name__
                message = None if ok else (got.get("error_message") or "") if error is None else str(error)
                out.append({n: got.get(n, row.get(n)) for n in names} | {"ok": ok, "error_category": category, "error_message": message, "attempts": done.attempts, "errors": done.errors})
            yield pd.DataFrame(out, columns=[*names, "ok", "error_category", "error_message", "attempts", "errors"], dtype=object)

    return rows.mapInPandas(run, f"{schema}, {CALLED}")


def failing_stage(stage: str) -> Callable[[dict], dict]:
    """A stage that isn't there: it fails for every video and says so."""

    def run(row: dict) -> dict:
        raise Failure(f"stage {stage} is not available, the run can't do without it", "stage_not_available", stage)

    return run


def first_of(collectors: list[tuple[str, Callable[[str], dict]]]) -> Callable[[str], tuple[dict, list[dict]]]:
    """Collectors in order, the first success counts: (result, attempts). A result without `content` is a download failure, and the next is tried.

    A collector is a name and a function of a url that returns a dict with
    video_id, payload, content and more, or raises Failure. If all fail, the last
    failure is raised, with all attempts in its detail."""

    def run(url: str) -> tuple[dict, list[dict]]:
        attempts: list[dict] = []
        last = Failure("all collectors failed", "ingestion_error")
        for name, collect in collectors:
            try:
                got = collect(url)
                if not got.get("content"):
                    raise Failure(f"collector {name} returned no media", "download_failure", detail={"collector": name, "url": url})
            except Failure as e:
                last = e
                attempts.append({"collector": name, "ok": False, "error_category": e.category, "error_message": e.message})
                continue
            attempts.append({"collector": name, "ok": True, "error_category": None, "error_message": None})
            return {**got, "collector_name": name}, attempts
        last.detail = {**last.detail, "attempts": attempts}
        raise last

    return run
