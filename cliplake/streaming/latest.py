"""The latest snapshot of every video as keyed state: what has changed since the last one, and a timer that forgets.

A video's state is one row. A snapshot that is newer than the state replaces it and
is passed on with its growth; an older one, however late, changes nothing. A video
without a snapshot for the time to live is forgotten when the watermark says so."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: observed: when; seconds and views_growth: since the snapshot before, null for the first; expired: the state is gone.
CHANGE = "video_id string, observed bigint, views bigint, likes bigint, seconds bigint, views_growth bigint, expired boolean"
#: Where the state is kept.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Latest(StatefulProcessor):
    """Times are microseconds since 1970; ttl_seconds is counted from a video's latest snapshot."""

    def __init__(self, ttl_seconds: int):
        self.ttl = ttl_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("latest", "observed bigint, views bigint, likes bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = self.state.get() if self.state.exists() else None
        first = last
        out = []
        # a key's rows of one batch come in any order, and are as many as a trigger lets in
        here = [_plain(r) for b in rows for r in b[["observed", "views", "likes"]].itertuples(index=False)]
        for observed, views, likes in sorted(here, key=lambda r: (r[0], *(1 if x is None else -x for x in r[1:]))):
            if last is not None and observed <= last[0]:
                continue
            seconds = None if last is None else (observed - last[0]) // 1_000_000
            growth = None if last is None or views is None or last[1] is None else views - last[1]
            out.append((key[0], observed, views, likes, seconds, growth, False))
            last = (observed, views, likes)
        if last is not first:
            self.state.update(last)
            for t in self.handle.listTimers():
                self.handle.deleteTimer(t)
            self.handle.registerTimer(last[0] // 1000 + self.ttl * 1000)
        yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        observed, views, likes = self.state.get()
        self.state.clear()
        yield _frame([(key[0], observed, views, likes, None, None, True)])

    def close(self) -> None:
        pass


def _plain(row) -> tuple:
    return tuple(None if pd.isna(x) else int(x) for x in row)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in CHANGE.split(", ")]
    frame = pd.DataFrame(rows, columns=names)
    kinds = {n: "Int64" for n in ("observed", "views", "likes", "seconds", "views_growth")}
    return frame.astype(kinds | {"video_id": "object", "expired": "bool"})


def changes(snapshots: DataFrame, delay: str = "1 day", ttl_seconds: int = 30 * 86_400) -> DataFrame:
    """CHANGE rows of a stream of snapshots (video_id, observed_at, views, likes), each once.

    Of snapshots of one time in a batch the one with most views counts, then most
    likes; rows without video_id or observed_at are left out. The session must keep state
    in PROVIDER."""
    rows = snapshots.where("video_id IS NOT NULL AND observed_at IS NOT NULL").withWatermark("observed_at", delay)
    rows = rows.select("video_id", "observed_at", F.unix_micros("observed_at").alias("observed"), "views", "likes")
    return rows.groupBy("video_id").transformWithStateInPandas(statefulProcessor=Latest(ttl_seconds), outputStructType=CHANGE, outputMode="append", timeMode="eventTime")
