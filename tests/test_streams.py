"""Keyed state, stream-stream joins and session windows, against batch results, over restarts and with late rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cliplake.operators import relational
from cliplake.streaming import joins, latest, snapshots

BEGIN = dt.datetime(2024, 1, 1)


def at(hours):
    return BEGIN + dt.timedelta(hours=hours)


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, latest.PROVIDER)
    yield spark
    spark.conf.set(key, before)


def put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def drain(stream, tmp, name, mode="append"):
    """All that is there now, as one more run of the query with this checkpoint."""
    q = stream.writeStream.format("parquet").option("path", f"{tmp}/{name}").option("checkpointLocation", f"{tmp}/{name}-at").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()


def test_latest_goes_on_after_a_restart_and_ignores_late_rows(rocks, tmp_path):
    spark, tmp = rocks, str(tmp_path)
    go = lambda: drain(latest.changes(snapshots.read(spark, f"{tmp}/in"), "1 hour", 86_400), tmp, "out")
    parts = [
        [("a", at(1), 10, 1), ("a", at(3), 15, 2), ("b", at(2), 5, None), (None, at(1), 1, 1), ("c", None, 1, 1)],
        [("a", at(2.5), 12, 1), ("a", at(5), 40, 4), ("a", at(5), 41, 4), ("b", at(4), None, 1)],
        [("b", at(6), 9, 1), ("a", at(1), 99, 9)],  # long past the watermark, and not newer
    ]
    for rows in parts:
        put(spark, f"{tmp}/in", rows, snapshots.SNAPSHOT)
        go()  # a query of its own each time, from the checkpoint
    hour = lambda micros: micros // 3_600_000_000 - int(BEGIN.replace(tzinfo=dt.UTC).timestamp()) // 3600
    got = [(r["video_id"], hour(r["observed"]), r["views"], r["seconds"], r["views_growth"]) for r in spark.read.parquet(f"{tmp}/out").collect()]
    assert sorted(got, key=lambda x: x[:2]) == [("a", 1, 10, None, None), ("a", 3, 15, 7200, 5), ("a", 5, 41, 7200, 26), ("b", 2, 5, None, None), ("b", 4, None, 7200, None), ("b", 6, 9, 7200, None)]
    table = spark.read.schema(snapshots.SNAPSHOT).parquet(f"{tmp}/in").where("video_id IN ('a', 'b')")
    batch = {r["video_id"]: r["views"] for r in relational.latest(table, "video_id", ["observed_at", "views"]).collect()}
    stream = spark.read.parquet(f"{tmp}/out").groupBy("video_id").agg(F.max_by("views", "observed").alias("views")).collect()
    assert {r["video_id"]: r["views"] for r in stream} == batch
    put(spark, f"{tmp}/in", [("z", at(500), 1, 1)], snapshots.SNAPSHOT)
    go()
    gone = spark.read.parquet(f"{tmp}/out").where("expired").collect()
    assert sorted((r["video_id"], r["views"]) for r in gone) == [("a", 41), ("b", 9)]
    put(spark, f"{tmp}/in", [("a", at(600), 50, 1)], snapshots.SNAPSHOT)
    go()
    back = spark.read.parquet(f"{tmp}/out").where("video_id = 'a' AND views = 50").collect()
    assert [(r["seconds"], r["views_growth"]) for r in back] == [(None, None)]  # forgotten, so first again


def test_features_meet_the_snapshot_before_them(spark, tmp_path):
    tmp, r = str(tmp_path), random.Random(1)
    features = [(f"v{r.randint(0, 9)}", at(r.uniform(0, 40)), f"f{k}") for k in range(60)] + [(None, at(1), "x"), ("v1", None, "y")]
    snaps = [(f"v{r.randint(0, 9)}", at(r.uniform(-50, 40)), r.randint(0, 99), 0) for k in range(150)] + [("v0", None, 1, 1)]
    features.sort(key=lambda x: x[1] or BEGIN)
    snaps.sort(key=lambda x: x[1] or BEGIN)

    def go():
        left = spark.readStream.schema(joins.FEATURES).parquet(f"{tmp}/f")
        drain(joins.latest_before(left, snapshots.read(spark, f"{tmp}/s"), "10 hours", "2 hours"), tmp, "out")

    for k in range(3):  # in order of time, but for what is up to two hours late
        put(spark, f"{tmp}/f", features[len(features) * k // 3 : len(features) * (k + 1) // 3], joins.FEATURES)
        put(spark, f"{tmp}/s", snaps[len(snaps) * k // 3 : len(snaps) * (k + 1) // 3], snapshots.SNAPSHOT)
        if k == 2:
            go()
    put(spark, f"{tmp}/f", [("end", at(900), "e")], joins.FEATURES)
    put(spark, f"{tmp}/s", [("end", at(900), 1, 1)], snapshots.SNAPSHOT)
    go()
    put(spark, f"{tmp}/f", [("end", at(901), "e")], joins.FEATURES)
    put(spark, f"{tmp}/s", [("end", at(901), 1, 1)], snapshots.SNAPSHOT)
    go()
    rows = lambda df: sorted((tuple(x) for x in df.where("video_id <> 'end'").collect()), key=str)
    want = joins.latest_before_batch(spark.read.schema(joins.FEATURES).parquet(f"{tmp}/f"), spark.read.schema(snapshots.SNAPSHOT).parquet(f"{tmp}/s"), "10 hours")
    got = rows(spark.read.parquet(f"{tmp}/out"))
    assert got == rows(want) and len(got) == 60
    assert 0 < sum(x[3] is None for x in got) < 60


def test_bursts(spark, tmp_path):
    tmp, r = str(tmp_path), random.Random(3)
    snaps = sorted(((f"v{r.randint(0, 3)}", at(r.uniform(0, 60)), r.randint(0, 99), 0) for _ in range(120)), key=lambda x: x[1])
    for k in range(2):
        put(spark, f"{tmp}/s", snaps[60 * k : 60 * k + 60], snapshots.SNAPSHOT)
        drain(joins.bursts(snapshots.read(spark, f"{tmp}/s")), tmp, "out")
    for h in (900, 901):
        put(spark, f"{tmp}/s", [("end", at(h), 1, 1)], snapshots.SNAPSHOT)
        drain(joins.bursts(snapshots.read(spark, f"{tmp}/s")), tmp, "out")
    rows = lambda df: sorted(tuple(x) for x in df.where("video_id <> 'end'").collect())
    got = rows(spark.read.parquet(f"{tmp}/out"))
    want = []
    for v in sorted({x[0] for x in snaps}):
        times = [(x[1], x[2]) for x in snaps if x[0] == v]
        run = [times[0]]
        for t in [*times[1:], (at(5000), 0)]:
            if t[0] - run[-1][0] >= dt.timedelta(minutes=30):
                want.append((v, run[0][0], run[-1][0] + dt.timedelta(minutes=30), len(run), min(n for _, n in run), max(n for _, n in run)))
                run = []
            run.append(t)
    assert got == want == rows(joins.bursts(spark.read.schema(snapshots.SNAPSHOT).parquet(f"{tmp}/s"))) and len(want) < 120
