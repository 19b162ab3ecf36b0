"""Commit logs, the ledger of calls, and the least gap between calls, with writers at once, killed runs and clashes."""

import json
import os
import signal
import threading
import time
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cliplake.operators import cohort, ingest
from cliplake.plans import config, multistep, pilot
from cliplake.sources import calls, ledger, pacing, writers
from cliplake.sources.commits import Conflict, Table

SCHEMA = "video_id string, sha256 string, body string"
QUIET = calls.Retry(sleep=lambda t: None)


def told(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_batch_keeps_one_row_a_key_and_tells_the_others(spark, tmp_path):
    t = Table(spark, f"{tmp_path}/t", SCHEMA)
    assert t.read().count() == 0 and t.versions() == []
    rows = spark.createDataFrame([("a", "2", "late", 5), ("a", "1", "early", 9), ("a", "2", "late", 6), ("b", "7", "x", 1), ("b", "7", "x", 1), (None, "3", "x", 0), ("c", None, "x", 0)], f"{SCHEMA}, at int")
    assert told(t.add_once(rows, "video_id", "sha256", F.col("at"))) == [("a", "1", "artifact_mismatch"), ("a", "2", "new"), ("b", "7", "new")]
    assert told(t.read()) == [("a", "2", "late"), ("b", "7", "x")]
    more = spark.createDataFrame([("a", "2", "late"), ("b", "8", "y"), ("d", "1", "z")], SCHEMA)
    assert told(t.add_once(more, "video_id", "sha256")) == [("a", "2", "reused"), ("b", "8", "artifact_mismatch"), ("d", "1", "new")]
    assert told(t.add_once(more, "video_id", "sha256")) == [("a", "2", "reused"), ("b", "8", "artifact_mismatch"), ("d", "1", "reused")]
    assert t.versions() == [1, 2] and t.read(1).count() == 2 and t.read().count() == 3
    assert t.add_once(more.limit(0), "video_id", "sha256").count() == 0
    # the folder is plain Parquet beside the log, and holds nothing that isn't committed
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3


def test_two_writers_at_once_leave_one_row(spark, tmp_path):
    path, errors, outcomes = f"{tmp_path}/t", [], {}
    gate = threading.Barrier(2)

    def write(name):
        try:
            t = Table(spark, path, SCHEMA)
            real, first = t._publish, []

            def publish(version, entry):
                if not first:  # both have written their files and read the same version
                    first.append(1)
                    gate.wait(60)
                return real(version, entry)

            t._publish = publish
            rows = spark.createDataFrame([("shared", name, name), (f"own-{name}", "1", name)], SCHEMA)
            outcomes[name] = told(t.add_once(rows, "video_id", "sha256"))
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=write, args=(n,)) for n in ("x", "y")]
    [t.start() for t in threads]
    [t.join(120) for t in threads]
    assert not errors
    got = told(Table(spark, path, SCHEMA).read())
    assert [r[0] for r in got] == ["own-x", "own-y", "shared"]
    winner = got[2][1]
    loser = {"x": "y", "y": "x"}[winner]
    assert ("shared", winner, "new") in outcomes[winner] and ("shared", loser, "artifact_mismatch") in outcomes[loser]
    assert all((f"own-{n}", "1", "new") in outcomes[n] for n in "xy") and spark.read.parquet(path).count() == 3


def test_other_keys_don_t_conflict(spark, tmp_path):
    a, b = (Table(spark, f"{tmp_path}/t", SCHEMA) for _ in range(2))
    real, written = a._publish, []

    def publish(version, entry):
        if not written:
            written.append(entry["add"])
            b.add_once(spark.createDataFrame([("b", "1", "")], SCHEMA), "video_id", "sha256")
        return real(version, entry)

    a._publish = publish
    assert told(a.add_once(spark.createDataFrame([("a", "1", "")], SCHEMA), "video_id", "sha256")) == [("a", "1", "new")]
    assert a.versions() == [1, 2] and a.folders(2)[1:] == written[0]  # the files stand as they were written


def test_a_snapshot_is_replaced_as_a_whole(spark, tmp_path):
    t = Table(spark, f"{tmp_path}/t", "n int")
    for k in range(1, 45):  # beyond two checkpoints of the log
        if k % 9 == 0:
            assert t.replace(lambda k=k: spark.createDataFrame([(k,)], "n int")) == k
        else:
            assert t._commit(k, [t._write(spark.createDataFrame([(k,)], "n int"))[0]]) and not t._commit(k, [])
        if k in (8, 20, 44):
            assert [r[0] for r in told(t.read())] == list(range(k - k % 9 or 1, k + 1))
    asked = []

    def build():
        asked.append(1)
        if len(asked) < 3:
            Table(spark, f"{tmp_path}/t", "n int").replace(lambda: spark.createDataFrame([(100 + len(asked),)], "n int"))
        return t.read().select((F.col("n") + 1000).alias("n"))

    t.replace(build)
    assert len(asked) == 3 and told(t.read()) == [(1102,)]
    t._publish = lambda *a: False
    with pytest.raises(Conflict):
        t.replace(lambda: spark.createDataFrame([(1,)], "n int"), tries=2)


def test_ingest_of_two_urls_of_one_video(spark, tmp_path):
    mp4 = b"\x00\x00\x00\x18ftypmp42" + b"x" * 20

    def fetch(url):
        return {"video_id": "777777", "payload": "{}", "content": mp4 + url[-1].encode() if "other" in url else mp4}

    urls = ["https://v.example/other/9", "https://v.example/a/777777", "https://v.example/b/777777"]
    entries = spark.createDataFrame([(u, None) for u in urls], "url string, creator_handle string")
    got = {r["url"]: (r["ok"], r["error_category"]) for r in ingest.run(entries, [("one", fetch)], f"{tmp_path}/raw", ("v.example",), "https://v.example/video/%s", QUIET).collect()}
    assert got == {urls[0]: (False, "artifact_mismatch"), urls[1]: (True, None), urls[2]: (True, None)}
    assert bytes(spark.read.parquet(f"{tmp_path}/raw/media").collect()[0]["content"]) == mp4
    assert [r["source_url"] for r in spark.read.parquet(f"{tmp_path}/raw/manifests").collect()] == [urls[1]]


# ---- the ledger


def counter(folder):
    folder.mkdir(exist_ok=True)
    return (lambda name: (folder / uuid.uuid4().hex).write_text(name)), (lambda: Counter(p.read_text() for p in folder.iterdir()))


def test_a_killed_stage_goes_on_behind_its_last_batch(spark, tmp_path):
    note, seen = counter(tmp_path / "called")
    rows = spark.createDataFrame([(f"v{i:02}", {"k": str(i), "a": "b"}) for i in range(40)], "video_id string, facts map<string,string>")
    deadly = tmp_path / "deadly"
    deadly.write_text("")

    def stage(row):
        if deadly.exists() and sum(seen().values()) >= 20:
            os.kill(os.getpid(), signal.SIGKILL)  # the worker is gone in mid-stage
        note(row["video_id"])
        return {"latency_seconds": float(row["facts"]["k"])}

    go = lambda: ledger.call(rows, stage, "video_id string, latency_seconds double", f"{tmp_path}/ledger", "perception", batch_rows=5, retry=QUIET)
    with pytest.raises(Exception):
        go().count()
    kept = {r["_key"] for r in spark.read.parquet(f"{tmp_path}/ledger/stage=perception").collect()}
    before = seen()
    assert 10 <= len(kept) <= 20 and kept <= set(before)
    deadly.unlink()
    got = {r["video_id"]: r["latency_seconds"] for r in go().collect()}
    assert got == {f"v{i:02}": float(i) for i in range(40)}
    after = seen()
    assert set(after) == set(got) and all(after[k] == before[k] for k in kept) and set(after - before) == set(got) - kept
    go().count()
    assert seen() == after


def test_the_ledger_knows_stage_and_input(spark, tmp_path):
    note, seen = counter(tmp_path / "called")

    def stage(row):
        note(f"{row['video_id']}{row['n']}")
        if row["n"] == 3 and sum(seen().values()) < 6:
            return {"ok": False, "error_category": "model_provider"}
        return {"out": row["n"]}

    def go(rows, stage_name="a", **more):
        df = spark.createDataFrame(rows, "video_id string, n int")
        return told(ledger.call(df, stage, "video_id string, out int", f"{tmp_path}/l", stage_name, retry=QUIET, **more).select("video_id", "out", "ok"))

    assert go([("x", 1), ("x", 1), ("x", 2), ("y", 3), (None, 4)]) == sorted([("x", 1, True), ("x", 1, True), ("x", 2, True), ("y", None, False), (None, 4, True)], key=str)
    assert seen() == Counter(["x1", "x2", "y3", "None4"])
    go([("x", 1), ("x", 5)])  # another input of a video is another call
    assert seen()["x1"] == 1 and seen()["x5"] == 1
    assert go([("y", 3)]) == [("y", 3, True)]  # what failed is tried again
    go([("x", 1)], "b")
    go([("x", 1)], fresh=True)
    assert seen()["x1"] == 3
    assert go([]) == []


def test_a_killed_pilot_resumes(spark, tmp_path):
    (tmp_path / "s.csv").write_text("\n".join(["url,hashtags,views"] + [f"https://v.example/video/{100000 + k},x,{k}" for k in range(20)]) + "\n")
    note, seen = counter(tmp_path / "called")
    deadly = tmp_path / "deadly"
    deadly.write_text("")

    def first(row):
        note("1" + row["video_id"])
        return {"latency_seconds": 1.0, "facts": {"views": 7, "creator_id": "c"}}

    def second(row):
        if deadly.exists() and sum(k[0] == "2" for k in seen().elements()) >= 8:
            os.kill(os.getpid(), signal.SIGKILL)
        note("2" + row["video_id"])
        return {"latency_seconds": 1.0, "schema_valid": True}

    policy = cohort.Policy("c", "1", required_hashtags=("x",))
    go = lambda: pilot.run(spark, f"{tmp_path}/s.csv", policy, {"performance_snapshot": first, "project_canonical": second}, f"{tmp_path}/out", retry=QUIET, batch_rows=4).collect()[0]
    with pytest.raises(Exception):
        go()
    deadly.unlink()
    half = len({k for k in seen() if k[0] == "2"})
    x = go()
    assert (x["requested"], x["fully_processed"]) == (20, 20) and 0 < half < 20
    assert sum(c for k, c in seen().items() if k[0] == "1") == 20 and sum(c for k, c in seen().items() if k[0] == "2") <= 20 + 12


# ---- pacing


def test_calls_are_never_closer_than_the_gap(spark, tmp_path):
    (tmp_path / "at").mkdir()

    def model(row):
        (tmp_path / "at" / uuid.uuid4().hex).write_text(repr(time.time()))
        if row["n"] % 5 == 0:
            time.sleep(0.5)  # longer than a turn of all lanes
        if row["n"] == 7 and len(list((tmp_path / "at").iterdir())) < 12:
            raise calls.Transient("again")
        return {"n": row["n"]}

    gap = 0.08
    pace = pacing.Pace(gap, lanes=4, slack=0.02)
    rows = spark.range(24).select(F.col("id").cast("int").alias("n"))
    got = calls.call_out(pacing.lanes(rows, pace), pacing.paced(model, pace), "n int", QUIET)
    assert got.where("ok").count() == 24
    at = sorted(float(p.read_text()) for p in (tmp_path / "at").iterdir())
    assert len(at) >= 24 and min(b - a for a, b in zip(at, at[1:])) >= gap - 0.002
    assert at[-1] - at[0] < 24 * 0.5  # lanes work side by side


def test_slots_of_lanes_never_meet():
    pace = pacing.Pace(2.0, lanes=3, slack=0.5)
    seen = {}
    for lane in range(3):
        for now in (0.0, 0.4, 0.6, 2.5, 3.1, 7.49, 7.51, 1000.0, 1001.3):
            at = pace.slot(lane, now)
            assert now < at <= now + 7.5 and seen.setdefault(round(at / 2.5), lane) == lane and abs(at / 2.5 - round(at / 2.5)) < 1e-9
    pace = pacing.Pace(2.0, lanes=3, slack=0.5, clock=iter([10.1, 12.5]).__next__, sleep=(slept := []).append)
    pace.wait(2)
    assert slept == [pytest.approx(2.4)]
    pacing.Pace(0.0).wait(1)


def test_model_runs_resume_and_keep_the_gap(spark, tmp_path):
    note, seen = counter(tmp_path / "called")

    def model(parts, settings):
        note(next(p["path"] for p in parts if p["path"]) + f"@{time.time()}")
        return json.dumps({}), {"input_tokens": 1, "output_tokens": 1, "total_tokens": 2}

    videos = spark.createDataFrame([(n, n) for n in "abcdef"], "video_id string, path string").withColumn("source_metadata", F.parse_json(F.lit("{}")))
    settings = config.RunConfig(min_gap_seconds=0.1, lanes=3, ledger_batch=2)
    one = multistep.single_pass(videos, model, str(tmp_path / "o"), settings, run_id="r").count()
    two = multistep.single_pass(videos, model, str(tmp_path / "o"), settings, run_id="r").count()
    at = sorted(float(k.split("@")[1]) for k in seen())
    assert one == two == len(at) == 6 and min(b - a for a, b in zip(at, at[1:])) >= 0.099


def test_index_files_follow_the_rows(spark, tmp_path):
    rows = spark.range(100).select(F.format_string("%03d", "id").alias("video_id"))
    writers.write_index(rows, f"{tmp_path}/i", 4)
    files = [p for p in (tmp_path / "i").iterdir() if p.suffix == ".parquet"]
    assert len(files) == 4 and spark.read.parquet(f"{tmp_path}/i").count() == 100
    writers.write_index(rows.limit(0), f"{tmp_path}/e", 0)
    assert spark.read.parquet(f"{tmp_path}/e").columns == ["video_id"]
