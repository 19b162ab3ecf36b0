"""States of run metrics that merge, and record folders as a data source."""

import json
import random

import pytest
from pyspark.sql import functions as F

from cliplake.operators import states
from cliplake.sources import folders


def test_merged_states_equal_a_full_pass(spark, tmp_path):
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None]), r.choice(["m", "n"]), f"2024-01-0{r.randint(1, 3)}", r.choice(["success", "success", "failed"]), r.random() < 0.9, None if r.random() < 0.1 else r.lognormvariate(3, 1), None) for _ in range(20_000)]
    records = spark.createDataFrame(rows, "cohort_id string, model_id string, day string, status string, schema_valid boolean, total_latency_seconds double, total_usage_cost_usd double")
    for part in records.randomSplit([0.3, 0.5, 0.2], 1):  # a day's states come in several parts
        states.store(states.partial(part), f"{tmp_path}/s")
    kept = spark.read.parquet(f"{tmp_path}/s")
    got = states.metrics(states.merged(kept)).collect()
    assert len(got) == len({(c, m, d) for c, m, d, *_ in rows}) + 9 + 6 + 6 + 3 + 2 + 3 + 1
    for x in got:
        level = [d for d in x["level"].split(",") if d]
        here = [y for y in rows if all(y[states.DIMENSIONS.index(d)] == x[d] for d in level)]
        known = sorted(y[5] for y in here if y[5] is not None)
        good = sum(y[3] == "success" for y in here)
        assert (x["n"], x["successes"], x["latency_n"]) == (len(here), good, len(known))
        assert x["valid"] == sum(y[3] == "success" and y[4] for y in here) and x["success_rate"] == pytest.approx(good / len(here))
        assert x["latency_mean"] == pytest.approx(sum(known) / len(known)) and x["cost_p50"] is None and x["cost_mean"] is None
        for p, v in ((0.5, x["latency_p50"]), (0.95, x["latency_p95"])):
            assert abs(sum(k <= v for k in known) / len(known) - p) < 0.03, (level, p)
    total = states.metrics(states.merged(kept, [(), ("day",)])).collect()
    assert sorted(x["level"] for x in total) == ["", "day", "day", "day"] and sum(x["n"] for x in total) == 40_000
    assert states.partial(records.limit(0)).count() == 0


@pytest.fixture
def source(spark):
    spark.dataSource.register(folders.RecordFolders)
    return spark


def write(rows, path):
    rows.write.format("record_folders").mode("append").save(path)


def test_round_trip(source, tmp_path):
    spark, path = source, str(tmp_path / "records")
    rows = [(f"v{k:03}", a, json.dumps({"k": k, "text": "zwölf\n"}, ensure_ascii=False)) for k in range(30) for a in ("manifest.json", "shots.json")]
    write(spark.createDataFrame(rows + [("v000", "empty.txt", ""), ("v000", "none.txt", None)], folders.SCHEMA).repartition(5), path)
    load = lambda **o: spark.read.format("record_folders").options(**o).load(path)
    got = load(per_partition="7")
    assert got.rdd.getNumPartitions() == 5 and sorted(map(tuple, got.collect())) == sorted(rows + [("v000", "empty.txt", "")])
    assert {r["artifact"] for r in load(artifacts="shots.json,none.txt").collect()} == {"shots.json"}
    assert (tmp_path / "records/v007/manifest.json").read_text() == rows[14][2]
    assert not any((tmp_path / "records/_staging").iterdir())
    parsed = load(artifacts="manifest.json").select(F.get_json_object("content", "$.k").cast("int").alias("k"))
    assert sorted(r["k"] for r in parsed.collect()) == list(range(30))
    assert spark.read.format("record_folders").load(str(tmp_path / "nothing")).count() == 0


def test_artifacts_are_copied_if_absent_and_clashes_told(source, tmp_path):
    spark, path = source, str(tmp_path / "r")
    write(spark.createDataFrame([("a", "x.json", "1"), ("a", "y.json", "2")], folders.SCHEMA), path)
    again = [("a", "x.json", "other"), ("a", "y.json", "2"), ("b", "x.json", "n"), ("b", "x.json", "m"), ("b", "z", "q"), ("b", "z", "q")]
    write(spark.createDataFrame(again, folders.SCHEMA).repartition(3), path)
    got = {(r["video_id"], r["artifact"]): r["content"] for r in spark.read.format("record_folders").load(path).collect()}
    assert got == {("a", "x.json"): "1", ("a", "y.json"): "2", ("b", "x.json"): "m", ("b", "z"): "q"}
    told = [json.loads(p.read_text()) for p in (tmp_path / "r/_mismatches").iterdir()]
    assert told == [{"category": "artifact_mismatch", "artifacts": ["a/x.json", "b/x.json"]}]
    with pytest.raises(Exception, match="never overwritten"):
        spark.createDataFrame(again, folders.SCHEMA).write.format("record_folders").mode("overwrite").save(path)


def test_an_aborted_write_leaves_nothing(source, tmp_path):
    spark, path = source, str(tmp_path / "r")
    write(spark.createDataFrame([("a", "x", "1")], folders.SCHEMA), path)
    bad = spark.range(40).select(F.format_string("v%02d", "id").alias("video_id"), F.lit("x").alias("artifact"), F.when(F.col("id") == 33, F.raise_error(F.lit("broken row")).cast("string")).otherwise("1").alias("content")).repartition(4)
    with pytest.raises(Exception, match="broken row"):
        write(bad, path)
    with pytest.raises(Exception, match="no name of a record"):
        write(spark.createDataFrame([("ok", "x", "1"), ("..", "x", "1")], folders.SCHEMA), path)
    assert sorted(p.name for p in (tmp_path / "r").iterdir() if p.name != "_staging") == ["a"] and not any((tmp_path / "r/_staging").iterdir())
