"""Groups of any size in order: matches, cuts, and near-duplicate media, against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cliplake.functions import arrays as A
from cliplake.operators import matching, neighbours, perception, relational, scenes, series


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("tolerance", [0.0, 0.3, 2.0])
def test_matches_equal_the_array_form(spark, tolerance):
    r = random.Random(int(10 * tolerance))
    d, a = [], []
    for k in range(60):
        grain = r.choice([0.1, 0.5, 1])
        d += [(k if k else None, float(r.randint(-40, 60) * grain)) for _ in range(r.randint(0, 30))]
        a += [(k if k else None, float(r.randint(-40, 60) * grain)) for _ in range(r.randint(0, 30))]
    d += [(5, None), (70, None)]
    df, af = (spark.createDataFrame(x, "video_id int, at double") for x in (d, a))
    got = rows_of(matching.matches(df, af, "video_id", "at", tolerance))
    arrays = df.withColumn("k", F.lit("d")).unionByName(af.withColumn("k", F.lit("a"))).groupBy("video_id").agg(*[F.collect_list(F.when(F.col("k") == k, F.col("at"))).alias(k) for k in "da"])
    pairs = arrays.select("video_id", F.explode(A.greedy_matches(F.col("d"), F.col("a"), tolerance)).alias("p")).select("video_id", "p.d", "p.a")
    assert got == rows_of(pairs) and len(got) > 30
    want = {x["video_id"]: x.asDict() for x in relational.boundary_evaluation(arrays, "video_id", "d", "a", tolerance).collect()}
    seen = {x["video_id"]: x.asDict() for x in matching.evaluation(df, af, "video_id", "at", tolerance).collect()}
    assert seen.keys() == want.keys() and all(seen[k] == pytest.approx(want[k]) for k in want)


def test_worked_example_of_matches(spark):
    d = spark.createDataFrame([("v", 0.85), ("v", 1.7), ("v", 2.4)], "video_id string, at double")
    a = spark.createDataFrame([("v", 0.8), ("v", 1.6)], "video_id string, at double")
    x = matching.evaluation(d, a, "video_id", "at", 0.3).collect()[0]
    assert (x["true_positives"], x["false_positives"], x["missed"]) == (2, 1, 0) and x["precision"] == pytest.approx(2 / 3) and x["median_error"] == pytest.approx(0.075)
    assert matching.matches(d, a.limit(0), "video_id", "at", 0.3).count() == 0


def test_one_video_of_very_many_cuts(spark):
    """A third of the points touch each other in one long run, and a task never holds more than those in reach."""
    n = 300_000
    d = spark.range(n).select(F.lit("v").alias("video_id"), (F.col("id") * 1.0 + F.when(F.col("id") % 3 == 0, 0.25).otherwise(0.0)).alias("at"))
    a = spark.range(n).select(F.lit("v").alias("video_id"), (F.col("id") * 1.0).alias("at"))
    got = matching.matches(d, a, "video_id", "at", 0.3)
    assert got.count() == n and got.where("abs(detected - annotated) > 0.26").count() == 0
    chained = matching.matches(d, a, "video_id", "at", 0.8)  # the whole video is one run
    assert chained.count() == n
    cut = series.runs(a, "video_id", "at", 0.8, 1000.0)
    assert cut.select("run").distinct().count() == n and series.runs(a, "video_id", "at", 1.0, 1000.0).select("run").distinct().count() == 1


def test_lag_and_runs_don_t_depend_on_the_stretch(spark):
    r = random.Random(3)
    points = sorted({(r.choice("xyz"), r.randint(-500, 3000)) for _ in range(400)})
    rows = spark.createDataFrame([(k, t, t * 2) for k, t in points] + [(None, 5, 1)], "k string, t int, v int")
    want, begun = {}, {}
    for i, (k, t) in enumerate(points):
        before = points[i - 1] if i and points[i - 1][0] == k else None
        want[k, t] = before[1] * 2 if before else None
        begun[k, t] = begun[before] if before and t - before[1] <= 9 else t
    for stretch in (1.0, 7.0, 100.0, 1e6):
        got = series.lagged(rows, "k", "t", ["v"], stretch).where("k IS NOT NULL").collect()
        assert {(x["k"], x["t"]): x["prev_v"] for x in got} == want
        got = series.runs(rows, "k", "t", 9, stretch).where("k IS NOT NULL").collect()
        assert {(x["k"], x["t"]): x["run"] for x in got} == begun


def slow_cuts(frames, threshold, least):
    out, last = [], None
    for i, (n, *f) in enumerate(frames):
        if i == 0:
            last = n
            continue
        score = sum(abs(a - b) for a, b in zip(f, frames[i - 1][1:])) / 3
        if score >= threshold and n - last >= least:
            out.append(n)
            last = n
    return out


def test_cuts_match_brute_force(spark):
    r = random.Random(8)
    videos = {}
    for v in range(25):
        scene, frames = [100.0, 100.0, 100.0], []
        for n in range(r.choice([1, 2, 40, 700])):
            if r.random() < 0.2:
                scene = [r.uniform(0, 255) for _ in range(3)]
            frames.append((n + v, *[c + r.uniform(-1, 1) for c in scene]))
        videos[f"v{v}"] = frames
    features = spark.createDataFrame([(v, *f) for v, frames in videos.items() for f in frames], "video_id string, frame int, hue double, saturation double, luma double")
    for threshold, least in ((27.0, 15), (27.0, 1), (5.0, 3)):
        got = {}
        for v, n in rows_of(scenes.cuts(features, perception.Detector(threshold=threshold, min_scene_length=least))):
            got.setdefault(v, []).append(n)
        assert {v: sorted(x) for v, x in got.items()} == {v: x for v, f in videos.items() if (x := slow_cuts(f, threshold, least))}
    scenes.STRETCH, before = 16, scenes.STRETCH
    try:
        assert rows_of(scenes.cuts(features)) == sorted(((v, n) for v, f in videos.items() for n in slow_cuts(f, 27.0, 15)), key=str)
    finally:
        scenes.STRETCH = before


def test_worked_example_of_cuts(spark):
    """Three scenes at 30 frames a second, which change at 0.8 and 1.6 s."""
    luma = [20.0] * 24 + [180.0] * 24 + [60.0] * 24
    features = spark.createDataFrame([("v", n, 0.0, 0.0, y) for n, y in enumerate(luma)] + [("still", n, 1.0, 1.0, 1.0) for n in range(30)], "video_id string, frame int, hue double, saturation double, luma double")
    facts = spark.createDataFrame([("v", 2.4, 30.0), ("still", 1.0, 30.0)], "video_id string, duration_seconds double, fps double")
    got = rows_of(perception.shots(scenes.detect(features, facts), facts))
    assert got == [("still", "shot_001", 0.0, 1.0, 0, 30), ("v", "shot_001", 0.0, 0.8, 0, 24), ("v", "shot_002", 0.8, 1.6, 24, 48), ("v", "shot_003", 1.6, 2.4, 48, 72)]
    assert scenes.cuts(features.limit(0)).count() == 0


def test_near_duplicates_and_their_recall(spark):
    r = random.Random(2)
    base = [[r.gauss(0, 1) for _ in range(32)] for _ in range(800)]
    rows = [(i, v) for i, v in enumerate(base)]
    rows += [(1000 + i, [x + r.gauss(0, 0.3) for x in base[i % 800]]) for i in range(1200)]  # many just above and below the threshold
    rows += [(5000 + i, base[7]) for i in range(300)] + [(None, base[3]), (9001, None), (9002, [0.0] * 32), (9003, [float("nan")] * 32), (9004, []), (9005, base[7][:31]), (9006, [None, *base[7][1:]])]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    pairs = neighbours.near_pairs(df, "vec_id", "embedding", 0.95)
    got = {(x["a"], x["b"]) for x in pairs.collect()}
    ids = [i for i, _ in rows if i is not None and i < 5000]
    x = np.array([v for i, v in rows if i is not None and i < 5000])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    brute = {(ids[i], ids[j]) for i, j in zip(*np.nonzero(np.triu(x @ x.T >= 0.95, 1)))}
    assert len(brute) > 500 and got <= brute and len(brute - got) <= 0.01 * len(brute)
    x = neighbours.measured_recall(pairs, df, "vec_id", "embedding", 0.95, every=10).collect()[0]
    assert x["expected"] > 50 and x["recall"] >= 0.98
    few = neighbours.measured_recall(neighbours.near_pairs(df, "vec_id", "embedding", 0.95, recall=0.3), df, "vec_id", "embedding", 0.95, every=10).collect()[0]
    assert few["recall"] < x["recall"]
    copies = neighbours.members(df, "vec_id", "embedding")
    assert {x["vec_id"] for x in copies.where("class_id = 7").collect()} == {7} | {5000 + i for i in range(300)} and copies.where("vec_id > 9000").count() == 1
    assert neighbours.near_pairs(df.limit(0), "vec_id", "embedding", 0.9).count() == 0


def test_copies_have_their_pairs(spark, tmp_path):
    """Rows that are equal, and rows whose coarse copies are, against the SQL."""
    import duckdb

    from cliplake.plans import catalogue

    r = random.Random(8)
    base = [[r.gauss(0, 1) for _ in range(16)] for _ in range(30)]
    rows = [(i, base[i % 30] if i < 60 else [round(x * 8) / 8 + r.uniform(-0.02, 0.02) for x in base[i % 30]]) for i in range(150)] + [(200, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = con.execute(catalogue.oracle_sql()["near_duplicate_media"]).fetchall()
    got = [tuple(x) for x in catalogue.queries()["near_duplicate_media"](spark, str(tmp_path)).select("a", "b", "cosine").collect()]
    assert sum(x[2] == 1 for x in want) > 30 and sorted(got) == sorted(want)


def test_all_pairs_in_blocks(spark, monkeypatch):
    """Blocks of few vectors, more copies than an entry holds, lengths, and keys that are texts."""
    r = random.Random(4)
    base = [[r.gauss(0, 1) for _ in range(24)] for _ in range(200)]
    rows = [(f"k{i:03d}", v) for i, v in enumerate(base)] + [(f"m{i:03d}", [x + r.gauss(0, 0.3) for x in base[i % 200]]) for i in range(300)]
    rows += [(f"c{i:03d}", [1e200 * x for x in base[7]] if i % 2 else base[7]) for i in range(40)] + [(f"s{i}", base[9][:23]) for i in range(3)]
    odd = [(None, base[3]), ("o1", None), ("o2", [0.0] * 24), ("o3", [float("nan")] * 24), ("o4", []), ("o5", [None, *base[7][1:]]), ("k000", [2 * x for x in base[0]])]
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 10_000)
    monkeypatch.setattr(neighbours, "COPIES", 3)
    got = neighbours.all_pairs(spark.createDataFrame(rows + odd, "id string, v array<double>"), "id", "v", 0.95).collect()
    brute = {}
    for n in (23, 24):
        ids, x = zip(*[(i, np.array(v) / max(map(abs, v))) for i, v in [*rows, *odd[-1:]] if len(v) == n])
        u = np.array(x) / np.linalg.norm(x, axis=1, keepdims=True)
        g = u @ u.T
        for i, j in zip(*np.nonzero(np.triu(g >= 0.95, 1))):
            if ids[i] != ids[j]:
                brute.setdefault((min(ids[i], ids[j]), max(ids[i], ids[j])), []).append(g[i, j])
    assert sum(map(len, brute.values())) == len(got) > 1000 and {(x["a"], x["b"]) for x in got} == set(brute)
    assert all(abs(x["cosine"] - brute[x["a"], x["b"]][0]) < 1e-9 for x in got)
    assert neighbours.all_pairs(spark.createDataFrame([], "id string, v array<double>"), "id", "v", 0.95).count() == 0


def test_cosines_are_found_across_tiles():
    r = np.random.default_rng(3)
    x = r.normal(size=(2_500, 4))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for y, same in ((x, True), (x[:2_100], False)):
        got = [z for p, q, _ in neighbours._met(x, y, same, 0.99) for z in zip(p.tolist(), q.tolist())]
        g = u @ u[: len(y)].T >= 0.99
        want = {*zip(*(z.tolist() for z in np.nonzero(np.triu(g, 1) if same else g)))}
        assert len(got) == len(want) > 1_000 and set(got) == want


@pytest.mark.parametrize("groups", [3, 700])
def test_the_bound_of_few_coordinates_loses_no_pair(groups):
    """Few pairs, so that the bound holds on, and many, so that all coordinates are taken; cosines on either side of the threshold."""
    r = np.random.default_rng(groups)
    x = r.normal(size=(groups, 64))[np.arange(1_500) % groups] + r.normal(size=(1_500, 64)) * r.uniform(0, 0.6, size=(1_500, 1))
    assert neighbours._short(64, 0.9) < 0.6 * 64 < neighbours._short(64, 0.5)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for y, same in ((x, True), (x[:1_100], False)):
        got = [z for p, q, _ in neighbours._met(x, y, same, 0.9) for z in zip(p.tolist(), q.tolist())]
        g = u @ u[: len(y)].T >= 0.9
        want = {*zip(*(z.tolist() for z in np.nonzero(np.triu(g, 1) if same else g)))}
        assert len(got) == len(want) > 300 and set(got) == want


def test_near_duplicate_media_shuffles_vectors_only(spark):
    """Not each vector once a table, nor pairs that only met by chance."""
    from cliplake.plans import catalogue

    def shuffled():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        jvm, store = spark.sparkContext._jvm, spark.sparkContext._jsc.sc().statusStore()
        stages = store.stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = shuffled()
    assert catalogue.queries()["near_duplicate_media"](spark, "/root/testdata/sf0.001").count() == 500
    assert 0 < shuffled() - before < 4 * 2 * 500 * 64 * 4


def test_tables_follow_threshold_and_recall():
    assert neighbours.tables(1.0, 0.999, 12) == 1
    for t, recall, bits in ((0.9, 0.99, 8), (0.8, 0.9, 12)):
        n = neighbours.tables(t, recall, bits)
        p = (1 - math.acos(t) / math.pi) ** bits
        assert 1 - (1 - p) ** n >= recall > 1 - (1 - p) ** (n - 1)


def test_the_message_on_duplicates_is_bounded(spark):
    rows = spark.range(60).select(F.format_string("u%02d", F.col("id") % 30).alias("url"))
    with pytest.raises(ValueError, match="duplicates of url: u00, u01, .*u19 and 10 more$"):
        relational.refuse_duplicates(rows, "url")
    with pytest.raises(ValueError, match="duplicates of url: u01$"):
        relational.refuse_duplicates(rows.where("url = 'u01'"), "url")
    assert relational.refuse_duplicates(rows.distinct(), "url").count() == 30
