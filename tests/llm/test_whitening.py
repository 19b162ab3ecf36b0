"""Whitening against numpy and on odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cliplake.llm import whitening as w


def frame(spark, rows, kind="array<float>"):
    return spark.createDataFrame(rows, f"vec_id long, embedding {kind}").withColumns({c: F.lit("x") for c in ("key", "vector", "n", "label")})


def brute(rows, scale=1024, offset=100000):
    x = np.array([[int(np.floor(scale * float(np.float32(c)))) + offset for c in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = ((n * x - s) ** 2).sum(axis=1)
    centred = np.array([[float(a * n - b) / n for a, b in zip(r, s)] for r in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    return n, deviation, centred, e, u


def test_matches_numpy(spark):
    r = random.Random(5)
    # the spread falls from dimension to dimension, so that components are far apart
    rows = [(i, [r.gauss(0.3, 1.0) / (k + 1) for k in range(12)]) for i in range(400)] + [(1000, [0.25] * 12)] * 150
    got = w.digest(w.whiten(frame(spark, rows).repartition(7))).collect()
    assert len(got) == 8 * len(rows)
    n, deviation, centred, e, u = brute(rows)
    at = {i: k for k, (i, _) in enumerate(rows)}
    white = centred @ u[:, :8] / np.sqrt(e[:8])
    sign = {}
    for x in got:
        k, c = at[x["vec_id"]], x["component"] - 1
        assert (x["n"], x["deviation"]) == (n, deviation[k])
        assert abs(x["explained"] / (e[c] / e.sum()) - 1) < 1e-9 and x["identity_error"] < 1e-9
        if abs(white[k, c]) > 0.1:
            assert sign.setdefault(c, np.sign(x["whitened"] * white[k, c])) == np.sign(x["whitened"] * white[k, c])
        assert abs(abs(x["whitened"]) - abs(white[k, c])) < 1e-8


def test_any_cut_into_states_merges_to_the_same():
    r = np.random.default_rng(3)
    x = np.floor(1024 * r.normal(size=(999, 5))).astype(np.int64) + 100_000
    x[:400] = x[0]
    whole = w.State.of(x)
    for cuts in ([1, 2, 3], [400, 700], list(range(1, 999))):
        parts = [w.State.of(p) for p in np.split(x, cuts)]
        while len(parts) > 1:
            parts = [parts[0].merge(w._none(5)).merge(parts[-1])] + parts[1:-1]
        assert parts[0].n == 999 and parts[0].sums == x.sum(axis=0).tolist()
        assert np.allclose(parts[0].scatter, whole.scatter, rtol=1e-11) and np.allclose(parts[0].mean, whole.mean, rtol=1e-14)
    assert np.allclose(whole.scatter, np.cov(x.T, bias=True) * 999, rtol=1e-11)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0]), (2, [0.25, -1.0]), (2, [0.25, -1.0]), (None, [0.0, 0.125])]
    bad = [(5, None), (6, [None, 1.0]), (7, [nan, 1.0]), (8, [1.0, -inf]), (9, []), (10, [1.0, 2.0, 3.0]), (None, None)]
    got = w.digest(w.whiten(frame(spark, good + bad))).collect()
    assert len(got) == 8 and {x["component"] for x in got} == {1, 2} and {x["n"] for x in got} == {4}
    _, deviation, *_ = brute(good)
    assert {(x["vec_id"], x["deviation"]) for x in got} == {(i, deviation[k]) for k, (i, _) in enumerate(good)}
    assert w.whiten(frame(spark, [])).count() == 0 and w.whiten(frame(spark, bad[:4])).count() == 0 and w.whiten(frame(spark, [(1, []), (2, [])])).count() == 0


@pytest.mark.parametrize("rows", [[(1, [0.5, 0.5, 1.0])], [(i, [i / 4, 0.5, i / 2]) for i in range(9)]])
def test_directions_without_variance(spark, rows):
    got = w.whiten(frame(spark, rows)).collect()
    live = 1 if len(rows) > 1 else 0
    assert len(got) == 3 * len(rows)
    for x in got:
        assert (x["whitened"] is not None) == (x["component"] <= live) and x["identity_error"] < 1e-9
        assert abs(x["explained"] - (x["component"] == 1 and live)) < 1e-9


def test_large_and_long_vectors(spark):
    r = random.Random(6)
    rows = [(i, [r.choice([-1e30, 3e7, -5e8, 0.1]) for _ in range(3)]) for i in range(40)]
    got = {x["vec_id"]: x["deviation"] for x in w.whiten(frame(spark, rows)).collect()}
    x = np.array([[max(-(2**42), min(2**42, int(np.floor(1024 * float(np.float32(c)))) + 100000)) for c in v] for _, v in rows], dtype=object)
    assert [int(got[i]) for i, _ in rows] == ((40 * x - x.sum(axis=0)) ** 2).sum(axis=1).tolist()
    assert all(d is None for d in {x["deviation"] for x in w.digest(w.whiten(frame(spark, rows))).collect()} if d is None or d < 0)
    wide = frame(spark, [(i, [r.random() for _ in range(1500)]) for i in range(12)])
    assert w.whiten(wide, components=3).where("identity_error < 1e-6 AND whitened IS NOT NULL").count() == 36
