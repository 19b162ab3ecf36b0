"""Embedding whitening by Chan merging.

Each partition reads its vectors once and keeps a count, exact sums, the local
mean and the centred scatter matrix; two such states merge by the pairwise formula
(the scatter grows by the outer product of the difference of the means, weighted
n_a n_b / (n_a + n_b)), in treeReduce. The covariance, of a few KB, is decomposed
on the driver by eigh. A second pass over the vectors whitens them and merges the
states of what came out in the same way: their covariance must be the identity.
Vectors are centred before anything is multiplied, and entries are whole numbers,
so that the large offset that all of them share costs no digits.

Scale: nothing is shuffled but the states, d + d * d numbers each, and no key
deals the rows, so that no vector or label can be hot. A lost executor costs the
reading of its own input again.
"""

from __future__ import annotations

import decimal
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Entries are held within +-2^42, so that the sums of a batch fit in 64 bits.
MOST = 2**42
#: Levels of the tree that merges the partitions' states.
DEPTH = 3
#: Eigenvalues below this share of the largest, for each dimension, are no more than rounding.
ROUNDING = 1e-14


@dataclass
class State:
    """Moments of n vectors: sums (exact, of whole entries only), mean, scatter around the mean."""

    n: int
    sums: list[int]
    mean: np.ndarray
    scatter: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> State:
        mean = x.mean(axis=0)
        centred = x - mean
        rest = centred.mean(axis=0)  # what rounding left in the mean
        sums = x.sum(axis=0).tolist() if x.dtype == np.int64 else [0] * x.shape[1]
        return State(len(x), sums, mean + rest, centred.T @ centred - len(x) * np.outer(rest, rest))

    def merge(self, other: State) -> State:
        """Both together, by the pairwise formula."""
        if not self.n or not other.n:
            return self if self.n else other
        n = self.n + other.n
        d = other.mean - self.mean
        return State(n, [a + b for a, b in zip(self.sums, other.sums)], self.mean + d * (other.n / n), self.scatter + other.scatter + np.outer(d, d) * (self.n * other.n / n))


def _none(dims: int) -> State:
    return State(0, [0] * dims, np.zeros(dims), np.zeros((dims, dims)))


def _matrix(column: pa.Array, dims: int, scale: int, offset: int) -> np.ndarray:
    """A batch of vectors as whole numbers, one a row."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(scale * flat) + offset, -MOST, MOST).astype(np.int64).reshape(-1, dims)


def moments(rows: DataFrame, dims: int, matrix: Callable[[pa.Array], np.ndarray], depth: int = DEPTH) -> State:
    """The state of all vectors in the one column of rows: one a partition, merged in a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _none(dims)
        for b in batches:
            if b.num_rows:
                state = state.merge(State.of(matrix(b.column(0))))
        fields = [pa.array([state.n], pa.int64()), pa.array([[str(s) for s in state.sums]], pa.list_(pa.string())), pa.array([state.mean.tobytes()], pa.binary()), pa.array([state.scatter.tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(fields, names=["n", "sums", "mean", "scatter"])

    states = rows.mapInArrow(run, "n long, sums array<string>, mean binary, scatter binary").rdd
    if not states.getNumPartitions():  # the planner knows that there are no rows
        return _none(dims)
    return states.map(lambda r: State(r[0], [int(s) for s in r[1]], np.frombuffer(r[2]), np.frombuffer(r[3]).reshape(dims, dims))).treeReduce(State.merge, depth)


@dataclass
class Whitening:
    """What is learned: n, sums, eigenvalues (falling) and, as columns, unit eigenvectors; shares of the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray


def usable(table: DataFrame, key: str, column: str, dims: int | None = None) -> tuple[DataFrame, int]:
    """key and vector (not empty, no null, NaN or infinity in it), and the vectors' length: by default the most frequent one, the longest of equals."""
    vector = table[column]
    rows = table.select(table[key].alias("key"), vector.alias("vector"))
    v = F.col("vector")
    # a comparison with null is null, and NaN is above every number
    rows = rows.where((F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))))
    if dims is None:
        found = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
        dims = found[0]["d"] if found else 0
    return rows.where(F.size("vector") == dims), dims


def fit(rows: DataFrame, dims: int, scale: int = SCALE, offset: int = OFFSET) -> Whitening:
    """First pass: the covariance of all rows of usable(), decomposed."""
    state = moments(rows.select("vector"), dims, lambda c: _matrix(c, dims, scale, offset))
    if not state.n:
        return Whitening(0, state.sums, np.zeros(0), np.zeros((dims, 0)), np.zeros(0))
    cov = state.scatter / state.n
    cov = (cov + cov.T) / 2
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    values = np.where(values > ROUNDING * dims * values[0], values, 0.0)
    trace = float(np.trace(cov))
    return Whitening(state.n, state.sums, values, vectors, values / trace if trace > 0 else np.zeros(dims))


def _deviations(x: np.ndarray, w: Whitening) -> pa.Array:
    """Sum over the dimensions of (n * x - S)^2, exactly; null if it has more than 38 digits."""
    whole = np.array([s // w.n for s in w.sums], np.int64)
    if w.n * (int(np.abs(x - whole).max()) + 1) < 2**47 and x.shape[1] < 2**14:
        # in parts of 24 bits, whose products and sums fit in 64
        high, low = np.divmod(w.n * (x - whole) - np.array([s % w.n for s in w.sums], np.int64), 2**24)
        parts = zip((high * high).sum(axis=1).tolist(), (high * low).sum(axis=1).tolist(), (low * low).sum(axis=1).tolist())
        out = [(a << 48) + (b << 25) + c for a, b, c in parts]
    else:
        gaps = w.n * x.astype(object) - np.array(w.sums, object)
        out = (gaps * gaps).sum(axis=1).tolist()
    return pa.array([decimal.Decimal(s) if s < 10**38 else None for s in out], pa.decimal128(38, 0))


def _centred(x: np.ndarray, w: Whitening) -> np.ndarray:
    """x - S / n: whole and fractional part of the mean apart, so that no digit is lost."""
    whole = np.array([s // w.n for s in w.sums], np.int64)
    part = np.array([(s % w.n) / w.n for s in w.sums])
    return (x - whole) - part


def whiten(table: DataFrame, components: int = COMPONENTS, key: str = "vec_id", column: str = "embedding", scale: int = SCALE, offset: int = OFFSET, dims: int | None = None) -> DataFrame:
    """key, component (from 1), n, deviation (decimal), whitened, explained, identity_error: a row for each vector and component.

    Rows whose vector is null or holds null, NaN or infinity go, and so do those
    of another length than `dims` (by default the most frequent one). A null key
    is a key like others; repeated rows count as often as they stand there; other
    columns are not read. Entries beyond +-2^42 after scaling count as that. An
    empty table, or one of empty vectors, gives no rows. A direction without
    variance has whitened null and explained 0, and is not part of the identity
    that is verified; identity_error is 0 if no direction is left. A deviation of
    more than 38 digits is null."""
    rows, dims = usable(table, key, column, dims)
    w = fit(rows, dims, scale, offset)
    k = min(components, dims if w.n else 0)
    live = int((w.values[:k] > 0).sum())
    matrix = w.vectors[:, :live] / np.sqrt(w.values[:live])
    error = 0.0
    if live:
        again = moments(rows.select("vector"), live, lambda c: _centred(_matrix(c, dims, scale, offset), w) @ matrix)
        error = float(np.abs(again.scatter / again.n - np.eye(live)).max())
    name = {f.name: f.dataType.simpleString() for f in rows.schema.fields}["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows or not k:
                continue
            x = _matrix(b.column(1), dims, scale, offset)
            out = np.full((len(x), k), np.nan)
            out[:, :live] = _centred(x, w) @ matrix
            at = pa.array(np.repeat(np.arange(len(x)), k))
            white = pa.array(out.ravel(), mask=np.isnan(out.ravel()))
            each = [pa.array(np.tile(v, len(x))) for v in (np.arange(1, k + 1, dtype=np.int32), w.explained[:k])]
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), each[0], _deviations(x, w).take(at), white, each[1]], names=["key", "component", "deviation", "whitened", "explained"])

    got = rows.select("key", "vector").mapInArrow(run, f"key {name}, component int, deviation decimal(38,0), whitened double, explained double")
    return got.select(F.col("key").alias(key), "component", F.lit(w.n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error"))


def digest(whitened: DataFrame) -> DataFrame:
    """The columns of the contract; a deviation beyond 64 bits is null."""
    return whitened.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
