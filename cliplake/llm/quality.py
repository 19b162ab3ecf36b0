"""Quality rules: an isolation forest on rule statistics.

Each document gets the counts that filter rules are made of (words, symbols,
repeated lines, repeated three-word windows and so on), as rates. The limit of
each rule is learned: the range in which the labelled good rows lie, but for a
thousandth at either end, and a quarter of it more. A document's features are how
far its rates lie beyond these limits; random splits isolate documents that lie
far out, or out in many ways, in few steps, and the mean path length gives a
score. Limits and forest are fitted on a bounded sample of labelled rows
(FIT_ROWS), the threshold is calibrated on all labelled rows. Two hard rules stand
beside the forest. Most documents lie within all limits and share one score.

Scale: one pass over the text in Arrow batches; the statistics (some 150 bytes a
document) are written once and joined with the labels; the calibration reads a
histogram of fixed size. Memory per task is one batch and one document's words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mark, sweep

FIT_ROWS = 4096
TREES = 100
SAMPLE = 256
DEPTH = 8
BINS = 10_000
#: A lost good row costs as much as so many missed bad ones, in shares of their class.
GOOD_COST = 10.0
#: Share of the good rows at either end that a limit leaves out, and what is added to the range on either side, as a share of it.
TAIL, MARGIN = 0.001, 0.25
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digit", "n_alpha", "longest")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(ids: np.ndarray, n: int) -> int:
    """Words that lie in a three-word window found twice or more; ids are below n."""
    if len(ids) < 4:
        return 0
    pair = ids[:-1] * np.int64(n) + ids[1:]
    if n >= 1 << 20:  # three ids would not fit in 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    third = pair[:-1] * np.int64(n) + ids[2:]
    _, inverse, count = np.unique(third, return_inverse=True, return_counts=True)
    again = count[inverse] > 1
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : len(ids) - 2 + k] |= again
    return int(covered.sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """The COUNTS of a whole text; null counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: at space and \\x09-\\x0d only
    blanks = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    ids: dict[bytes, int] = {}
    get = ids.setdefault
    seq = np.fromiter((get(w, len(ids)) for w in words), np.int64, len(words))
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, digit = int(byte[65:91].sum()), int(byte[48:58].sum())
    alpha = upper + int(byte[97:123].sum()) + int(byte[0xC2:].sum())
    longest = max(map(len, words), default=0)
    return (len(words), len(text) - blanks, int(sum(byte[ord(c)] for c in SYMBOLS)), dup, repeated_words(seq, max(len(ids), 1)), lines, len(ids), upper, digit, alpha, longest)


def rates(c: np.ndarray) -> np.ndarray:
    """The statistics of the rules from COUNTS (float columns, one row per document), free of a text's length."""
    words, chars, symbols, dup, repeat, lines, distinct, upper, digit, alpha, longest = c.T
    w, ch, ln = np.maximum(words, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    return np.stack([symbols / w, alpha / ch, chars / w, repeat / w, dup / ln, digit / ch, upper / ch, np.log1p(longest), np.log1p(words) - 0.9 * np.log1p(distinct)], 1)


def limits(good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest rates that the rules let pass, from the COUNTS of good rows; none without such rows."""
    if not len(good):
        return np.full(1, -np.inf), np.full(1, np.inf)
    low, high = np.quantile(rates(good), [TAIL, 1 - TAIL], axis=0)
    return low - MARGIN * (high - low), high + MARGIN * (high - low)


def features(c: np.ndarray, within: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How far the rates lie beyond the limits."""
    x = rates(c)
    return np.maximum(np.maximum(x - within[1], within[0] - x), 0)


def base_failed(c: np.ndarray) -> np.ndarray:
    return (c[:, 0] < MIN_WORDS) | (100 * c[:, 4] > 50 * c[:, 0])


class Forest:
    """Isolation trees of at most 2^DEPTH leaves over features, in arrays: column, cut and depth-adjusted path length of a leaf."""

    def __init__(self, c: np.ndarray, good: np.ndarray, seed: int = 7):
        """c: COUNTS of labelled rows; good: which of them are."""
        self.limits = limits(c[good & ~base_failed(c)])
        x = features(c, self.limits)
        rng = np.random.default_rng(seed)
        nodes = 2 ** (DEPTH + 1)
        self.column = np.full((TREES, nodes), -1)
        self.cut = np.zeros((TREES, nodes))
        self.path = np.zeros((TREES, nodes))
        self.size = max(2, min(SAMPLE, len(x)))
        for t in range(TREES if len(x) else 0):
            self._grow(t, 1, 0, x[rng.permutation(len(x))[:SAMPLE]], rng)

    @staticmethod
    def _mean(n: int) -> float:
        return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0

    def _grow(self, t: int, node: int, depth: int, x: np.ndarray, rng: np.random.Generator) -> None:
        spread = np.flatnonzero(x.max(0) > x.min(0))
        if depth == DEPTH or len(x) < 2 or not len(spread):
            self.path[t, node] = depth + self._mean(len(x))
            return
        j = rng.choice(spread)
        at = rng.uniform(x[:, j].min(), x[:, j].max())
        self.column[t, node], self.cut[t, node] = j, at
        left = x[:, j] < at
        self._grow(t, 2 * node, depth + 1, x[left], rng)
        self._grow(t, 2 * node + 1, depth + 1, x[~left], rng)

    def score(self, c: np.ndarray) -> np.ndarray:
        """Of COUNTS, in (0, 1]; high where few splits isolate the row."""
        x = features(c, self.limits)
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(TREES):
            node = np.ones(len(x), np.int64)
            for _ in range(DEPTH):
                j = self.column[t, node]
                inner = j >= 0
                right = x[rows, np.maximum(j, 0)] >= self.cut[t, node]
                node = np.where(inner, 2 * node + right, node)
            total += self.path[t, node]
        return 2.0 ** (-total / TREES / max(self._mean(self.size), 1e-9))


def _table(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(float) for c in COUNTS], 1)


def count(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS, a row per row; other columns are not read."""
    text = docs["text"].cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.array([statistics(t.as_py()) for t in b.column(1)], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(got[:, i]) for i in range(len(COUNTS))]], names=["doc_id", *COUNTS])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text")).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def fit(counts: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, good_cost: float = GOOD_COST) -> tuple[Forest, float]:
    """The forest and its threshold.

    The limits and the forest come from the fit_rows labelled rows with the least hash. The threshold has the
    least cost on all labelled rows that pass the hard rules: good_cost * (share
    of good rows lost) + (share of bad rows kept); of equal ones the highest.
    Without labels nothing is rejected by the forest."""
    lab = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("of")).agg(F.min("quality").alias("quality"))
    got = cut(counts.join(lab, counts["doc_id"] == lab["of"]).drop("of"), "labelled")
    by_hash = F.xxhash64("doc_id")
    sample = got.orderBy(by_hash, *COUNTS).limit(fit_rows).select(*COUNTS, "quality").toPandas().to_numpy(float).reshape(-1, len(COUNTS) + 1)
    forest = Forest(sample[:, :-1], sample[:, -1] > 0)
    if not len(sample):
        return forest, 2.0
    bins = score(got, forest).where("not base_failed").groupBy("quality", F.least(F.lit(BINS - 1), F.floor(F.col("score") * BINS)).alias("bin")).count().collect()
    hist = np.zeros((2, BINS + 1))
    for r in bins:
        hist[int(r["quality"] > 0), r["bin"]] += r["count"]
    above = hist[:, ::-1].cumsum(1)[:, ::-1]  # rows in this bin or a higher one
    cost = good_cost * above[1] / max(above[1, 0], 1) - above[0] / max(above[0, 0], 1)
    at = BINS - int(np.argmin(cost[::-1]))
    return forest, at / BINS


def score(counts: DataFrame, forest: Forest) -> DataFrame:
    """counts with base_failed and score."""
    names = counts.columns
    held = counts.sparkSession.sparkContext.broadcast(forest)  # a fixed number of nodes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = _table(b)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(base_failed(c)), pa.array(held.value.score(c))], names=[*names, "base_failed", "score"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counts.schema)
    return counts.mapInArrow(run, f"{types}, base_failed boolean, score double")


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, COUNTS, base_failed, score, kept: a row per row of docs.

    Null and empty texts have counts of 0 and fail. Labels with a null doc_id or
    quality are ignored; of several for a document the lowest quality counts.
    Repeated rows are judged alike. Texts of any length are counted whole; an empty
    table gives no rows, and without usable labels all that pass the hard rules are
    kept. Other columns are not read."""
    since = mark()
    counts = cut(count(docs), "counts")
    forest, threshold = fit(counts, labels)
    sweep(docs.sparkSession, since, counts)
    return score(counts, forest).withColumn("kept", ~F.col("base_failed") & (F.col("score") < threshold))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that assess() keeps. Text is read again rather than shuffled."""
    since = mark()
    forest, threshold = fit(cut(count(docs), "counts"), labels)
    sweep(docs.sparkSession, since)
    held = docs.sparkSession.sparkContext.broadcast((forest, threshold))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = np.array([statistics(None if (v := t.as_py()) is None else str(v)) for t in b.column(at)], float).reshape(-1, len(COUNTS))
            model, top = held.value
            yield b.filter(pa.array(~base_failed(c) & (model.score(c) < top)))

    return docs.mapInArrow(run, docs.schema)
