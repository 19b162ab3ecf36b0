"""Language-model scores by subword lattice likelihood.

A token, with a mark for the blank before it, is a lattice of all segmentations
into pieces of an existing vocabulary (its path is a parameter). Pieces have
unigram probabilities: their counts in the vocabulary's own segmentation of the
training tokens, smoothed by one. The forward recursion in log space sums the
probabilities of all segmentations of a token; as no piece spans a blank, the
marginal probability of a text is the product over its tokens and one end; that
is `score`. Characters that the vocabulary lacks are spelt by byte pieces. Beside
it, mixed_score gives tokens seen in training one more arc, over the whole token:
of the N + V chances that N training tokens of V kinds leave, c fall to a token
seen c times and V to the pieces.

Scale: tokens are counted by task before they are shuffled. A lattice is computed
once for each distinct token. The HOT most frequent tokens are broadcast (their
number bounds the size) and looked up while a text is read; all other tokens are
joined by token, with their sums per document combined before the shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache
from math import exp, log, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, keyed, mark, spread, sweep

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Bound of the broadcast table: 24 bytes a token.
HOT = 200_000
#: Distinct tokens that a task counts before it passes them on.
FLUSH = 300_000
HELD_OUT, FOLDS = 2, 7
_MARK = "▁"
_LN10 = log(10)


def tokens(text: str) -> list[bytes]:
    """Runs of other characters than blank and \\x09-\\x0d, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class Vocabulary:
    """The pieces of a sentencepiece model and, for each, a log probability."""

    def __init__(self, path: str, counts: dict[int, int] | None = None, ends: int = 0):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        usable = [i for i in range(size) if not self.model.is_control(i) and not self.model.is_unknown(i) and not self.model.is_unused(i)]
        counts = counts or {}
        total = sum(counts.get(i, 0) + 1 for i in usable) + ends + 1
        lp = lambda c: log((c + 1) / total)
        self.end = lp(ends)
        self.byte = {}
        self.piece: dict[str, float] = {}
        for i in usable:
            name = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.byte[int(name[3:5], 16)] = lp(counts.get(i, 0))
            else:
                self.piece[name] = lp(counts.get(i, 0))
        self.longest = max(map(len, self.piece), default=1)
        self.starts = {p[:k] for p in self.piece for k in range(1, len(p) + 1)}

    def token(self, word: str) -> float:
        """Log probability (natural) of a token: the sum over all segmentations of its mark and characters."""
        s = _MARK + word
        n = len(s)
        alpha: list[list[float]] = [[] for _ in range(n + 1)]
        alpha[0].append(0.0)
        piece, starts = self.piece, self.starts
        for i in range(n):
            terms = alpha[i]
            if not terms:
                continue
            if len(terms) == 1:
                here = terms[0]
            else:
                top = max(terms)
                here = top + log(sum([exp(x - top) for x in terms]))
            alpha[i] = []
            for j in range(i + 1, min(n, i + self.longest) + 1):
                part = s[i:j]
                if part not in starts:
                    break
                p = piece.get(part)
                if p is not None:
                    alpha[j].append(here + p)
            alpha[i + 1].append(here + sum([self.byte[b] for b in s[i].encode("utf-8", "surrogatepass")]))
        terms = alpha[n]
        top = max(terms)
        return top + log(sum([exp(x - top) for x in terms]))


@cache
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def count_tokens(docs: DataFrame) -> DataFrame:
    """token (binary), train, seen: counts in training documents and in all, an end not included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            train, held = seen
            keys = list(train.keys() | held.keys())
            rows = pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([train[k] for k in keys], pa.int64()), pa.array([train[k] + held[k] for k in keys], pa.int64())], names=["token", "train", "seen"])
            train.clear()
            held.clear()
            return rows

        for b in batches:
            for held, t in zip(b.column(0), b.column(1)):
                seen[held.as_py()].update(tokens(t.as_py()))
            if len(seen[0]) + len(seen[1]) > FLUSH:
                yield out()
        yield out()

    got = keyed(docs).select(_held_out().alias("held_out"), "text").mapInArrow(run, "token binary, train long, seen long")
    # counted by task, so dealt as they are: the next step computes a lattice for each
    return spread(got, "token").groupBy("token").agg(F.sum("train").alias("train"), F.sum("seen").alias("seen"))


def _held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def piece_counts(vocab: DataFrame, path: str) -> dict[int, int]:
    """How often each piece stands in the vocabulary's own segmentation of the training tokens: one row per piece at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _vocabulary(path).model
        got = np.zeros(model.get_piece_size(), np.int64)
        for b in batches:
            words = [w.as_py().decode("utf-8", "replace") for w in b.column(0)]
            for ids, c in zip(model.encode(words, num_threads=1), b.column(1).to_numpy(zero_copy_only=False)):
                for i in ids:
                    got[i] += c
        at = np.flatnonzero(got)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(got[at])], names=["piece", "n"])

    rows = vocab.where("train > 0").select("token", "train").mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    return {r["piece"]: r["n"] for r in rows}


def score_tokens(vocab: DataFrame, path: str, counts: dict[int, int], ends: int) -> DataFrame:
    """vocab with lp: the log10 probability of each token."""
    held = vocab.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Vocabulary(path, held.value, ends)
        for b in batches:
            lp = [model.token(w.as_py().decode("utf-8", "replace")) / _LN10 for w in b.column(0)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lp, pa.float64())], names=["token", "train", "seen", "lp"])

    return vocab.select("token", "train", "seen").mapInArrow(run, "token binary, train long, seen long, lp double")


def hot_tokens(vocab: DataFrame, most: int = HOT) -> list:
    """token, train, lp of the most frequent tokens: all that are seen as often as fits in `most` rows."""
    freq = vocab.groupBy("seen").agg(F.count("*").alias("n"))
    # one row per distinct frequency, of which there are few; frequencies over the square root of all tokens are fewer still
    freq = freq.withColumn("above", F.sum("n").over(W.orderBy(F.desc("seen")))).where(F.col("above") <= most)
    least = freq.agg(F.min("seen")).collect()[0][0]
    return vocab.where(F.col("seen") >= least).select("token", "train", "lp").collect() if least is not None else []


def _mixed(c: int, lp: float, total: int, share: float) -> float:
    """log10 of c / total + share * 10 ** lp, without underflow."""
    parts = [x for x in (log10(c / total) if c else None, log10(share) + lp if share else None) if x is not None]
    top = max(parts, default=0.0)
    return top + log10(sum(10.0 ** (x - top) for x in parts)) if parts else 0.0


def _mixed_column(c: Column, lp: Column, total: int, share: float) -> Column:
    """_mixed() of columns; share is above 0."""
    pieces = lp + log10(share)
    seen = F.log10(c / float(total))
    top = F.greatest(seen, pieces)
    return F.when(c > 0, top + F.log10(F.pow(F.lit(10.0), seen - top) + F.pow(F.lit(10.0), pieces - top))).otherwise(pieces)


def score(docs: DataFrame, path: str = VOCABULARY, hot: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, mixed_score: a row per row of docs.

    A null text counts as empty: one token, the end. A null doc_id has the empty
    text as its own. Without training documents N and V are 0. Repeated rows each
    get their own, equal row; other columns are not read. Scores are log10. Texts of
    any length are scored whole; an empty table gives no rows. The vocabulary's file
    must be there on every executor."""
    since = mark()
    fold = keyed(docs).agg(F.count_if(~_held_out())).collect()[0][0]
    seen = cut(count_tokens(docs), "counts")
    sums = seen.where("train > 0").agg(F.coalesce(F.sum("train"), F.lit(0)), F.count("*")).collect()[0]
    n, v = sums[0] + fold, sums[1] + (fold > 0)
    counts = piece_counts(seen, path)
    vocab = cut(score_tokens(seen, path, counts, fold), "vocabulary")
    floor = log10(n + v + 1)
    total = max(n + v, 1)
    share = v / total if n else 1.0
    end_base, end_lp = log10(fold + 1) - floor, Vocabulary(path, counts, fold).end / _LN10
    end_mix = _mixed(fold, end_lp, total, share)
    rows = hot_tokens(vocab, hot)
    held = docs.sparkSession.sparkContext.broadcast({bytes(r["token"]): (r["train"], r["lp"]) for r in rows})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {w: (log10(c + 1) - floor, lp, c > 0, _mixed(c, lp, total, share)) for w, (c, lp) in held.value.items()}
        for b in batches:
            row, token, times, known, base, lp, mix = [], [], [], [], [], [], []
            for k, t in enumerate(b.column(2)):
                words = tokens(t.as_py())
                here_known, here_base, here_lp, here_mix = int(fold > 0), end_base, end_lp, end_mix
                rare: list[tuple[bytes, int]] = []
                for w, c in Counter(words).items():
                    x = table.get(w)
                    if x is None:
                        rare.append((w, c))
                    else:
                        here_base += c * x[0]
                        here_lp += c * x[1]
                        here_mix += c * x[3]
                        if x[2]:
                            here_known += c
                row.append(k)
                token.append(None)
                times.append(len(words) + 1)
                known.append(here_known)
                base.append(here_base)
                lp.append(here_lp)
                mix.append(here_mix)
                for w, c in rare:
                    row.append(k)
                    token.append(w)
                    times.append(c)
                    known.append(0)
                    base.append(0.0)
                    lp.append(0.0)
                    mix.append(0.0)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(token, pa.binary()), pa.array(times, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(lp, pa.float64()), pa.array(mix, pa.float64())], names=["doc_id", "row_hash", "token", "times", "known", "base", "lp", "mix"])

    parts = cut(keyed(docs).select("doc_id", "row_hash", "text").mapInArrow(run, "doc_id long, row_hash long, token binary, times long, known long, base double, lp double, mix double"), "parts")
    sweep(docs.sparkSession, since, vocab, parts)
    whole = parts.where("token IS NULL").select("doc_id", "row_hash", F.col("times").alias("n_tokens"), "known", "base", "lp", "mix", F.lit(1).alias("rows"))
    of = vocab.select(F.col("token").alias("t"), "train", F.col("lp").alias("t_lp"))
    rest = parts.where("token IS NOT NULL").join(of, F.col("token") == F.col("t"))
    arc = _mixed_column(F.col("train"), F.col("t_lp"), total, share or 1.0)
    rest = rest.select("doc_id", "row_hash", F.lit(0).cast("long").alias("n_tokens"), F.when(F.col("train") > 0, F.col("times")).otherwise(0).alias("known"), (F.col("times") * (F.log10(F.col("train") + 1.0) - floor)).alias("base"), (F.col("times") * F.col("t_lp")).alias("lp"), (F.col("times") * arc).alias("mix"), F.lit(0).alias("rows"))
    got = whole.unionByName(rest).groupBy("doc_id", "row_hash").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "known", "base", "lp", "mix", "rows")])
    # rows that are equal were summed together
    got = got.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    each = lambda c: F.expr(f"{c} DIV rows").alias({"known": "n_known"}.get(c, c))
    return got.select("doc_id", _held_out().alias("held_out"), each("n_tokens"), each("known"), F.lit(n).cast("long").alias("train_tokens"), (F.col("base") / F.col("rows")).alias("base_score"), (F.col("lp") / F.col("rows")).alias("score"), (F.col("mix") / F.col("rows")).alias("mixed_score"))
