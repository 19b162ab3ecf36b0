"""Language identification by language-bitmask n-gram filters.

An n-gram is 1 to 4 letters in lower case, a word's edge counting as one of them.
A language contains an n-gram at level v if at least the v-th of SHARES of all its
training n-grams of that length are this one. For each language and level there is
a Bloom filter, and all filters share their hashes and lie bit-sliced in one table:
a row holds a position's bits of all languages, a byte of levels each, so that the
rows at an n-gram's places, and-ed, are a bitmask of all languages (and levels)
that contain it. Bits are counted per language over all n-grams of a whole text.
Of a filter's n-grams a share f, its fill to the power of its hashes, are false:
a bit counts (bit - f) / (1 - f), which is right on average. As a level stands for
a tenth of the frequency of the one above, the bits of a language add up to a log
likelihood in steps of ten, and the largest sum decides.

Scale: n-grams are counted by task before they are shuffled, as numbers without
texts. A language has at most 1 / SHARES[-1] n-grams of each length in its filters
however large the corpus is; the table is built by or-ing bits per position in
Spark and has at most TABLE_BYTES, which bounds what is collected and broadcast;
if it fills up, the correction knows. Texts are worked off in parts of CHUNK
letters, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, mark, sweep

LENGTHS = (1, 2, 3, 4)
SHARES = (1e-2, 1e-3, 1e-4, 1e-5)
HELD_OUT, FOLDS = 0, 5
#: A language's levels have a byte, a word holds eight languages.
BYTES = 8
HASHES = 2
#: Positions for each n-gram of the fullest filter, within the bound of the table.
ROOM = 32
TABLE_BYTES = 64_000_000
#: More names than this in the column of languages are no languages.
LANGUAGES = 1_000
#: Letters that are worked off together, and distinct n-grams that a task holds before it passes them on.
CHUNK = 500_000
FLUSH = 1_000_000
NONE = "und"
#: Sums are whole numbers of this part of a bit, so that they don't depend on their order.
UNIT = 2**20


@cache
def _letters() -> np.ndarray:
    """For each code point the code of its letter in lower case, or 0."""
    lower = [c.lower() if c.isalpha() else "\0" for c in map(chr, range(0x110000))]
    return np.fromiter((ord(low) if len(low) == 1 else i for i, low in enumerate(lower)), np.uint32, len(lower))


def codes(text: str) -> np.ndarray:
    """Letters of a text with one 0 before, between and after its words; empty if it has no letter."""
    x = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    x = np.concatenate([np.zeros(1, np.uint32), x, np.zeros(1, np.uint32)])
    x = x[np.concatenate([[True], (x[1:] != 0) | (x[:-1] != 0)])]
    return x if len(x) > 2 else x[:0]


def grams(x: np.ndarray, length: int, here: int) -> tuple[np.ndarray, np.ndarray]:
    """63-bit hashes of the n-grams that begin at the first `here` places of x, and which of them count.

    Edges of words stand at either end of an n-gram, not inside, and not alone: so
    none reaches from one text into another. x is followed by edges."""
    x = np.concatenate([x[: here + length - 1], np.zeros(max(0, here + length - 1 - len(x)), x.dtype)]).astype(np.uint64)
    h = np.full(here, length, np.uint64)
    for k in range(length):
        h = (h ^ x[k : here + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h = h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(1)
    letter = x != 0
    inner = [letter[k : here + k] for k in range(1, length - 1)]
    edges = [letter[:here] | letter[length - 1 : here + length - 1]] if length < 3 else []
    return h, reduce(np.logical_and, [*edges, *inner])


def _held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == HELD_OUT


class _Counts:
    """Counts of n-grams of one language and length in a task."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, h: np.ndarray) -> None:
        got = pc.value_counts(pa.array(h.view(np.int64)))
        self.parts.append((got.field("values").to_numpy(zero_copy_only=False), got.field("counts").to_numpy(zero_copy_only=False)))
        if len(self) > FLUSH // 4:
            self.sum()

    def __len__(self) -> int:
        return sum(len(g) for g, _ in self.parts)

    def sum(self) -> tuple[np.ndarray, np.ndarray]:
        values, at = np.unique(np.concatenate([g for g, _ in self.parts]), return_inverse=True)
        self.parts = [(values, np.bincount(at, np.concatenate([n for _, n in self.parts])).astype(np.int64))]
        return self.parts[0]


def count_grams(docs: DataFrame) -> DataFrame:
    """lang, length, gram (hash), n of the texts in docs(text, lang), neither of which is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], _Counts] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, length), counts in seen.items():
                g, n = counts.sum()
                yield pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(g), np.int64))), pa.array(np.full(len(g), length, np.int32)), pa.array(g), pa.array(n)], names=["lang", "length", "gram", "n"])
            seen.clear()

        def count(lang: str, waiting: list[np.ndarray]) -> None:
            x = np.concatenate(waiting)
            for a in range(0, len(x), CHUNK):
                for length in LENGTHS:
                    h, ok = grams(x[a : a + CHUNK + length], length, min(CHUNK, len(x) - a))
                    seen.setdefault((lang, length), _Counts()).add(h[ok])

        for b in batches:
            waiting: dict[str, list[np.ndarray]] = {}
            for t, lang in zip(b.column(0), b.column(1).to_pylist()):
                x = codes(t.as_py())
                if len(x):
                    waiting.setdefault(lang, []).append(x)
                    if sum(map(len, waiting[lang])) > CHUNK:
                        count(lang, waiting.pop(lang))
            for lang, rest in waiting.items():
                count(lang, rest)
            if sum(map(len, seen.values())) > FLUSH:
                yield from out()
        yield from out()

    got = docs.select("text", "lang").mapInArrow(run, "lang string, length int, gram long, n long")
    return got.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Filters:
    """Languages, the bit-sliced table (a row a position), and for each language what a byte of levels counts."""

    languages: list[str]
    table: np.ndarray
    worth: np.ndarray

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """Corrected popcounts by language, in UNITs, of texts as codes(), none of them empty."""
        x = np.concatenate(texts)
        starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        bits = np.uint64(len(self.table).bit_length() - 1)
        low = np.uint64(len(self.table) - 1)
        for a in range(0, len(x), CHUNK):
            here = min(CHUNK, len(x) - a)
            first, last = np.searchsorted(starts, a, "right") - 1, np.searchsorted(starts, a + here, "left")
            begins = np.maximum(starts[first:last] - a, 0)
            for length in LENGTHS:
                h, ok = grams(x[a : a + here + length], length, here)
                mask = self.table[h & low]
                for k in range(1, HASHES):
                    mask &= self.table[h >> (np.uint64(k) * bits) & low]
                levels = mask.view(np.uint8)
                for k in range(len(self.languages)):
                    out[first:last, k] += np.add.reduceat(np.where(ok, self.worth[k][levels[:, k]], 0), begins)
        return out


def learn(docs: DataFrame) -> Filters:
    """Filters of all languages in docs(text, lang); rows with a null in either say nothing."""
    since = mark()
    counts = cut(count_grams(docs.where("text IS NOT NULL AND lang IS NOT NULL")), "grams")
    total = counts.groupBy("lang", "length").agg(F.sum("n").alias("total")).limit(LANGUAGES * len(LENGTHS) + 1).collect()
    if len(total) > LANGUAGES * len(LENGTHS):
        raise ValueError(f"there are more than {LANGUAGES} languages")
    size = {r["lang"]: r["total"] for r in total if r["length"] == 1}
    languages = sorted(size, key=lambda k: (-size[k], k))  # of equal sums the first decides
    words = max(1, -(-len(languages) // BYTES))
    spark = docs.sparkSession
    if not languages:
        sweep(spark, since)
        return Filters([], np.zeros((1, BYTES // 8), np.uint64), np.zeros((0, 256), np.int64))
    of = spark.createDataFrame([(r["lang"], r["length"], r["total"], languages.index(r["lang"])) for r in total], "lang string, length int, total long, k int")
    kept = counts.join(F.broadcast(of), ["lang", "length"]).where(F.col("n") >= SHARES[-1] * F.col("total"))
    fullest = kept.groupBy("k").count().agg(F.max("count")).collect()[0][0]
    most = (TABLE_BYTES // (8 * words)).bit_length() - 1
    bits = min(most, max(10, int(ROOM * fullest).bit_length()), 63 // HASHES)
    levels = sum((F.when(F.col("n") >= s * F.col("total"), 1 << v).otherwise(0) for v, s in enumerate(SHARES)), F.lit(0)).cast("long")
    shifted = F.expr("shiftleft(levels, 8 * (k % 8))")
    places = F.array(*[F.shiftrightunsigned("gram", k * bits).bitwiseAND(F.lit((1 << bits) - 1)).cast("int") for k in range(HASHES)])
    rows = kept.withColumn("levels", levels).select(F.explode(places).alias("place"), (F.col("k") / F.lit(BYTES)).cast("int").alias("word"), shifted.alias("bits"))
    rows = rows.groupBy("place", "word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros((1 << bits, words), np.uint64)
    table[rows["place"].to_numpy(), rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    sweep(spark, since)
    planes = table.view(np.uint8)
    worth = np.zeros((len(languages), 256))
    for k in range(len(languages)):
        for v in range(len(SHARES)):
            false = np.count_nonzero(planes[:, k] & (1 << v)) / len(table)
            false = min(false**HASHES, 0.999)
            worth[k] += ((np.arange(256) >> v & 1) - false) / (1 - false)
    return Filters(languages, table, np.rint(worth * UNIT).astype(np.int64))


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, held_out, lang_pred, score of docs(doc_id, held_out, text).

    A text that is null or has no letter, or any text if nothing was learned, is
    NONE with score 0. score is the likelihood of the language that decides, as a
    share of all languages' (lengths are taken as one observation); of equal
    languages, as for letters that no filter holds, the one with more training
    text, then the one first by code point."""
    held = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for b in batches:
            pred, score = [NONE] * b.num_rows, np.zeros(b.num_rows)
            rows: list[int] = []
            texts: list[np.ndarray] = []

            def decide() -> None:
                got = model.scores(texts)
                best = got.argmax(axis=1)
                gap = (got - got[np.arange(len(got)), best][:, None]) / (UNIT * len(LENGTHS))
                for i, k, s in zip(rows, best.tolist(), 1 / np.power(10.0, gap).sum(axis=1)):
                    pred[i], score[i] = model.languages[k], s
                rows.clear()
                texts.clear()

            for i, t in enumerate(b.column(2)):
                x = codes(t.as_py() or "")
                if len(x) and model.languages:
                    rows.append(i)
                    texts.append(x)
                    if sum(map(len, texts)) > CHUNK:
                        decide()
            if rows:
                decide()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pred, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: a row per row of docs.

    Filters are learned from the rows that aren't held out, text and language
    known; a row's language, source and id are never read for its prediction.
    A null doc_id counts as empty text for the fold. Repeated rows get equal rows
    each; an empty language is one like others; other columns are not read. See
    predict() for texts without letters, ties and nothing learned. Texts of any
    length are read whole, in parts. An empty table gives no rows."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang")).withColumn("held_out", _held_out())
    return predict(rows, learn(rows.where(~F.col("held_out")).select("text", "lang")))
