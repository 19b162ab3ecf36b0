"""Substring dedup over sliding spans of sentences.

A sentence ends at . ! ? and at line breaks. Sentences of more than GAP words are
cut once more by winnowing: of every GAP words in a row that hold no end of a
sentence, the piece ends at the one with the least hash. Shorter sentences stay
whole, and the cuts of a sentence depend on its own words only, so that repeated
sentences are found and removed as a whole; cuts inside matter where the same
words stand in unlike sentences, as in lists or quotations. No piece has more
than GAP words. In a passage of 50 words the first and last GAP - 1 may be cut
otherwise than in another text; between them always lies a whole run. Every run
of SENTENCES or more pieces with WORDS or more words (the shortest such from each
piece on) is hashed and joined globally; pieces that a repeated run covers go,
except where it occurs first. Passages without a run, of under 20 words, stay.

Scale: a run is a row of hashes and ids, made in one pass over the text and
written once. First occurrences are minima that are combined before the shuffle;
the join against repeated runs has plain exchanges on both sides, so that a run in
a third of all documents is split over tasks. Text moves once, to meet the runs of
its document, and only texts that lose something are cut again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, keyed, mark, sweep

SENTENCES = 3
WORDS = 20
#: Most words in a piece. A shared run ends within 2 GAP - 2 + WORDS + GAP - 1 words of a passage, GAP more decide its last cut: 50 for 8.
GAP = 8
_END = (".", "!", "?", '."', '!"', '?"', ".)", "!)", "?)", ".'", "!'", "?'")


def _key(w: str) -> int:
    """63 bits of a hash of a word in lower case, inverted if it ends a sentence."""
    k = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) >> 1
    return ~k if w.endswith(_END) else k


def _cut(text: str, cuts: dict[str, int]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words in lower case, their keys (kept in cuts), and the places after which a piece ends."""
    if len(cuts) > 500_000:
        cuts.clear()
    lines = [w for line in text.lower().split("\n") if (w := line.split())]
    words = list(chain.from_iterable(lines))
    for w in set(words).difference(cuts):
        cuts[w] = _key(w)
    n = len(words)
    keys = np.fromiter(map(cuts.__getitem__, words), np.int64, n)
    end = keys < 0
    end[np.cumsum([len(w) for w in lines], dtype=np.int64) - 1] = True
    if n >= GAP:
        # the least hash of each window, of equal ones the last, by windows of 2, 4 and 8 words
        least, size = (np.where(end, -1, keys & 0xFFFFFFFF) << 31) + np.arange(n - 1, -1, -1), 1
        while size < GAP:
            step = min(size, GAP - size)
            least, size = np.minimum(least[:-step], least[step:]), size + step
        end[n - 1 - (least & 0x7FFFFFFF)] = True
    return words, keys, np.flatnonzero(end) + 1


def pieces(text: str, cuts: dict[str, int]) -> list[tuple[int, str]]:
    """(number of words, words joined by blanks in lower case) of each sentence or part of one, in order."""
    words, _, ends = _cut(text, cuts)
    out, at = [], 0
    for k in ends.tolist():
        out.append((k - at, " ".join(words[at:k])))
        at = k
    return out


def _powers(base: int) -> np.ndarray:
    out = np.full(_BLOCK, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


#: Run hashes are polynomials of the keys modulo 2^64, taken in blocks of so many words, which overlap by the longest run.
_BLOCK = 1 << 16
_BASES = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93]
_UP = [_powers(b) for b in _BASES]
_DOWN = [_powers(pow(b, -1, 1 << 64)) for b in _BASES]


def _runs(keys: np.ndarray, ends: np.ndarray, sentences: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First piece, number of pieces and hashes (64 and 32 bits, of the words) of the shortest run from each piece on."""
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    at = np.arange(len(ends))
    last = np.maximum(at + sentences - 1, np.searchsorted(ends, starts + least))
    at = at[last < len(ends)]
    last = last[: len(at)]
    s, e = starts[at], ends[last]
    out = [np.zeros(len(at), np.uint64) for _ in _BASES]
    mixed = [keys.astype(np.uint64), (keys ^ (keys >> 29)).astype(np.uint64)]
    i = 0
    while i < len(at):
        low = s[i]
        j = max(i + 1, int(np.searchsorted(e, low + _BLOCK, "right")))
        if e[i] - low > _BLOCK:
            raise ValueError(f"a run has more than {_BLOCK} words")
        for k, m in enumerate(mixed):
            part = m[low : e[j - 1]]
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * _UP[k][: len(part)], dtype=np.uint64)])
            out[k][i:j] = (total[e[i:j] - low] - total[s[i:j] - low]) * _DOWN[k][s[i:j] - low]
        i = j
    return at, last - at + 1, out[0].view(np.int64), (out[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def runs(parts: list[tuple[int, str]], sentences: int = SENTENCES, least: int = WORDS) -> Iterator[tuple[int, int, tuple[int, int]]]:
    """(first piece, number of pieces, hashes) of the shortest run from each piece on."""
    keys = np.array([_key(w) for _, p in parts for w in p.split(" ")], np.int64)
    at, n, h, g = (x.tolist() for x in _runs(keys, np.cumsum([n for n, _ in parts], dtype=np.int64), sentences, least))
    yield from zip(at, n, zip(h, g))


def run_table(docs: DataFrame, sentences: int = SENTENCES, least: int = WORDS) -> DataFrame:
    """h, g (hashes of a run), doc_id, row_hash, at, n: the first occurrence of each run in each document.

    Later ones in the same document have no h; a row with at -1 has no h either
    and holds the number of pieces of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts: dict[str, int] = {}
        for b in batches:
            found, row = [], []
            for r, t in enumerate(b.column(2)):
                _, keys, ends = _cut(t.as_py(), cuts)
                at, n, h, g = _runs(keys, ends, sentences, least)
                first = np.zeros(len(at), bool)
                first[np.unique(h, return_index=True)[1]] = True
                found.append((np.append(at, -1), np.append(n, len(ends)), np.append(h, 0), np.append(g, 0), np.append(~first, True)))
                row.append(np.full(len(at) + 1, r))
            if not found:
                continue
            at, n, h, g, none = (np.concatenate(x) for x in zip(*found))
            rows = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays([pa.array(h, mask=none), pa.array(g.astype(np.int32), mask=none), b.column(0).take(rows), b.column(1).take(rows), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], names=["h", "g", "doc_id", "row_hash", "at", "n"])

    return keyed(docs).select("doc_id", "row_hash", "text").mapInArrow(run, "h long, g int, doc_id long, row_hash long, at int, n int")


def strip(text: str, gone: set[int], cuts: dict[str, int]) -> tuple[str, int]:
    """text without the pieces whose number is in gone, and the number of pieces; a line without words left goes with its break."""
    lines, k = [], 0
    for line in text.split("\n"):
        parts = pieces(line, cuts)
        if not any(k + i in gone for i in range(len(parts))):
            lines.append(line)
        elif words := [w for i, w in _original(line, parts) if k + i not in gone]:
            lines.append(" ".join(words))
        k += len(parts)
    return "\n".join(lines), k


def _original(line: str, parts: list[tuple[int, str]]) -> Iterator[tuple[int, str]]:
    words, at = line.split(), 0
    for i, (n, _) in enumerate(parts):
        yield i, " ".join(words[at : at + n])
        at += n


def dedup(docs: DataFrame, sentences: int = SENTENCES, least: int = WORDS) -> DataFrame:
    """doc_id, text (without repeated passages), n_sentences, n_removed, n_chars: a row per row of docs.

    Occurrences are ordered by doc_id (null last), then by place; the first
    stays. Rows that share a doc_id count as one document for that order and keep
    what they have in common. Null texts count as empty. Lines that lose nothing
    are unchanged; in others blanks between what is left become one. Texts with
    fewer sentences or words than a run lose nothing; texts of any length are read
    whole, one at a time. An empty table gives no rows. Other columns are not read."""
    since = mark()
    every = cut(run_table(docs, sentences, least), "runs")
    table, last = every.where("h IS NOT NULL"), F.coalesce("doc_id", F.lit((1 << 63) - 1))
    again = table.groupBy("h", "g").agg(F.min(last).alias("first"), F.max(last).alias("last")).where("first < last")
    again = cut(again.select(F.col("h").alias("oh"), F.col("g").alias("og"), "first"), "repeated")
    hits = table.join(again, (F.col("h") == F.col("oh")) & (F.col("g") == F.col("og"))).where(last > F.col("first"))
    own = every.where("h IS NULL").select("doc_id", "row_hash", "at", "n")
    gone = hits.select("doc_id", "row_hash", "at", "n").unionByName(own).groupBy("doc_id", "row_hash")
    gone = gone.agg(F.max(F.when(F.col("at") < 0, F.col("n"))).alias("pieces"), F.collect_set(F.when(F.col("at") >= 0, F.struct("at", "n"))).alias("runs"))
    gone = cut(gone.withColumnsRenamed({"doc_id": "d", "row_hash": "r"}), "gone")
    sweep(docs.sparkSession, since, gone)
    rows = keyed(docs)
    rows = rows.join(gone, rows["doc_id"].eqNullSafe(gone["d"]) & (rows["row_hash"] == gone["r"]), "left").select("doc_id", "text", "pieces", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts: dict[str, int] = {}
        for b in batches:
            text, removed = [], []
            for t, r in zip(b.column(1), b.column(3)):
                bad = {k for x in r.as_py() for k in range(x["at"], x["at"] + x["n"])}
                text.append(strip(t.as_py(), bad, cuts)[0] if bad else t.as_py())
                removed.append(len(bad))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string()), b.column(2), pa.array(removed, pa.int64())], names=["doc_id", "text", "n_sentences", "n_removed"])

    out = rows.withColumn("pieces", F.col("pieces").cast("long")).mapInArrow(run, "doc_id long, text string, n_sentences long, n_removed long")
    return out.withColumn("n_chars", F.length("text").cast("long"))
