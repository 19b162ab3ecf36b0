"""Ranked lexical search by TPUT over term-partitioned postings.

One pass over the texts counts their terms and keeps, for each document, those
that any query asks for. From these come a list a term of what it adds to the
score of each document, partitioned by term and contribution, so that the list of
a frequent term lies in many parts. Then three phases find the best documents of
every query:

1. The HEAD of every list is fetched. The documents with the largest sums over
   the heads are looked up; the score of the k-th best of them is a lower bound.
2. Every list of a query is thresholded alike: what a document gets from lists in
   which it stays below the threshold, or below the list's own maximum, adds up to
   at most SHARE of the bound. The entries above it are fetched; the documents
   whose sum, with the most that their other lists can add, meets the bound stay.
   A lower SHARE fetches more and leaves fewer to look up.
3. The exact scores of these candidates are looked up, and the k best are kept.

No list, document or candidate is capped: the result is that of scoring all
documents for all queries, ties included.

Scale: the text is read once and stays where it is; heads and sums are taken by
task before they are shuffled. Lists of the most frequent terms, which hold nearly
all documents, have maxima below the threshold and are not fetched. Queries are
worked off in blocks of at most PAIRS pairs of query and term, which bounds what
is collected and broadcast.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, mark, small, sweep, text_of

TOP = 10
#: Entries of each list that are fetched first, and documents of a query that are looked up for its bound.
HEAD, TRIED = 200, 300
SHARE = 0.2
#: Pairs of query and term in a block.
PAIRS = 1_000_000
#: Letters of a text that are cut into terms together.
PART = 4_000_000
#: Fixed values of the score: percent of the length's share, eighths by which frequencies saturate, scale of weights and of shares.
LENGTH_SHARE, SATURATION, WEIGHT, FINE = 90, 8, 1000, 1_000_000_000
#: ASCII letters and digits are parts of terms, in lower case, and so is all beyond ASCII; the rest separates.
_TABLE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, part by part."""
    raw = text.encode("utf-8", "surrogatepass").translate(_TABLE)
    at = 0
    while len(raw) - at > PART:
        end = raw.rfind(b" ", at, at + PART)
        end = end if end >= 0 else raw.find(b" ", at + PART)
        if end < 0:
            break
        yield raw[at:end].split()
        at = end + 1
    yield raw[at:].split() if at else raw.split()


def query_terms(items: DataFrame) -> DataFrame:
    """item_id, word: the distinct terms of each item, of all rows with its id; rows without an id are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, word = [], []
            for k, t in enumerate(b.column(1)):
                found = {w for part in terms(t.as_py()) for w in part}
                row += [k] * len(found)
                word += found
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(word, pa.binary())], names=["item_id", "word"])

    rows = items.select(items["item_id"].cast("long").alias("item_id"), text_of(items).alias("text")).where("item_id IS NOT NULL")
    return rows.mapInArrow(run, "item_id long, word binary").distinct()


def index(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """uid, doc_id, n (all terms), ids, tfs (terms that are in `words`, by place, and their counts): a row per document with a term."""
    held = docs.sparkSession.sparkContext.broadcast({w: k for k, w in enumerate(words)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value.get
        for b in batches:
            row, size, ids, tfs = [], [], [], []
            for k, t in enumerate(b.column(1)):
                n, seen = 0, Counter()
                for part in terms(t.as_py()):
                    n += len(part)
                    seen.update(map(known, part))
                if n:
                    seen.pop(None, None)
                    row.append(k)
                    size.append(n)
                    ids.append(list(seen.keys()))
                    tfs.append(list(seen.values()))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(size, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], names=["doc_id", "n", "ids", "tfs"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<long>").select(F.monotonically_increasing_id().alias("uid"), "doc_id", "n", "ids", "tfs")


def _each(rows: DataFrame, *keys: str) -> DataFrame:
    """A row for each term of a document: keys, m (the document's length term), term, tf."""
    return rows.select(*keys, "m", F.explode(F.arrays_zip("ids", "tfs")).alias("x")).select(*keys, "m", F.col("x.ids").alias("term"), F.col("x.tfs").alias("tf"))


def _adds() -> Column:
    """What a term adds to a document's score."""
    return F.expr(f"weight * (({FINE} * tf) DIV (1000 * tf + {SATURATION} * m))")


def _best(rows: DataFrame, k: int, *order) -> DataFrame:
    """The k first rows of each item, with their rank."""
    return rows.withColumn("rank", F.row_number().over(W.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)


def _kth(rows: DataFrame, score: str, k: int) -> DataFrame:
    """item_id, bound: the k-th largest score of an item; none if it has fewer rows."""
    return _best(rows, k, F.desc(score)).where(F.col("rank") == k).select("item_id", F.col(score).alias("bound"))


def _search(docs: DataFrame, pairs: DataFrame, k: int, head: int) -> DataFrame:
    """item_id, rank, doc_id, score for one block of (item_id, word)."""
    spark = docs.sparkSession
    words = sorted(bytes(r["word"]) for r in pairs.select("word").distinct().collect())
    docs = cut(index(docs, words), "documents")
    total = docs.agg(F.count("*").alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).collect()[0]
    docs = docs.where(F.size("ids") > 0).withColumn("m", F.expr(f"{100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * {total['N']}L) DIV {max(1, total['L'])}L")).drop("n")
    df = docs.select(F.explode("ids").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(WEIGHT * F.log((2.0 * total["N"] + 2.0) / (2 * F.col("df") + 1))).cast("long")
    weights = cut(df.select("term", weight.alias("weight")).where("weight > 0"), "weights")
    code = spark.createDataFrame(pa.table({"word": pa.array(words, pa.binary()), "code": pa.array(range(len(words)), pa.int32())}))
    lists = pairs.join(F.broadcast(code), "word").join(F.broadcast(weights), F.col("code") == F.col("term")).select("item_id", "term", "weight")
    asked = cut(lists, "asked")

    posted = _each(docs, "uid").join(F.broadcast(weights), "term").select("term", "uid", _adds().alias("adds")).where("adds > 0")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    posted = cut(posted.repartitionByRange(parts, "term", F.desc("adds"), "uid").sortWithinPartitions("term", F.desc("adds")), "postings")

    def exact(chosen: DataFrame) -> DataFrame:
        """item_id, uid, doc_id, score of pairs of item and document."""
        found = docs.join(small(chosen.select("item_id", "uid"), PAIRS), "uid")
        scored = _each(found, "item_id", "uid", "doc_id").join(F.broadcast(asked), ["item_id", "term"])
        return scored.groupBy("item_id", "uid", "doc_id").agg(F.sum(_adds()).alias("score"))

    # heads: a lower bound of each item's k-th score, and each list's maximum
    heads = posted.withColumn("place", F.row_number().over(W.partitionBy("term").orderBy(F.desc("adds"), "uid"))).where(F.col("place") <= head)
    heads = cut(heads, "heads")
    sums = heads.join(F.broadcast(asked), "term").groupBy("item_id", "uid").agg(F.sum("adds").alias("part"))
    tried = cut(_best(sums, max(k, TRIED), F.desc("part"), "uid"), "tried")
    bounds = _kth(exact(tried), "score", k)

    # the largest threshold below which a document's lists add up to no more than the share of the bound
    most = asked.join(F.broadcast(heads.where("place = 1").select("term", F.col("adds").alias("most"))), "term").select("item_id", "term", "most")
    rising, item = W.partitionBy("item_id").orderBy("most", "term"), W.partitionBy("item_id")
    level = most.join(bounds, "item_id", "left").withColumn("bound", F.coalesce("bound", F.lit(0)))
    level = level.withColumn("below", F.sum("most").over(rising) - F.col("most")).withColumn("lists", F.count("*").over(item) - F.row_number().over(rising) + 1)
    level = level.withColumn("even", F.floor((F.floor(SHARE * F.col("bound")) - F.col("below")) / F.col("lists")))
    cap = F.min(F.when(F.col("even") < F.col("most"), F.struct("most", "term", "even"))).over(item)["even"]
    level = level.withColumn("cap", F.greatest(F.coalesce(cap, F.max("most").over(item)), F.lit(0)))
    level = cut(level.withColumn("others", F.sum(F.least("most", "cap")).over(item)).select("item_id", "term", "bound", "most", "cap", "others"), "thresholds")
    fetched = F.broadcast(level.where(F.col("most") > F.col("cap")))
    least = F.broadcast(level.where(F.col("most") > F.col("cap")).groupBy("term").agg(F.min("cap").alias("least")))
    # dealt by document before the queries multiply the entries: so their sums need no other shuffle
    above = posted.join(least, "term").where(F.col("adds") > F.col("least")).select("term", "uid", "adds").repartition("uid").join(fetched, "term").where(F.col("adds") > F.col("cap"))
    seen = above.groupBy("item_id", "uid").agg(F.sum("adds").alias("part"), F.count("*").alias("lists"), F.first("bound").alias("bound"), F.first("cap").alias("cap"), F.first("others").alias("others"))
    chosen = seen.where(F.col("part") + F.col("others") - F.col("lists") * F.col("cap") >= F.col("bound")).select("item_id", "uid")
    return _best(exact(cut(chosen, "candidates")), k, F.desc("score"), F.asc_nulls_first("doc_id"), "uid").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, head: int = HEAD, pairs: int = PAIRS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents with the highest scores above 0 for each item.

    Equal scores are ranked by doc_id, null first. A null text has no terms; an
    item without a term that some document holds has no row; an item's rows with
    one id ask for the terms of all of them, once each, and rows without an id
    are left out. Repeated rows of docs are documents of their own, ranked one
    after the other. Texts of any length are read whole; other columns are not
    read. An empty table on either side gives no rows."""
    since = mark()
    asked = cut(query_terms(items), "queries")
    blocks = max(1, -(-asked.count() // pairs))
    found = []
    for block in range(blocks):
        here = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else asked
        found.append(cut(_search(docs, here, k, max(k, head)), "best"))
    sweep(docs.sparkSession, since, *found)
    return reduce(DataFrame.unionByName, found)
