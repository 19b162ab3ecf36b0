"""N-gram Jaccard join by a MinHash LSH forest, verified exactly.

A document is the set of its runs of five words (lower case; a shorter document
is one run). TREES labels of MAX_DEPTH minimum hashes put each set into as many
prefix tries. The prefix of its labels that must match starts at MAX_DEPTH and is
shortened, for each document, until any partner that it can have meets it in some
trie with probability RECALL: sets of few runs can only have some similarities
above the threshold, so their prefixes stay long, and sets too small for any have
no partner but copies. A node of a trie is known by the hash of its path, so that
documents with a common prefix, which stand together in the order of labels, meet
in a group instead of a sort. A node of more than NODE sets is split by the next
minimum of its label, again and again, which finds most of its candidates early;
what that leaves apart under the node is then compared pair by pair, in blocks, so
that a split loses nothing. Sets that meet under a node are candidates
of each other if all their minima agree as often as those of a pair at the
threshold do, but for SIGMAS standard deviations: sets that share some boilerplate
meet, but are no candidates, and don't chain others together. Within the groups
that candidates form, the sets are rebuilt and every pair is counted exactly; links
of Jaccard similarity THRESHOLD or more join documents into classes.

Scale: equal sets are one row from the start, with a number of copies, so a group
of copies makes no pairs. A meeting adds one row per member and node, never the
pairs. Large groups are cut into size bands (similar sets differ little in size)
and blocks, of BLOCK_SETS sets at most; a task holds two blocks. Pairs are counted
inside a task and leave it as one row per set. A node's members meet as sketches of
a byte a minimum; of a large node, those outside its largest group of candidates
meet all others in blocks of MANY * NODE at most, in bounded memory, at worst with
the square of such a node's size. Text moves once to meet its group,
and again only for sets that have candidates: once for each block of its group,
so that a group of M sets moves SPREAD or M / BLOCK_SETS times its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, keyed, mark, maybe_in, small, sweep
from .graph import components

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
MAX_DEPTH = 8
RECALL = 0.999
#: Most sets that meet under a node; larger ones are split.
NODE = 1024
#: Blocks of what a split leaves apart hold so many times NODE sketches at most, and fewer until there are so many PARTS.
MANY, PARTS = 16, 8
#: A pair at the threshold agrees less than by so many deviations once in 3 million.
SIGMAS = 5.0
#: Most sets in a block, and most runs.
BLOCK_SETS = 1024
BLOCK_GRAMS = 1 << 19
#: Blocks are smaller, of FEW_SETS or more, until there are SPREAD of them: enough tasks for one group, and text does not move more often.
FEW_SETS = 64
SPREAD = 20
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def depth(similarity: float = THRESHOLD, recall: float = RECALL) -> int:
    """The longest prefix with which a pair of this similarity meets in some trie with probability `recall`; 1 at least."""
    at = MAX_DEPTH
    while at > 1 and 1 - (1 - similarity**at) ** TREES < recall:
        at -= 1
    return at


def least_similarity(n: int, threshold: float = THRESHOLD) -> float | None:
    """The least similarity of at least the threshold, but below 1, that a set of n runs can have with another; None if there is none."""
    found = None
    for m in range(int(np.ceil(threshold * n - 1e-9)), int(np.floor(n / threshold + 1e-9)) + 1):
        both = int(np.ceil(threshold * (n + m) / (1 + threshold) - 1e-9))  # runs that they must share
        if 0 < both <= min(n, m):
            similarity = both / (n + m - both)
            if similarity == 1:
                continue
            found = similarity if found is None else min(found, similarity)
    return found


class Depths:
    """The depths at which a set of n runs looks for partners: its own, and those, if greater, of sets that may be partners."""

    #: Above so many runs the least similarity is the threshold, but for a few thousandths.
    SMALL = 200

    def __init__(self, threshold: float = THRESHOLD, recall: float = RECALL):
        self.floor = depth(threshold, recall)
        least = [least_similarity(n, threshold) for n in range(int(self.SMALL / threshold) + 2)]
        own = [0 if x is None else depth(x, recall) for x in least]
        reach = lambda n: own[max(0, int(np.ceil(threshold * n - 1e-9))) : int(np.floor(n / threshold + 1e-9)) + 1]
        self.small = [sorted({own[n]} | {d for d in reach(n) if d > own[n]}) if own[n] else [] for n in range(self.SMALL)]

    def __call__(self, n: int) -> list[int]:
        return self.small[n] if n < self.SMALL else [self.floor]


def grams(text: str, seen: dict[bytes, int], n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of n words. seen: hashes of words, kept between calls, emptied if it grows."""
    words = text.lower().encode("utf-8", "surrogatepass").split()  # of bytes: at space and \\x09-\\x0d only
    if not words:
        return np.zeros(0, np.uint64)
    if len(seen) > 500_000:
        seen.clear()
    get, digest = seen.get, xxhash.xxh64_intdigest
    out = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = get(w)
        if h is None:
            h = seen[w] = digest(w)
        out[i] = h
    m = min(n, len(words))
    run = out[: len(words) - m + 1] + np.uint64(m)
    for k in range(1, m):
        run = (run ^ (run >> np.uint64(29))) * _MULTIPLY + out[k : len(words) - m + 1 + k]
    run = (run ^ (run >> np.uint64(32))) * _MULTIPLY
    return np.unique(run ^ (run >> np.uint64(29)))


def signature(sets: np.ndarray, count: int) -> np.ndarray:
    """`count` minimum hashes of 32 bits."""
    rng = np.random.default_rng(20)
    a = rng.integers(1, 1 << 62, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 62, count, dtype=np.uint64)
    least = np.full(count, np.uint64(0xFFFFFFFFFFFFFFFF))
    for k in range(0, len(sets), 2048):
        np.minimum(least, (sets[k : k + 2048, None] * a + b).min(0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def nodes(sig: np.ndarray, levels: list[int]) -> np.ndarray:
    """Hashes of the paths of TREES labels (of MAX_DEPTH minima each) at the given depths."""
    labels = sig.reshape(TREES, MAX_DEPTH).astype(np.uint64)
    out, path = [], np.arange(1, TREES + 1, dtype=np.uint64) * _MULTIPLY
    for k in range(max(levels, default=0)):
        path = (path ^ (path >> np.uint64(29))) * _MULTIPLY + labels[:, k]
        if k + 1 in levels:
            end = (path ^ (path >> np.uint64(32))) * _MULTIPLY + np.uint64(k + 1)
            out.append(end ^ (end >> np.uint64(29)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def sets_of(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, row_hash, cls (hash of the set; null without words), n (its size), nodes (hashes of its nodes in the tries, TREES for each of levels), levels, sketch (a byte of each minimum)."""
    depths = Depths(threshold, recall)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for b in batches:
            cls, n, found, depth_of, sketch = [], [], [], [], []
            for t in b.column(2):
                g = grams(t.as_py(), seen)
                n.append(len(g))
                cls.append(xxhash.xxh64_intdigest(g.tobytes()) - (1 << 63) if len(g) else None)
                levels = depths(len(g))
                sig = signature(g, TREES * MAX_DEPTH) if levels else None
                found.append(nodes(sig, levels).view(np.int64) if levels else [])
                depth_of.append(levels)
                sketch.append(sig.astype(np.uint8).tobytes() if levels else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cls, pa.int64()), pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(depth_of, pa.list_(pa.int32())), pa.array(sketch, pa.binary())], names=["doc_id", "row_hash", "cls", "n", "nodes", "levels", "sketch"])

    return keyed(docs).select("doc_id", "row_hash", "text").mapInArrow(run, "doc_id long, row_hash long, cls long, n long, nodes array<long>, levels array<int>, sketch binary")


def agreement(threshold: float = THRESHOLD) -> float:
    """Share of equal bytes of two sketches from which on the sets are candidates."""
    minima = TREES * MAX_DEPTH
    return threshold - SIGMAS * float(np.sqrt(threshold * (1 - threshold) / minima))


def agree(sketches: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Share of equal bytes of each sketch and the other one, or its own other one; sketches of whole eights of bytes, below 256."""
    words = (sketches == other).view(np.uint64).sum(axis=1)  # eight counts, a byte each
    return ((words * np.uint64(0x0101010101010101)) >> np.uint64(56)) / sketches.shape[1]


def near(sketches: np.ndarray, least: float) -> np.ndarray:
    """For each set the index of the first set of its group: sets that agree in the share `least` of their sketch's bytes, and those connected by such."""
    k = len(sketches)
    first = np.full(k, -1, np.int64)
    rest, held = np.arange(k), sketches
    for i in range(k):
        if first[i] >= 0:
            continue
        first[i], front = i, [i]
        at = np.searchsorted(rest, i, side="right")
        rest, held = rest[at:], held[at:]  # views: sets without partners are not copied
        while front and len(rest):
            ok = agree(held, sketches[front.pop()]) >= least
            if ok.any():
                first[rest[ok]] = i
                front += rest[ok].tolist()
                rest, held = rest[~ok], held[~ok]
    return first


def _candidates(held: DataFrame, least: float) -> DataFrame:
    """b, a: candidates under the nodes of held(prefix, cls, sketch), each linked to the least of its group; a node's rows are no more than NODE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def decide(prefix: np.ndarray, cls: np.ndarray, sketch: np.ndarray) -> pa.RecordBatch:
            begin = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
            size = np.diff(np.r_[begin, len(prefix)])
            two = begin[size == 2]
            two = two[agree(sketch[two], sketch[two + 1]) >= least]
            b, a = [cls[two + 1]], [cls[two]]
            for at, k in zip(begin[size > 2].tolist(), size[size > 2].tolist()):
                own = cls[at : at + k]
                first = near(sketch[at : at + k], least)
                other = first != np.arange(k)
                b.append(own[other])
                a.append(own[first[other]])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(b)), pa.array(np.concatenate(a))], names=["b", "a"])

        for batch in batches:
            if not batch.num_rows:
                continue
            sketch = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            wait.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), sketch))
            prefix, cls, sketch = (np.concatenate(x) for x in zip(*wait))
            last = int(np.searchsorted(prefix, prefix[-1]))
            wait = [(prefix[last:], cls[last:], sketch[last:])]  # the last node may go on
            if last:
                yield decide(prefix[:last], cls[:last], sketch[:last])
        if wait:
            yield decide(*wait[0])

    rows = held.select("prefix", "cls", "sketch").repartition("prefix").sortWithinPartitions("prefix", "cls")
    return rows.mapInArrow(run, "b long, a long")


def _to_least(held: DataFrame, bytes_of: DataFrame, share: float) -> DataFrame:
    """b, a: of held(cls, least: the least set of its node), those that are candidates of the least one, linked to it."""
    pairs = held.where("cls <> least").select("cls", "least").distinct()
    first = pairs.select("least").distinct().join(bytes_of, F.col("least") == F.col("of")).select(F.col("least").alias("l"), F.col("sketch").alias("other"))
    rows = pairs.join(bytes_of, F.col("cls") == F.col("of")).join(small(first), F.col("least") == F.col("l")).select("cls", "least", "sketch", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own, other = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(b.num_rows, -1) for k in (2, 3))
                ok = pa.array(agree(own, other) >= share)
                yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], names=["b", "a"])

    return rows.mapInArrow(run, "b long, a long")


def meetings(sets: DataFrame, least: float, node: int = NODE) -> DataFrame:
    """b, a: candidate links among sets(cls, nodes, levels, sketch), enough to connect all candidates.

    A node of more than `node` sets is split by the next minimum of its label; a node
    whose whole label is shared is not split any more, and candidates of its least set
    are linked to that. Pairs that this leaves apart are looked for by _remaining()."""
    place = sets.select("cls", "levels", F.posexplode("nodes").alias("p", "prefix"))
    place = place.select("cls", "prefix", (F.col("p") % TREES).alias("tree"), F.element_at("levels", (F.col("p") / TREES).cast("int") + 1).alias("depth"))
    bytes_of = sets.select(F.col("cls").alias("of"), "sketch")
    found, whole = None, None
    while place is not None:
        met = place.groupBy("prefix").agg(F.count("*").alias("size"), F.min("cls").alias("least"), F.max("cls").alias("most")).where("least <> most")
        met = cut(met.select(F.col("prefix").alias("p"), "size", "least"), "met")
        held = cut(place.join(met, F.col("prefix") == F.col("p")).drop("p"), "held")
        few = held.where(F.col("size") <= node).join(bytes_of, F.col("cls") == F.col("of"))
        large = held.where(F.col("size") > node)
        links, place = _candidates(few, least), None
        if large.limit(1).count():
            whole = large.select("prefix", "cls") if whole is None else whole  # of the first round, before any split
            links = links.unionByName(_to_least(large.where(F.col("depth") >= MAX_DEPTH), bytes_of, least))
            large = large.where(F.col("depth") < MAX_DEPTH).join(bytes_of, F.col("cls") == F.col("of"))
            label = F.substr("sketch", F.col("tree") * MAX_DEPTH + F.col("depth") + 1, F.lit(1))
            place = cut(large.select("cls", F.xxhash64("prefix", label).alias("prefix"), "tree", (F.col("depth") + 1).alias("depth")), "split")
            place = place if place.limit(1).count() else None
        links = cut(links.distinct(), "meetings")
        found = links if found is None else found.unionByName(links)
    if whole is None:
        return found.distinct()
    group = cut(components(found).select(F.col("node").alias("b"), F.col("root").alias("a")), "grouped")
    return group.unionByName(_remaining(whole, bytes_of, group, least, node)).distinct()


def _remaining(whole: DataFrame, bytes_of: DataFrame, group: DataFrame, least: float, block: int) -> DataFrame:
    """b, a: candidate links between groups(b, a: set and root) under the nodes of whole(prefix, cls), exact by sketch.

    A node's sets outside its largest group are compared with all of its sets, in
    tasks of two blocks of about MANY * `block` sets at most; a node of one group has none."""
    held = whole.join(group.select(F.col("b").alias("of"), "a"), F.col("cls") == F.col("of"), "left")
    held = cut(held.select("prefix", "cls", F.coalesce("a", "cls").alias("root")), "large")
    parts = held.groupBy("prefix", "root").agg(F.count("*").alias("n"))
    plan = parts.groupBy(F.col("prefix").alias("p")).agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n")).where("n > most.n")
    blocks = lambda n: F.greatest(F.ceil(n / F.lit(MANY * block)), F.least(F.lit(PARTS), F.ceil(n / F.lit(block)))).cast("int")
    plan = cut(plan.select("p", F.col("most.root").alias("main"), blocks(F.col("most.n")).alias("mains"), blocks(F.col("n") - F.col("most.n")).alias("rests")), "plan")
    rows = held.join(plan, F.col("prefix") == F.col("p")).withColumn("inside", F.col("root") == F.col("main"))
    rows = rows.withColumn("i", F.pmod(F.xxhash64("cls"), F.when(F.col("inside"), F.col("mains")).otherwise(F.col("rests"))).cast("int"))
    i, upto = F.col("i"), lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    key = lambda kind, x, y: F.concat_ws(":", "prefix", F.lit(kind), x, y)
    own = F.concat(F.transform(upto("rests"), lambda j: key("rest", F.least(i, j), F.greatest(i, j))), F.transform(upto("mains"), lambda j: key("main", i, j)))
    tasks = F.when(F.col("inside"), F.transform(upto("rests"), lambda j: key("main", j, i))).otherwise(own)
    rows = rows.join(bytes_of, F.col("cls") == F.col("of")).select("cls", "inside", "sketch", F.explode(tasks).alias("key"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cls")
        sketch = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(len(pdf), -1)
        cls, inside = pdf["cls"].to_numpy(), pdf["inside"].to_numpy(bool)
        if not inside.any():
            first = near(sketch, least)
            other = first != np.arange(len(cls))
            return pd.DataFrame({"b": cls[other], "a": cls[first[other]]})
        main, of, links = sketch[inside], cls[inside], []
        for k in np.flatnonzero(~inside):  # one link to the largest group is enough
            ok = agree(main, sketch[k]) >= least
            if ok.any():
                links.append((cls[k], of[ok.argmax()]))
        return pd.DataFrame(links, columns=["b", "a"], dtype=np.int64)

    return cut(rows.groupBy("key").applyInPandas(run, "b long, a long"), "remaining")


def _count_links(sets: list[np.ndarray], copies: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each set and the least index linked to it, over pairs of left x right (both may hold a set)."""
    m = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(m), size)
    flat = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    value, held = flat[order], owner[order]
    new = np.r_[True, value[1:] != value[:-1]] if len(value) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    starts = np.r_[np.flatnonzero(new), len(value)]
    of = np.empty(len(value), np.int64)
    of[order] = group
    begin = np.r_[0, np.cumsum(size)]
    links, root = np.zeros(m, np.int64), np.arange(m)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in np.flatnonzero(left):
        g = of[begin[i] : begin[i + 1]]
        g = g[starts[g + 1] - starts[g] > 1]
        if not len(g):
            continue
        n = starts[g + 1] - starts[g]
        at = np.repeat(starts[g] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        both = np.bincount(held[at], minlength=m)
        ok = right & (both >= threshold * (size[i] + size - both) - 1e-9)
        ok[i] = False
        to = np.flatnonzero(ok)
        if left[i] and right[i]:  # within a block each pair shows twice
            to = to[to > i]
        links[i] += copies[to].sum()
        links[to] += copies[i]
        for j in to:
            a, b = find(i), find(int(j))
            if a != b:
                root[max(a, b)] = min(a, b)
    return links, np.array([find(i) for i in range(m)], np.int64)


def _verify(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        seen: dict[bytes, int] = {}
        pdf = pdf.sort_values("cls")
        sets = [grams(t, seen) for t in pdf["text"]]
        side = pdf["side"].to_numpy()
        links, root = _count_links(sets, pdf["copies"].to_numpy(), side != 1, side != 0, threshold)
        cls = pdf["cls"].to_numpy()
        return pd.DataFrame({"cls": cls, "links": links, "to": cls[root]})

    return run


def _groups(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """members (cls, root, n, copies) -> a row per set and task: key, side (0 first block, 1 second, 2 the only one).

    Sizes of linked sets differ by 1 / threshold at most, so that they lie in one band or in neighbours."""
    ratio = float(-np.log(min(threshold, THRESHOLD)))
    members = members.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / ratio + 1e-9).cast("int"))
    bands = members.groupBy("root", "band").agg(F.count("*").alias("sets"), F.sum("n").alias("grams"))
    total = bands.groupBy("root").agg(F.sum("sets").alias("sets"), F.sum("grams").alias("grams"))
    total = total.select("root", ((F.col("sets") <= FEW_SETS) & (F.col("grams") <= BLOCK_GRAMS)).alias("one"))
    bands = bands.withColumn("nb", F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("grams") / BLOCK_GRAMS), F.least(F.lit(SPREAD), F.ceil(F.col("sets") / FEW_SETS))).cast("int"))
    # the neighbouring band's number of blocks: one row per band, few bands per group
    by_band = W.partitionBy("root").orderBy("band")
    near = lambda f, d: F.when(f("band").over(by_band) == F.col("band") + d, f("nb").over(by_band)).otherwise(0)
    bands = bands.select("root", "band", "nb", near(F.lead, 1).alias("after"), near(F.lag, -1).alias("before"))
    plan = cut(bands.join(total, "root").select(F.col("root").alias("of"), F.col("band").alias("b"), "nb", "after", "before", "one"), "bands")
    rows = members.join(plan, (F.col("root") == F.col("of")) & (F.col("band") == F.col("b")))
    rows = rows.withColumn("i", F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int"))
    key = lambda b1, i1, b2, i2, side: F.struct(F.concat_ws(":", "root", b1, i1, b2, i2).alias("key"), side.alias("side"))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    band, i = F.col("band"), F.col("i")
    own = F.transform(upto(F.col("nb")), lambda j: key(band, F.least(i, j), band, F.greatest(i, j), F.when(i == j, 2).when(i < j, 0).otherwise(1)))
    after = F.transform(upto(F.col("after")), lambda j: key(band, i, band + 1, j, F.lit(0)))
    before = F.transform(upto(F.col("before")), lambda j: key(band - 1, j, band, i, F.lit(1)))
    only = F.array(key(F.lit("all"), F.lit(0), F.lit("all"), F.lit(0), F.lit(2)))
    tasks = F.when(F.col("one"), only).otherwise(F.concat(own, after, before))
    return rows.select("cls", "copies", F.explode(tasks).alias("t")).select("cls", "copies", "t.key", "t.side")


def classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, row_hash, cls, class_id (least doc_id of the class), n_links, n_copies: a row per row of docs.

    n_links counts the other rows of similarity `threshold` or more, copies
    included. Null, empty and blank texts have no words: each is a class of its
    own, without links. Rows that share a doc_id are separate documents. Texts of
    any length are read whole; an empty table gives no rows. The order of rows and
    the other columns have no effect."""
    since = mark()
    rows = cut(sets_of(docs, threshold, recall), "sets")
    sets = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.count("*").alias("copies"), F.min("row_hash").alias("row_hash"), *[F.first(c).alias(c) for c in ("n", "nodes", "levels", "sketch")])
    sets = cut(sets, "distinct")
    star = meetings(sets, agreement(threshold))
    group = components(star)
    members = cut(sets.drop("nodes", "levels", "sketch").join(group, F.col("cls") == F.col("node")).select("cls", "root", "n", "copies", "row_hash"), "members")
    tasks = _groups(members, threshold)
    text = maybe_in(keyed(docs), "row_hash", members, "row_hash").select(F.col("row_hash").alias("h"), "text")
    text = members.select("cls", "row_hash").join(text, F.col("row_hash") == F.col("h")).groupBy("cls").agg(F.first("text").alias("text"))
    text = cut(text.select(F.col("cls").alias("c"), "text"), "texts")
    jobs = tasks.join(text, F.col("cls") == F.col("c")).select("key", "cls", "copies", "side", "text")
    found = cut(jobs.groupBy("key").applyInPandas(_verify(threshold), "cls long, links long, to long"), "links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    root = components(found.select(F.col("cls").alias("a"), F.col("to").alias("b")))
    known = sets.select("cls", "copies").join(links, "cls", "left").join(root.select(F.col("node").alias("cls"), "root"), "cls", "left")
    known = cut(known.select(F.col("cls").alias("c"), "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cls").alias("root")), "known")
    out = rows.drop("nodes", "n", "levels", "sketch").join(known, F.col("cls") == F.col("c"), "left")
    out = cut(out.select("doc_id", "row_hash", "cls", "root", (F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0))).alias("n_links"), F.coalesce("copies", F.lit(1)).alias("n_copies")), "rooted")
    first = cut(out.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("class_id")).select(F.col("root").alias("r"), "class_id"), "first")
    sweep(docs.sparkSession, since, out, first)
    out = out.join(first, F.col("root") == F.col("r"), "left")
    return out.select("doc_id", "row_hash", "cls", "root", F.coalesce("class_id", "doc_id").alias("class_id"), "n_links", "n_copies")


def keep_first(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, of which each class keeps the one with the least doc_id.

    Null doc_ids come last. Of rows with that doc_id the one with the least hash of
    its text stays; of rows that agree in both, one, the least by a hash of all
    columns. Documents without words all stay."""
    since = mark()
    found = classes(docs, threshold)
    ties = found.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash")).alias("first"))
    keep = ties.select("first.doc_id", "first.row_hash", F.lit(False).alias("all")).unionByName(found.where("root IS NULL").select("doc_id", "row_hash", F.lit(True).alias("all")).distinct())
    keep = cut(keep.select(F.xxhash64("doc_id", "row_hash").alias("k"), "all"), "keep")
    sweep(docs.sparkSession, since, keep)
    names = docs.columns
    key = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    hashed = F.xxhash64(F.col("row.doc_id").cast("long"), F.coalesce(F.col("row.text").cast("string"), F.lit("")))
    key = key.withColumn("of", F.xxhash64(F.col("row.doc_id").cast("long"), hashed)).withColumn("order", F.xxhash64("row"))
    got = key.join(keep, F.col("of") == F.col("k"))
    got = got.withColumn("turn", F.row_number().over(W.partitionBy("of").orderBy("order")))
    return got.where((F.col("turn") == 1) | F.col("all")).select("row.*")
