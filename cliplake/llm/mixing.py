"""Mixing sources to target weights by Sainte-Lague apportionment of token blocks.

DataFrame functions only. Plan: one scan gives each document's size, a sum per
source gives the targets, blocks of equal size go to the sources by highest
quotients, each source's blocks are dealt to its shards in proportion, and in a
shard the blocks are taken from the documents in a seeded order.

Scale: the shuffled rows hold an id, a source and a number. A shard is a prefix
of the seeded order, as long as needed for some thousand documents per shard,
so that a source with a third of all rows is dealt over many tasks. Sources may be
as many as domains: they are ranked in ranges, and the level of the targets, the
divisor of the blocks and the last rank that gets one more are searched for with
sums over the sources, of which the driver sees a few numbers a round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut, mark, small, sweep, text_of

WEIGHTS = (5, 2, 1)
REPEAT = 3
MAX_BLOCK = 256
SHARD_DOCS = 4096
SEED = "mix-1"


#: Points at which a search sums up in one round, and rounds after which doubles can't be told apart.
_POINTS, _ROUNDS = 63, 12


def ranked(sources: DataFrame, by: str) -> DataFrame:
    """sources with rank from 1, by code point, null last: in ranges, each of which counts on from those before."""
    order = F.col(by).asc_nulls_last()
    parts = cut(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    sizes = parts.groupBy("part").agg(F.count("*").alias("n"))  # one row per range: at most as many as partitions
    sizes = sizes.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("less"))
    place = F.row_number().over(W.partitionBy("part").orderBy(order))
    return parts.withColumn("place", place).join(small(sizes), F.col("part") == F.col("p")).withColumn("rank", (F.col("place") + F.col("less")).cast("int")).drop("part", "place", "p", "less")


def targets(sources: DataFrame, repeat: int = REPEAT, max_block: int = MAX_BLOCK) -> DataFrame:
    """source, rank, weight and source_size -> also target, blocks (quota) and block (words in one).

    target is min(repeat * source_size, level * weight) with the level at which
    the targets sum to the total size: it is raised, as sources stop at their
    bound, until no more do."""
    s = cut(sources.withColumn("cap_ratio", repeat * F.col("source_size") / F.col("weight")), "ranked")
    total = s.agg(F.sum("source_size")).collect()[0][0] or 0
    level, stopped = 0.0, -1
    while True:
        below = F.col("cap_ratio") < level
        n, size, weight = s.agg(F.count_if(below), F.coalesce(F.sum(F.when(below, F.col("source_size"))), F.lit(0)), F.coalesce(F.sum(F.when(~below, F.col("weight"))), F.lit(0))).collect()[0]
        if n == stopped or not weight:
            break
        level, stopped = (total - repeat * size) / float(weight), n
    s = s.withColumn("target", F.least(F.lit(float(repeat)) * F.col("source_size"), F.lit(level) * F.col("weight")))
    least = s.agg(F.min(F.when(F.col("target") > 0, F.col("target")))).collect()[0][0] or 0.0
    block = max(1, min(max_block, int(least // 200)))
    return _highest_quotients(s.select("source", "rank", "source_size", "docs", "target", F.lit(block).cast("long").alias("block")), total // block)


def _search(s: DataFrame, low: float, high: float, summed, fits, goal: int | None = None) -> float:
    """The least of the points between low and high, as near as doubles go, for which fits(sum of summed(point)) holds; it holds for high. A point whose sum is the goal ends the search."""
    for _ in range(_ROUNDS):
        points = [p for k in range(1, _POINTS + 1) if low < (p := low + (high - low) * k / (_POINTS + 1)) < high]
        if not points:
            break
        # the points are one literal array, so that the code of a round is compiled once
        at = s.select("*", F.posexplode(F.lit(points)).alias("at", "point"))
        found = {r["at"]: r["s"] for r in at.groupBy("at").agg(F.sum(summed(F.col("point"))).alias("s")).collect()}
        sums = [found.get(k, 0) for k in range(len(points))]
        if goal is not None and (met := [p for p, x in zip(points, sums) if (x or 0) == goal]):
            return met[0]
        good = [p for p, x in zip(points, sums) if fits(x or 0)]
        high = min(good, default=high)
        low = max([p for p in points if p < high], default=low)
    return high


def _highest_quotients(s: DataFrame, seats: int) -> DataFrame:
    """Deal `seats` to the rows by the highest target / (2 k + 1); ties go to the lower rank.

    A divisor is searched for, the least with which not too many seats are given;
    what is still left then goes to the highest next quotients, which are equal or
    nearly so, and of equal ones to the lowest ranks."""
    s = cut(s, "targets")
    total, n = s.agg(F.sum("target"), F.count_if(F.col("target") > 0)).collect()[0]
    total = float(total or 0.0)
    given = lambda d: F.floor(F.col("target") / d + 0.5)
    # rounding adds or takes at most half a seat a row
    high = total / (seats - n / 2) * (1 + 1e-9) if seats > n / 2 else total * 4 + 1
    divisor = _search(s, total / (seats + n / 2 + 1) * (1 - 1e-9), high, given, lambda x: x <= seats, seats)
    s = s.withColumn("sure", given(F.lit(divisor))).withColumn("next", F.col("target") / (2 * F.col("sure") + 1))
    left = seats - int(s.agg(F.sum("sure")).collect()[0][0] or 0)
    one = F.lit(0)
    if left > 0:
        # the quotient down to which rows surely get one, and the rank among those that have the next one
        bound = [0.0, left]  # rows above it, and how many get one at it
        top = s.agg(F.max("next")).collect()[0][0] or 0.0
        while True:
            n = s.agg(F.count_if(F.col("next") >= top)).collect()[0][0]
            if n >= left or not n:
                bound = [top, left - (s.agg(F.count_if(F.col("next") > top)).collect()[0][0])]
                break
            lower = s.where(F.col("next") < top).agg(F.max("next")).collect()[0][0]
            if lower is None:
                bound = [top, n]
                break
            top = lower
        ties = s.where(F.col("next") == bound[0])
        last = _search(ties, 0.0, float(2**31), lambda r: (F.col("rank") <= r).cast("int"), lambda x: x >= bound[1], bound[1])
        one = F.when((F.col("next") > bound[0]) | ((F.col("next") == bound[0]) & (F.col("rank") <= F.lit(last))), 1).otherwise(0)
    return s.select("source", "rank", "source_size", "docs", "target", "block", (F.col("sure") + one).alias("blocks"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, repeat: int = REPEAT, max_block: int = MAX_BLOCK, shard_docs: int = SHARD_DOCS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source, source_size, target, taken: one row per row of docs.

    The quota of a source is blocks * block words, at most repeat times its
    size. Null texts have size 0 and give nothing. Null sources are one source,
    the last. Rows that share a doc_id, or have none, are ordered by size and share
    nothing else. An empty table gives no rows; if no text has a word, all targets and
    all taken are 0."""
    since = mark()
    sizes = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), F.regexp_count(text_of(docs), F.lit(WORD)).cast("long").alias("size"))
    sizes = cut(sizes.withColumn("order", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))), "sizes")
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    by_source = ranked(by_source, "source")
    cycle = F.array(*[F.lit(w) for w in weights])
    by_source = by_source.withColumn("weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    quota = targets(by_source, repeat, max_block)
    digits = sum((F.when(F.col("docs") > shard_docs * 16**k, 1).otherwise(0) for k in range(12)), F.lit(0))  # of a hash: 16 times as many shards for each
    quota = cut(quota.withColumn("digits", digits).withColumnRenamed("source", "of"), "quota")

    sweep(docs.sparkSession, since, sizes, quota)
    rows = sizes.join(small(quota), F.col("source").eqNullSafe(F.col("of")), "left").drop("of", "docs")
    rows = rows.withColumn("shard", F.expr("left(`order`, digits)"))
    shards = rows.groupBy("rank", "shard").agg(F.sum("size").alias("shard_size"), F.first("source_size").alias("whole"), F.first("blocks").alias("blocks"), F.first("block").alias("block"))
    to_here = W.partitionBy("rank").orderBy("shard").rowsBetween(W.unboundedPreceding, 0)
    cum = F.sum("shard_size").over(to_here)

    def share(words: str) -> Column:
        """Blocks of the source up to so many of its words, in whole numbers."""
        return F.expr(f"CASE WHEN whole > 0 THEN (CAST(blocks AS DECIMAL(18,0)) * CAST({words} AS DECIMAL(18,0))) DIV CAST(whole AS DECIMAL(18,0)) ELSE 0 END")

    shards = shards.withColumn("cum", cum).withColumn("shard_blocks", share("cum") - share("(cum - shard_size)"))
    shards = shards.withColumn("shard_words", F.least(F.col("shard_blocks") * F.col("block"), repeat * F.col("shard_size")).cast("long"))
    shards = cut(shards.select(F.col("rank").alias("r"), F.col("shard").alias("s"), "shard_size", "shard_words"), "shards")
    # rows that agree in all that orders them are one until the end: without ids, the window holds the sizes that occur, not the rows
    same = rows.groupBy("rank", "shard", "order", "size", "doc_id", "source", "source_size", "target").agg(F.count("*").alias("copies"))
    same = same.join(shards, (F.col("rank") == F.col("r")) & (F.col("shard") == F.col("s")), "left")
    ahead = W.partitionBy("rank", "shard").orderBy("order", "size", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    same = same.withColumn("ahead", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(ahead), F.lit(0)))
    each = same.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    before = F.col("ahead") + F.col("copy") * F.col("size")
    turns = F.when(F.col("shard_size") > 0, F.floor(F.col("shard_words") / F.col("shard_size"))).otherwise(0)
    over = F.col("shard_words") - turns * F.col("shard_size")
    taken = turns * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), over - before))
    return each.select("doc_id", "size", "source", "source_size", "target", taken.cast("long").alias("taken"))
