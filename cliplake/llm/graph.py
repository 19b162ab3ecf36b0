"""Connected components of a link table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mark, sweep


def components(links: DataFrame) -> DataFrame:
    """node, root: the least node of each component, for all nodes of `links` (a, b: long).

    Alternates two star steps until only stars are left: every node links its larger
    neighbours to its least one, then its smaller ones. That takes a logarithmic
    number of rounds; each round's links are written to the shared folder. Rows
    per round are at most the links; minima are combined before the shuffle.
    Without links there are no rows."""
    since = mark()
    both = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges = cut(both, "links")
    while not _stars(edges):
        sym = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = cut(sym.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("n"), F.least("hi", "m").alias("m")), "least")
        # larger neighbours v of n: v - m
        large = edges.join(least, F.col("lo") == F.col("n")).select("hi", F.col("m").alias("lo")).where("hi <> lo").distinct()
        large = cut(large, "large")
        down = cut(large.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("n"), "m"), "down")
        # smaller neighbours v of n, and n: to m
        small = large.join(down, F.col("hi") == F.col("n")).select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo")
        edges = cut(small.unionByName(down.select(F.col("n").alias("hi"), F.col("m").alias("lo"))).distinct(), "small")
    sweep(links.sparkSession, since, edges)
    nodes = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return nodes.unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one link at most to a smaller one, and none that has such a link is linked to by a larger one: then the smaller ends are the roots."""
    tops = edges.groupBy("hi").agg(F.count("*").alias("n"), F.lit(False).alias("low"))
    lows = edges.groupBy(F.col("lo").alias("hi")).agg(F.lit(0).cast("long").alias("n"), F.lit(True).alias("low"))
    nodes = tops.unionByName(lows).groupBy("hi").agg(F.max("n").alias("n"), F.count("*").alias("sides"))
    return nodes.where("n > 1 OR sides > 1").limit(1).count() == 0
