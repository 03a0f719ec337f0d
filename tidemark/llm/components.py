"""Connected components of a graph given by its edges, as joins and aggregations.

Large and small stars by turns: each round links a node's neighbours to the smallest one nearby, so that paths shrink until every component is
a star around its smallest node. Hubs cost no more than their edges: minima are taken before the shuffle, and joins are left to
Spark's skew join. Each round is stored in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import release, settle


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi > lo").distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum("lo"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component: for each node that has an edge, the smallest node it is linked with.

    ``edges`` has the columns a and b (long, not null); loops and repeated edges do no harm.
    """
    pairs = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi > lo").distinct()
    now = settle(pairs, "edges")
    seen = _print(now)
    while seen[0]:
        new = settle(_small(_large(now)), "edges")
        release(now)
        now, before, seen = new, seen, _print(new)
        if before == seen:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(now.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()
