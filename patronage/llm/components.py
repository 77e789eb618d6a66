"""Connected components of a distributed edge list.

Alternating large-star and small-star rounds: every round replaces the edges
by links to smaller neighbours and ends when the edges form stars around each
component's smallest node. A hub only ever enters a partial ``min`` and a join
whose hot side AQE splits; no neighbour list is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import cut


def _summary(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")),
                F.bit_xor(F.xxhash64("lo", "hi"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(u long, v long) -> (node, component): one row per node that has an
    edge to another node, with the smallest node reachable from it. Loops,
    repeated edges and edges with a null end are ignored."""
    e = cut(edges.select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo"))
            .where("u is not null and v is not null and hi <> lo").distinct())
    seen = _summary(e)
    while seen[0]:
        both = e.select(F.col("hi").alias("n"), F.col("lo").alias("m")).unionByName(
            e.select(F.col("lo").alias("n"), F.col("hi").alias("m")))
        least = both.groupBy("n").agg(F.least("n", F.min("m")).alias("r"))
        large = (e.join(least, e.lo == least.n).select("hi", F.col("r").alias("lo"))
                 .unionByName(least.where("n <> r").select(F.col("n").alias("hi"), F.col("r").alias("lo")))
                 .distinct())
        low = large.groupBy("hi").agg(F.min("lo").alias("r"))
        small = (large.join(low, "hi").where("lo <> r")
                 .select(F.col("lo").alias("hi"), F.col("r").alias("lo"))
                 .unionByName(low.select("hi", F.col("r").alias("lo"))))
        e = cut(small.distinct())
        now = _summary(e)
        if now == seen:
            break
        seen = now
    star = e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return star.unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()
