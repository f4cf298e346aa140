"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import by_shuffle

#: Edges, as counted, up to which a round's tables are broadcast: two minima
#: an edge at most, of two numbers each.
BROADCAST_EDGES = 200_000


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``): for every node of ``edges`` (``u``, ``v``) the
    smallest node that it is connected to.

    Alternating large-star and small-star rounds: each links a node's
    neighbours to the smallest of them, so the number of edges never grows
    and the rounds grow with the logarithm of the graph. A hub with a great
    many edges is only ever reduced by ``min`` (combined before the shuffle)
    and joined to that minimum, by shuffle if there are more than
    ``BROADCAST_EDGES`` edges. Each round is a table in the shared checkpoint
    folder.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    e = cut_lineage(e, "components")
    while n := e.count():
        minima = F.broadcast if n <= BROADCAST_EDGES else by_shuffle
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
        large = both.filter("v > u").join(minima(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(minima(least), "u")
        new = (small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                    .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        new = cut_lineage(new, "components")
        # Done when the edges are stars: no child is a parent, no child has two.
        done = new.select(F.col("v").alias("u")).join(minima(new), "u", "left_semi").isEmpty()
        e = new
        if done and e.groupBy("u").count().filter("count > 1").isEmpty():
            break
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
