"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendreach.session import cut_lineage


def _mark(links: DataFrame) -> tuple:
    r = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(u, root) of every node with a link: root is the least node that can be reached.

    ``links`` has columns x and y of one ordered type; direction, repeats and loops do not matter. Each round
    is two passes of minimum and join over the links, stored in the shared folder; the number of rounds grows
    with the logarithm of the longest chain. A node of many links is one partial aggregate and a join that
    Spark splits.
    """
    both = F.col("x") != F.col("y")
    edges = cut_lineage(links.filter(both).select(
        F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "links")
    before = _mark(edges)
    for _ in range(rounds):
        if not before[0]:
            break
        # large star: every greater neighbour of a node goes to the least in the node's neighbourhood
        near = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        # small star: the lesser neighbours of a node, and the node, go to the least of them
        large = cut_lineage(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = cut_lineage(small.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        after = _mark(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return edges.select("u", F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())
