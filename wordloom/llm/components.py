"""Connected components of a graph too large for one machine.

Alternating large-star and small-star steps: every node is tied to the smallest
node it knows, first by its larger neighbours, then by its smaller ones, until
nothing changes. Each step is a minimum per node, added up before the shuffle,
and a join with that minimum. The minima are stored first, so that both sides of
the join are plain shuffles, or one is small enough to be sent everywhere: only
then can adaptive execution split the rows of a hot node between tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) with u > v; larger neighbours move to the smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    moved = both.join(least, "u").where("v > u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``links`` (a, b); the component is its least node.

    Each round is stored in the shared folder. Rounds grow with the logarithm of
    a component's size.
    """
    a, b = F.col("a"), F.col("b")
    edges = stored(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "edges",
    )
    state = None
    while True:
        now = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")
        ).first()
        if now == state or now["n"] == 0:
            break
        state = now
        edges = stored(_small_star(stored(_large_star(edges), "edges")), "edges")
    roots = edges.select(F.col("v").alias("u")).distinct()
    return edges.unionByName(roots.select("u", F.col("u").alias("v"))).toDF("node", "component")


def joined_components(known: DataFrame, links: DataFrame) -> DataFrame:
    """``node, component`` when further ``links`` (a, b) join the stored components ``known``.

    Only the components that the links tie to each other are looked at again: a link
    becomes one between its ends' components, a node without one being its own.
    """
    of = lambda side: known.select(
        F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    tied = stored(components(ends), "joined")
    over = tied.select(F.col("node").alias("component"), F.col("component").alias("least"))
    moved = known.join(over, "component", "left").select(
        "node", F.coalesce("least", "component").alias("component"))
    return moved.unionByName(tied.join(known.select("node"), "node", "left_anti"))
