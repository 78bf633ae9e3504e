"""Connected components of a graph of any size, by alternating large-star and small-star steps.

Every step gives each node's larger (or smaller-or-equal) neighbours to its smallest neighbour; both are
one pre-aggregated minimum and one join on the node, which Spark may split when a node has very many
neighbours. A component ends as a star around its smallest node, after about log(n)**2 steps at worst.
The edges of a step are stored in the shared folder; only their count and checksum reach the driver.
Edges that make stars already need the fewest steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from landgate.llm.tables import stored


def _step(edges: DataFrame, purpose: str) -> tuple[DataFrame, tuple]:
    """The edges stored, and their count and checksum, taken by the tasks that write them."""
    seen = Observation()
    mark = F.xxhash64("a", "b").cast("decimal(38,0)")
    edges = stored(edges.observe(seen, F.count("*").alias("n"), F.sum(mark).alias("mark")), purpose)
    return edges, (seen.get["n"], seen.get["mark"])


def _to_smallest(links: DataFrame, strictly_larger: bool) -> DataFrame:
    """links (u, v): v gets an edge to the smallest of u and its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    joined = links.join(least, "u")
    if strictly_larger:
        return joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    kept = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
    return kept.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component) for every end of an edge (a, b) of longs; component is its smallest node.

    Loops, repeated edges and edges in both directions are fine; an edge with a null end is no edge;
    without edges the result is empty.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = edges.filter("a IS NOT NULL AND b IS NOT NULL")
    loops = edges.filter("a = b").select(F.col("a").alias("node")).distinct()
    edges = edges.filter("a <> b").select(larger.alias("a"), smaller.alias("b")).distinct()
    edges, before = _step(edges, purpose)
    while before[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        stars = _to_smallest(both, strictly_larger=True)
        down = stars.select(F.col("a").alias("u"), F.col("b").alias("v"))
        edges = _to_smallest(down, strictly_larger=False).filter("a <> b").distinct()
        edges, after = _step(edges, purpose)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    alone = loops.select("node", F.col("node").alias("component"))
    return stars.union(centres.union(alone)).groupBy("node").agg(F.min("component").alias("component"))
