"""Connected components of an edge table, by alternating star contraction.

Each round links every node to the least neighbour of its centre, first over
all neighbours (large star), then over smaller ones (small star), until nothing
changes. Rounds grow with the logarithm of a component's size. Only minima are
aggregated, which combine before the shuffle. They are stored in the shared
checkpoint folder and joined from there: both sides of the join are then plain
shuffles, which adaptive execution splits where a hub holds a large share of
all edges (it can't split a side that an aggregate has just dealt).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecraft.llm.tools import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m")), "least")
    near = both.join(least, both.u == least.c)
    return near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stored(down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m"), "least")
    near = down.join(least, down.u == least.c).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.where("u <> v").unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v; any ordered type) to (node, component), the component
    named by its least node. Nodes without edges don't appear; loops are ignored."""
    now = stored(edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").select("u", "v").distinct(), "edges")
    before = None
    while True:
        now = stored(_small_star(stored(_large_star(now), "edges")), "edges")
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def joined_components(comps: DataFrame, edges: DataFrame) -> DataFrame:
    """``comps`` (node, component) with the components that ``edges`` (u, v) connect made one. The edges
    are drawn between whole components, so only as many rows as there are edges go through the rounds."""
    def end(side: str) -> DataFrame:
        return comps.select(F.col("node").alias(side), F.col("component").alias(f"{side}c"))

    ends = stored(edges.join(end("u"), "u", "left").join(end("v"), "v", "left")
                  .select("u", "v", F.coalesce("uc", "u").alias("uc"), F.coalesce("vc", "v").alias("vc")), "edges")
    up = stored(components(ends.select(F.col("uc").alias("u"), F.col("vc").alias("v")))
                .select(F.col("node").alias("was"), F.col("component").alias("root")), "roots")
    nodes = comps.select("node", "component").unionByName(
        ends.select(F.col("u").alias("node"), F.col("uc").alias("component"))).unionByName(
        ends.select(F.col("v").alias("node"), F.col("vc").alias("component"))).distinct()
    return nodes.join(up, nodes.component == up.was, "left").select("node", F.coalesce("root", "component").alias("component"))
