"""Distributed connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

Every step is a grouped minimum and a join, so no component is ever held by one task or by the driver. Each round's
edges are written to the shared folder: the plan stays short and a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollweave.llm.common import Scratch


SALTS = 32


def _with_least(edges: DataFrame) -> DataFrame:
    """edges (u, v) with m, the least neighbour of u or u itself. Hubs are met in SALTS parts, cut by v."""
    cut = edges.select("u", "v", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int").alias("salt"))
    part = cut.groupBy("u", "salt").agg(F.min("v").alias("m"))
    least = part.groupBy("u").agg(F.min("m").alias("m"), F.collect_list("salt").alias("salts"))
    least = least.select("u", F.least("u", "m").alias("m"), F.explode("salts").alias("salt"))
    return cut.join(least, ["u", "salt"]).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked with u's least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked with the least of them. edges: (u, v) with u > v."""
    known = _with_least(edges)
    pairs = F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
    return known.select(F.explode(pairs).alias("e")).select("e.u", "e.v").where("u != v")


def connected_components(links: DataFrame, scratch: Scratch, most_rounds: int = 60, size: int | None = None) -> DataFrame:
    """(a, b) links -> (node, component), the component named by its least node.

    Nodes are those that a link names; null ends and self-links add nothing but the node itself. Repeated links and
    links in both directions count once. Raises if it hasn't settled after ``most_rounds``, which needs more nodes than
    fit a cluster (rounds grow with the logarithm of the longest path). ``size``: bytes that links have at most (see keep).
    """
    links = links.select("a", "b").where("a is not null and b is not null")
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    edges = scratch.keep(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges", size
    )
    before = None
    for _ in range(most_rounds):
        stars = scratch.keep(_small_star(_large_star(edges)).distinct(), "stars", size)
        scratch.drop(edges)
        edges = stars
        # Settled when no node is both a child and a parent: every component is a star around its least node.
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
    else:
        raise RuntimeError("connected components did not settle")
    return nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
