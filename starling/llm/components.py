"""Distributed union-find: connected components of a graph given as pairs of nodes.

Alternating large-star and small-star steps (Kiveris et al., 2014): every step is
one grouping by node, the forest after the last step is a set of stars around the
smallest node of each component.  Unlike plain label spreading a chain of *n*
nodes takes O(log n) rounds or so, and no step gathers a node's neighbours: the
minimum of a neighbourhood is an aggregate joined back to its edges, so a node
with millions of neighbours is split over tasks.

Every round is written to the shared scratch folder, which cuts the lineage (a
lost executor re-reads files), and the round before the last is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import delete_path, scratch_path

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v) given once, u > v.

    Large: every neighbour greater than a node is linked to the least node of its
    closed neighbourhood.  Small: so is every neighbour not greater, and the node.
    """
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("n"), F.least("u", "m").alias("m"))
    joined = both.join(least, both["u"] == least["n"])
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # v <= m is m itself; the node is linked to m as well.
        out = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
    return out.filter(F.col("u") > F.col("v")).distinct()


def _settled(state: DataFrame) -> bool:
    """All stars: every node hangs from one root, and no root hangs from anything."""
    n, nodes = state.agg(F.count(F.lit(1)), F.count_distinct("u")).first()
    if n != nodes:
        return False
    return state.select(F.col("v").alias("r")).join(state.select("u"), F.col("r") == F.col("u"), "left_semi").isEmpty()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node on an edge; component is the least node reachable.

    Nodes are of any orderable type; edges may repeat, run both ways or be loops;
    an edge with a null end is ignored (a loop's node gets itself).
    """
    spark = edges.sparkSession

    def write(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "components")
        df.write.parquet(path)
        return spark.read.parquet(path), path

    given = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    now, path = write(given.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
    loops = now.filter(F.col("u") == F.col("v")).select(F.col("u").alias("node"))
    state, state_path = write(now.filter(F.col("u") > F.col("v")))
    for _ in range(MAX_ROUNDS):
        if _settled(state):
            break
        middle, middle_path = write(_star(state, large=True))
        nxt, nxt_path = write(_star(middle, large=False))
        delete_path(spark, middle_path)
        delete_path(spark, state_path)
        state, state_path = nxt, nxt_path
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    found = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = state.select(F.col("v").alias("node")).unionByName(loops).distinct()
    roots = roots.join(found.select(F.col("node").alias("k")), F.col("node") == F.col("k"), "left_anti")
    return found.unionByName(roots.select("node", F.col("node").alias("component")))
