"""Connected components of an edge table as Spark joins.

Alternating large-star and small-star steps (Kiveris et al., 2014): every step
links the neighbours of a node to the smallest of them, so the forest flattens
in about log(n) rounds.  The smallest neighbour is a partial aggregate; the join that
hands it to a node's neighbours is by node, and a node with very many of them is
a skewed partition that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybayes.llm.storage import save


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: u > v.  Large: both directions, larger neighbours move to the
    smallest; small: a node and its smaller neighbours move to the smallest."""
    near = edges.select("u", "v")
    if large:
        near = near.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    moved = near.join(low, "u")
    if large:
        out = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.inline(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))))
    return out.filter(F.col("u") != F.col("v")).distinct()


def _flat(edges: DataFrame) -> bool:
    """Whether the edges are stars: each u once, and no node both a u and a v."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")) \
        .filter("up > 1 or (up > 0 and down > 0)").isEmpty()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, comp)``: the smallest node reachable, for every node that is on
    an edge and isn't that smallest one itself."""
    e = save(edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    while not _flat(e):
        e = save(_star(_star(e, True), False), "components")
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
