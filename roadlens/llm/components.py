"""Connected components of an edge table, by alternating large-star and small-star steps in Spark.

Every step is a group-by on a node with its smallest neighbour (map-side combined) and a join
back; edges never exceed their first number plus the nodes. A node with very many neighbours is
a skewed join key there, which adaptive execution splits. Each round is settled, so lineage
stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import few, settle


def _star(edges: DataFrame, large: bool, rows: int) -> DataFrame:
    """One star step on about ``rows`` edges ``a > b``: neighbours are tied to the smallest one around a node."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    low = few(both.groupBy("a").agg(F.min("b").alias("_m")), rows).withColumn("_m", F.least("_m", "a"))
    out = few(both.join(low, "a"), rows)
    if large:  # only larger neighbours move to the smallest
        return few(out.where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct(), rows)
    # every smaller neighbour, and the node itself, move to the smallest
    moved = out.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(low.select("a", F.col("_m").alias("b")))
    return few(moved.where("a <> b").distinct(), rows)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the settled ``edges`` (columns ``a``, ``b``); the smallest node names it."""
    high, low = F.greatest("a", "b"), F.least("a", "b")
    rows = edges.count()
    now = settle(few(edges.select(high.alias("a"), low.alias("b")).where("a <> b").distinct(), rows))
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    seen = mark(now)
    while seen[0]:
        now = settle(_star(_star(now, True, rows), False, rows))
        if (new := mark(now)) == seen:
            break
        seen = new
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
