"""Connected components over an edge table, DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import Scratch


def _is_star_forest(df: DataFrame) -> bool:
    """Every left node has one right node, and no right node is a left one."""
    r = df.groupBy("u").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()
    return (r["n"] or 0) <= 1 and df.join(df.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty()


def connected_components(scratch: Scratch, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): every node of ``edges`` with the smallest node it reaches.

    Alternating large-star and small-star steps: in the first every node hands
    its larger neighbours to the smallest of its neighbours, in the second its
    smaller ones, until only stars are left.  Minima are pre-aggregated on the
    map side and joined back on the node, so that a hub with a third of all
    edges is split by the skew join instead of being gathered.  Rounds grow
    with the logarithm of the largest component; each is written to the shared
    folder, and the driver learns only whether it was the last.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    cur = scratch.save(edges.where(F.col(a) != F.col(b)).select(u, v).distinct())
    while not _is_star_forest(cur):
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = scratch.save(small.union(low).distinct())
        scratch.drop(cur)
        cur = nxt
    roots = cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
