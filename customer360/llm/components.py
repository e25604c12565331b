"""Connected components of an edge table, as Spark jobs.

Alternating large-star / small-star steps: every round points each vertex at
the smallest vertex it knows, until the edges no longer change. Each round
is a pre-aggregated minimum per vertex and one join; nothing is gathered per
component and nothing but two sums reaches the driver. Rounds are cut with a
reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from customer360.plans import cut_lineage, release_unreachable


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star step on (u, v) rows: the neighbours of u point at u's minimum."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m"))
    near = pairs.join(low, "u").withColumn("m", F.least("u", "m"))
    keep = F.col("v") > F.col("u") if large else F.lit(True)
    out = near.where(keep & (F.col("v") != F.col("m"))).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(low.where("u > m").select("u", F.col("m").alias("v")))
    return out.distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every vertex of ``edges`` (columns a, b of one type):
    root is the smallest vertex of its component. Self loops and rows with a
    NULL end are ignored; an empty table gives an empty result."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = cut_lineage(e)
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        stars = _star(both, large=True)
        down = stars.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        e = cut_lineage(_star(down, large=False))
        # Equal sums of two independent hashes over the rows: the edge set is unchanged.
        row = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                    F.sum(F.hash("v", "u").cast("decimal(38,0)"))).first()
        if row == seen:
            break
        seen = row
        release_unreachable(e.sparkSession)  # the round before: its frames and plans fill the driver
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
