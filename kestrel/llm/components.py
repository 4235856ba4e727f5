"""Connected components of an edge table by alternating large-star / small-star.

Every step is a grouped minimum and an equi-join on the node, so no component
ever meets in one task or on the driver; the lineage of each round is cut by a
reliable checkpoint.  A long path of n nodes needs O(log n) rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import cut_lineage


def _large(e: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(e: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them (rows have u > v)."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    kept = e.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionByName(least.select("u", F.col("m").alias("v")))


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node that an edge touches; root is the smallest node of its component.

    Loops, repeated and reversed edges are allowed; rows with a null end are
    ignored.  An empty table gives an empty result.
    """
    e = (edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
         .where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    e = cut_lineage(e)
    before = _state(e)
    while before[0]:
        e = cut_lineage(_small(_large(e)).distinct())
        after = _state(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
