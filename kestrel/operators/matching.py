"""Greedy one-to-one assignment and greedy ordered suppression as distributed rounds.

Both greedy procedures of the reference (take the globally best pair,
remove its two ends, repeat; keep a box unless an earlier kept box
overlaps it) are lexicographically-first maximal matchings / independent
sets under a total order.  They are computed exactly in rounds: every
round settles all edges (nodes) that dominate their neighbourhood, using
``groupBy`` aggregations and anti-joins only, and the number of rounds is
small for realistic orders (polylogarithmic for random orders).  Lineage
is cut with a reliable checkpoint every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import cut_lineage


def greedy_assignment(pairs: DataFrame, group: str, a: str, b: str, weight: str,
                      min_weight: float = 0.0) -> DataFrame:
    """Within each group, repeatedly take the pair with the largest weight (ties:
    smaller ``a``, then smaller ``b``) and remove both ends, until no pair is left.
    ``a`` and ``b`` need only be unique within a group.  Returns the chosen pairs
    ``group, a, b, weight``.  Pairs with weight <= min_weight never match."""
    e = cut_lineage(pairs.select(group, a, b, weight).where(F.col(weight) > min_weight))
    key = F.struct(F.col(weight), -F.col(a), -F.col(b))
    chosen = None
    while True:  # the best pair of all is always dominant, so every round settles some
        best_a = e.groupBy(group, a).agg(F.max_by(F.col(b), key).alias("_ba"))
        best_b = e.groupBy(group, b).agg(F.max_by(F.col(a), key).alias("_bb"))
        dom = (e.join(best_a, [group, a]).where(F.col(b) == F.col("_ba"))
                .join(best_b, [group, b]).where(F.col(a) == F.col("_bb"))
                .select(group, a, b, weight))
        dom = cut_lineage(dom)
        if dom.isEmpty():
            break
        chosen = dom if chosen is None else chosen.unionByName(dom)
        e = cut_lineage(e.join(dom.select(group, a), [group, a], "left_anti").join(dom.select(group, b), [group, b], "left_anti"))
    if chosen is None:
        return pairs.select(group, a, b, weight).limit(0)
    return chosen


def greedy_independent_set(nodes: DataFrame, edges: DataFrame, node: str = "id") -> DataFrame:
    """Lexicographically-first independent set.

    ``edges(u, v)`` says u comes before v and they conflict.  A node is kept
    iff no kept node before it conflicts with it.  Each round keeps every
    undecided node without undecided predecessors and drops their
    successors.  Returns ``nodes`` with a boolean ``kept`` column.
    """
    undecided = cut_lineage(nodes.select(node))
    e = cut_lineage(edges.select("u", "v"))
    kept_all = None
    dropped_all = None
    while True:  # the first undecided node has no predecessor, so every round settles some
        has_pred = e.select(F.col("v").alias(node)).distinct()
        new_k = undecided.join(has_pred, node, "left_anti")
        new_k = cut_lineage(new_k)
        if new_k.isEmpty():
            break
        new_s = e.join(new_k.select(F.col(node).alias("u")), "u").select(F.col("v").alias(node)).distinct()
        kept_all = new_k if kept_all is None else kept_all.unionByName(new_k)
        dropped_all = new_s if dropped_all is None else dropped_all.unionByName(new_s)
        settled = new_k.unionByName(new_s)
        undecided = undecided.join(settled, node, "left_anti")
        e = (e.join(settled.select(F.col(node).alias("u")), "u", "left_anti")
              .join(settled.select(F.col(node).alias("v")), "v", "left_anti"))
        undecided, e = cut_lineage(undecided), cut_lineage(e)
    if kept_all is None:
        return nodes.withColumn("kept", F.lit(False))
    flag = kept_all.select(node, F.lit(True).alias("kept"))
    return nodes.join(flag, node, "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
