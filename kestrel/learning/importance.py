"""Permutation importance (A7): what a model's accuracy loses when one feature is shuffled among the rows.

The shuffled column of a feature is a self-join by rank: rows have one rank in a
seeded order, and for each feature another; a row takes the value of the row
whose rank for that feature is its own.  All features are scored in one pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.selection import top_n
from kestrel.plans.ordered import running
from kestrel.session import cut_lineage


def seeded_sample(table: DataFrame, n: int, id_col: str = "sample_id", seed: int = 42) -> DataFrame:
    """``n`` rows (all, if fewer) in a seeded order of their ids."""
    return table.orderBy(F.md5(F.concat_ws("-", F.lit(seed), F.col(id_col))), id_col).limit(n)


def permuted(table: DataFrame, features: str = "features", id_col: str = "sample_id", seed: int = 42) -> DataFrame:
    """(feature, id_col, value): each feature's values dealt out anew among the rows of ``table``; ids must be unique.

    ``feature`` is the place in the array, from 0.  Ranks are exact and computed
    in range chunks, so a table of any size may be permuted.
    """
    key = F.md5(F.concat_ws("-", F.lit(seed), F.col(id_col)))
    base = running(table.select(id_col, F.lit(0).alias("_all")), ["_all"], [key, F.col(id_col)], rank_col="_rank").select(id_col, "_rank")
    cells = table.select(id_col, F.posexplode(features).alias("feature", "value"))
    mixed = F.md5(F.concat_ws("-", F.lit(seed), F.col("feature"), F.col(id_col)))
    drawn = running(cells, ["feature"], [mixed, F.col(id_col)], rank_col="_rank").select("feature", "value", "_rank")
    return base.join(drawn, "_rank").select("feature", id_col, "value")


def permutation_importance(table: DataFrame, accuracy: Callable[[DataFrame, list[str]], DataFrame], features: str = "features", id_col: str = "sample_id",
                           sample: int = 2000, seed: int = 42, top: int = 20, label: str = "label") -> DataFrame:
    """(feature, importance, rank): the ``top`` features by the accuracy lost on a seeded sample of ``sample`` rows.

    ``accuracy(rows, by)`` scores rows of id_col, ``label``, ``features`` and the
    columns ``by``, and returns ``by`` and ``accuracy``.  Ties go to the feature
    of the smaller number.  A row of a null array takes no part.
    """
    rows = cut_lineage(seeded_sample(table.where(F.col(features).isNotNull()).select(id_col, label, features), sample, id_col, seed))
    swapped = permuted(rows, features, id_col, seed)
    one = (rows.join(swapped, id_col)
           .withColumn(features, F.transform(features, lambda x, i: F.when(i == F.col("feature"), F.col("value")).otherwise(x))).drop("value"))
    base = rows.withColumn("feature", F.lit(-1))  # not shuffled
    scored = accuracy(base.unionByName(one), ["feature"])
    both = scored.withColumn("_base", F.max(F.when(F.col("feature") == -1, F.col("accuracy"))).over(Window.partitionBy()))  # a row a feature
    lost = both.where("feature >= 0").select("feature", (F.col("_base") - F.col("accuracy")).alias("importance"))
    return top_n(lost, top, [F.col("importance").desc(), F.col("feature")])


def model_accuracy(stack, name: str, label: str = "label") -> Callable[[DataFrame, list[str]], DataFrame]:
    """``accuracy`` by one model of a stack."""
    from kestrel.learning.stacking import score

    def run(rows: DataFrame, by: list[str]) -> DataFrame:
        scored = score(stack, rows, name, (*by, label))
        return scored.groupBy(*by).agg(F.avg((F.col("pred") == F.col(label).cast("string")).cast("double")).alias("accuracy"))
    return run
