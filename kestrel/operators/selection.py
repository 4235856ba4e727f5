"""Feature selection: one-way ANOVA F per feature (A2), top-n (L2), n per class (K1).

A2 works on long features ``(feature keys..., class, value)``.  The first
aggregation is keyed by (feature, class) with map-side partial
aggregation, so no sample matrix is ever materialized and a hot class
costs nothing extra; the second step sees at most ``#classes`` rows per
feature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Finite stand-in for +inf F scores (numpy nan_to_num maps inf to the largest double).
BIG_F = 1.7976931348623157e308


def anova_f(long: DataFrame, feature_cols: list[str], class_col: str = "class_id",
            value_col: str = "value", moments: bool = False) -> DataFrame:
    """F = (SSB/(k-1)) / (SSW/(N-k)) per feature; 0/0 -> 0, x/0 -> BIG_F.

    With ``moments`` the rows are n, mean and m2 (squared deviations from it) of
    parts of a class, not values.

    k counts the classes present for the feature.  Per-class moments use
    ``var_pop`` (numerically stable), and SSB is taken around the grand mean.
    """
    if moments:
        # the parts of a class by their means' distance from its mean: sums of squares would cancel
        wc = Window.partitionBy(*feature_cols, class_col)
        n, total = F.sum("n"), F.sum("n").over(wc)
        parts = long.withColumn("_m", F.when(total > 0, F.sum(F.col("n") * F.col("mean")).over(wc) / F.greatest(total, F.lit(1))))
        far = F.col("m2") + F.col("n") * (F.col("mean") - F.col("_m")) * (F.col("mean") - F.col("_m"))
        g = parts.groupBy(*feature_cols, class_col).agg(n.alias("_n"), F.first("_m").alias("_m"), F.when(n > 0, F.sum(far) / F.greatest(n, F.lit(1))).alias("_v"))
    else:
        g = long.groupBy(*feature_cols, class_col).agg(
            F.count(value_col).alias("_n"), F.avg(value_col).alias("_m"), F.var_pop(value_col).alias("_v"))
    w = Window.partitionBy(*feature_cols)
    g = g.withColumn("_grand", F.sum(F.col("_n") * F.col("_m")).over(w) / F.sum("_n").over(w))
    s = g.groupBy(*feature_cols).agg(
        F.sum("_n").alias("_N"), F.count("*").alias("_k"),
        F.sum(F.col("_n") * (F.col("_m") - F.col("_grand")) ** 2).alias("_ssb"),
        F.sum(F.col("_n") * F.col("_v")).alias("_ssw"))
    msb = F.col("_ssb") / (F.col("_k") - 1)
    msw = F.col("_ssw") / (F.col("_N") - F.col("_k"))
    f = (F.when((F.col("_k") < 2) | (F.col("_N") <= F.col("_k")), F.lit(0.0))
          .when(F.col("_ssw") == 0, F.when(F.col("_ssb") > 0, F.lit(BIG_F)).otherwise(F.lit(0.0)))
          .otherwise(msb / msw))
    return s.select(*feature_cols, f.alias("f_score"))


def top_n(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """L2: global top-n with a rank column.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each partition keeps
    its own n best, then one merge of at most n x partitions rows.
    """
    best = df.orderBy(*order).limit(n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def seeded_key(id_col: str, seed: int = 42) -> Column:
    """Portable pseudo-random order: md5('<seed>-<id>') (same text in DuckDB)."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string")))


def top_n_per_group(df: DataFrame, group_cols: list[str], order: list[Column], n: int,
                    salts: int = 32, rank_col: str = "rank") -> DataFrame:
    """First n rows per group in ``order``, safe for a group holding most rows.

    Stage 1 ranks inside (group, salt) sub-groups, salt = hash of the row,
    so a hot group is spread over ``salts`` tasks and each keeps at most
    n rows.  Stage 2 ranks the <= n x salts survivors per group.  The result
    is exact because the global top n of a group is contained in the union
    of the sub-group top n's.  ``salts=1`` is a single window, for groups
    that are bounded by construction (e.g. one query's neighbour candidates).
    """
    if salts <= 1:
        w = Window.partitionBy(*group_cols).orderBy(*order)
        return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts)))
    w1 = Window.partitionBy(*group_cols, "_salt").orderBy(*order)
    cand = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= n)
    w2 = Window.partitionBy(*group_cols).orderBy(*order)
    return (cand.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= n)
                .drop("_salt", "_r1"))


def sample_per_class(df: DataFrame, n: int, class_col: str = "class_id", id_col: str = "sample_id",
                     seed: int = 42, salts: int = 32) -> DataFrame:
    """K1: min(n, class size) rows per class without replacement, seeded."""
    return top_n_per_group(df, [class_col], [seeded_key(id_col, seed), F.col(id_col)], n, salts,
                           rank_col="draw")
