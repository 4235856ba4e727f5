"""Dataset samplers and wrappers (K7, K9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repeat_dataset(df: DataFrame, times: int, copy_col: str = "copy") -> DataFrame:
    """K7 repeat: every row ``times`` times, tagged with its copy number (1-based)."""
    return df.withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.lit(times))))


def concat_datasets(*dfs: DataFrame, source_col: str = "source") -> DataFrame:
    """K7 concat: bag union by column name, tagged with the position of its source."""
    out = None
    for i, d in enumerate(dfs):
        t = d.withColumn(source_col, F.lit(i))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def first_n(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """K9: the first n rows in index order (the limit is the operator itself)."""
    return df.orderBy(*order).limit(n)


def given_indices(df: DataFrame, idx: DataFrame, key: str) -> DataFrame:
    """K9: rows whose index is listed in ``idx`` (semi join)."""
    return df.join(idx.select(key), key, "left_semi")
