"""Landmark geometric features.

Input: one row per sample with two primitive arrays ``xs``, ``ys``
(array<double>, point order).  Per-sample work is row-local, so these
operators add no shuffle.  Exhaustive families are generated in long form
(one row per sample and feature) with chained ``explode(sequence(..))``
over point indices and plain arithmetic on ``element_at`` reads; every
step stays inside whole-stage codegen (lambda functions would run
interpreted, ~7x slower here).  A sample yields its rows lazily inside the
Generate chain, so no per-sample array of C(n,4) values is ever built.  Where only the moments of a class are
wanted, the C(n,4) ratios are summed up in numpy, a few samples at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType


def spread(df: DataFrame) -> DataFrame:
    """Deal a narrow input evenly before a large expansion, which dwarfs this shuffle at any size.

    Nothing is run to find out how the input is partitioned now.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _x(i) -> Column:
    return F.element_at("xs", i + 1)


def _y(i) -> Column:
    return F.element_at("ys", i + 1)


def _d(i, j) -> Column:
    dx, dy = _x(i) - _x(j), _y(i) - _y(j)
    return F.sqrt(dx * dx + dy * dy)


def _angle(i, j, k) -> Column:
    v1x, v1y = _x(i) - _x(j), _y(i) - _y(j)
    v2x, v2y = _x(k) - _x(j), _y(k) - _y(j)
    cos = (v1x * v2x + v1y * v2y) / (F.sqrt(v1x * v1x + v1y * v1y) * F.sqrt(v2x * v2x + v2y * v2y) + 1e-8)
    return F.acos(F.least(F.greatest(cos, F.lit(-1.0)), F.lit(1.0)))


def center_distances() -> Column:
    """Distance of every point to the centroid, in point order."""
    cx = F.aggregate("xs", F.lit(0.0), lambda a, v: a + v) / F.size("xs")
    cy = F.aggregate("ys", F.lit(0.0), lambda a, v: a + v) / F.size("ys")
    return F.zip_with("xs", "ys", lambda x, y: F.sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)))


def pairwise_distances() -> Column:
    """All i<j distances in lexicographic pair order (one array per sample)."""
    n = F.size("xs")
    return F.flatten(F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.transform(
        F.sequence(i + 1, n - 1), lambda j: _d(i, j))))


def angles(triplets: list[tuple[int, int, int]]) -> Column:
    """P25 with a fixed triplet list: angle at the middle index of (i, j, k)."""
    if not triplets:
        return F.array().cast("array<double>")
    return F.array(*[_angle(F.lit(i), F.lit(j), F.lit(k)) for i, j, k in triplets])


def ratios(quads: list[tuple[int, int, int, int]]) -> Column:
    """P26 with a fixed quadruplet list: d(i,j) / (d(k,m) + 1e-8)."""
    if not quads:
        return F.array().cast("array<double>")
    return F.array(*[_d(F.lit(i), F.lit(j)) / (_d(F.lit(k), F.lit(m)) + 1e-8) for i, j, k, m in quads])


def feature_vector(df: DataFrame, triplets, quads, use_distances: bool = True,
                   use_angles: bool = True, use_ratios: bool = True, out: str = "features") -> DataFrame:
    """Center distances, then angles, then ratios, as one array<double>."""
    parts = []
    if use_distances:
        parts.append(center_distances())
    if use_angles:
        parts.append(angles(triplets))
    if use_ratios:
        parts.append(ratios(quads))
    return df.withColumn(out, F.concat(*parts) if len(parts) > 1 else parts[0])


def _explode_after(df: DataFrame, prev: str | None, name: str, tail: int) -> DataFrame:
    """Add index ``name`` in (prev, n - tail]; chained to enumerate combinations."""
    lo = F.lit(0) if prev is None else F.col(prev) + 1
    return df.select("*", F.explode(F.sequence(lo, F.size("xs") - 1 - tail)).alias(name))


def all_angles_long(df: DataFrame, keep=("sample_id", "class_id")) -> DataFrame:
    """Every i<j<k triplet as rows ``keep..., i, j, k, value`` (exhaustive P25)."""
    s = spread(df.select(*keep, "xs", "ys"))
    s = _explode_after(s, None, "i", 2)
    s = _explode_after(s, "i", "j", 1)
    s = _explode_after(s, "j", "k", 0)
    i, j, k = F.col("i"), F.col("j"), F.col("k")
    return s.select(*keep, "i", "j", "k", _angle(i, j, k).alias("value"))


def all_ratios_long(df: DataFrame, keep=("sample_id", "class_id"), moments: str | None = None) -> DataFrame:
    """Every i<j<k<m quadruplet as rows ``keep..., i, j, k, m, value`` (exhaustive P26).

    With ``moments`` (the class) a task sums the values up as it makes them: rows
    ``i, j, k, m, <class>, n, mean, m2`` of some of a class's samples, m2 the squared
    deviations from that mean.  ``selection.anova_f`` takes either.
    """
    if moments is not None:
        return _ratio_moments(df, moments)
    s = spread(df.select(*keep, "xs", "ys"))
    s = _explode_after(s, None, "i", 3)
    s = _explode_after(s, "i", "j", 2)
    s = s.withColumn("_dij", _d(F.col("i"), F.col("j")))
    s = _explode_after(s, "j", "k", 1)
    s = _explode_after(s, "k", "m", 0)
    return s.select(*keep, "i", "j", "k", "m",
                    (F.col("_dij") / (_d(F.col("k"), F.col("m")) + 1e-8)).alias("value"))


def all_pairs_long(df: DataFrame, keep=("sample_id", "class_id")) -> DataFrame:
    """Every i<j pair distance as rows ``keep..., i, j, value`` (P24 long form)."""
    s = spread(df.select(*keep, "xs", "ys"))
    s = _explode_after(s, None, "i", 1)
    s = _explode_after(s, "i", "j", 0)
    return s.select(*keep, "i", "j", _d(F.col("i"), F.col("j")).alias("value"))


#: Classes whose moments a task holds before it hands them on.
HELD = 64


def _ratio_moments(df: DataFrame, class_col: str) -> DataFrame:
    table = spread(df.where("xs IS NOT NULL").select(class_col, "xs", "ys"))
    schema = StructType([*[StructField(c, IntegerType()) for c in "ijkm"], table.schema[class_col], StructField("n", LongType()), StructField("mean", DoubleType()), StructField("m2", DoubleType())])

    def points(column: pa.Array, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates (row, point) and which are known, of rows of n points (a missing list: none known)."""
        lists = column.take(pa.array(rows))
        full = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(lists), n), False).to_numpy(zero_copy_only=False))
        flat = lists.take(pa.array(full)).flatten()
        values, known = np.full((len(rows), n), np.nan), np.zeros((len(rows), n), bool)
        values[full] = flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, n)
        known[full] = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, n)
        return values, known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        quads: dict = {}

        def out(key) -> pa.RecordBatch:
            cls, size = key
            count, mean, m2 = held.pop(key)
            none = count == 0
            return pa.RecordBatch.from_arrays([*[pa.array(c) for c in quads[size]], pa.array([cls] * len(count), kind), pa.array(count), pa.array(mean, mask=none), pa.array(m2)], schema.names)

        for batch in batches:
            kind = batch.column(class_col).type
            classes, sizes = batch.column(class_col).to_pylist(), pc.list_value_length(batch.column("xs")).to_pylist()
            groups: dict = {}
            for row, key in enumerate(zip(classes, sizes, strict=True)):
                groups.setdefault(key, []).append(row)
            for key, rows in groups.items():
                n = key[1]
                if n < 4:
                    continue
                if n not in quads:
                    quads[n] = np.array(list(combinations(range(n), 4)), np.int32).T.copy()
                i, j, k, m = quads[n]
                if key not in held:
                    if len(held) >= HELD:
                        yield out(next(iter(held)))
                    held[key] = (np.zeros(len(i), np.int64), np.zeros(len(i)), np.zeros(len(i)))
                for at in range(0, len(rows), 32):
                    some = np.array(rows[at:at + 32])
                    (x, kx), (y, ky) = (points(batch.column(c), some, n) for c in ("xs", "ys"))
                    known = kx & ky
                    with np.errstate(all="ignore"):
                        d = np.sqrt((x[:, :, None] - x[:, None]) ** 2 + (y[:, :, None] - y[:, None]) ** 2).reshape(len(some), n * n)
                        value = d[:, i * n + j] / (d[:, k * n + m] + 1e-8)
                        if known.all():
                            count = np.full(len(i), len(some))
                            mean = value.mean(axis=0)
                            m2 = ((value - mean) ** 2).sum(axis=0)
                        else:
                            both = (known[:, :, None] & known[:, None]).reshape(len(some), n * n)
                            use = both[:, i * n + j] & both[:, k * n + m]
                            count = use.sum(axis=0)
                            mean = value.sum(axis=0, where=use) / np.maximum(count, 1)
                            m2 = ((value - mean) ** 2).sum(axis=0, where=use)
                        was, old, old2 = held[key]
                        total = np.maximum(was + count, 1)
                        delta = mean - old
                        held[key] = (was + count, np.where(count > 0, np.where(was > 0, old + delta * count / total, mean), old),
                                     np.where(count > 0, np.where(was > 0, old2 + m2 + delta * delta * was * count / total, m2), old2))
        for key in list(held):
            yield out(key)

    return table.mapInArrow(run, schema)
