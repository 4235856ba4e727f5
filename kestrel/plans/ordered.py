"""Exact per-group row numbers and running sums that stay safe under skew.

``Window.partitionBy(g).orderBy(o)`` sends a whole group to one task; with
one class holding a third of 100 TB that task never finishes.  Here the
rows are range-partitioned on (g, o) into ``chunks`` so a hot group spans
many chunks, the window runs per (group, chunk), and a tiny table of chunk
totals (at most groups + chunks rows, per group at most ``chunks``) turns
local values into global ones.  The join back is left to AQE, which
broadcasts that table only when its runtime size is under the threshold.

Range bounds come from a random sample taken each time the exchange runs,
so chunk ids are assigned once and persisted with a reliable checkpoint;
the per-row branch and the chunk-total branch then see the same chunks
(and an executor loss re-reads the checkpoint instead of re-sampling).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import cut_lineage


def _chunks(df: DataFrame, chunks: int | None) -> int:
    if chunks:
        return chunks
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _chunked(df: DataFrame, by: list[str], order: list[Column], p: int) -> DataFrame:
    # The range bounds are sampled by a separate job over the input; persisting
    # it first keeps an expensive upstream from being computed twice.
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    r = src.repartitionByRange(p, *[F.col(b) for b in by], *order).withColumn("_chunk", F.spark_partition_id())
    out = cut_lineage(r)
    src.unpersist()
    return out


def running(df: DataFrame, by: list[str], order: list[Column], sums: dict[str, Column] | None = None,
            rank_col: str | None = "rn", chunks: int | None = None, keep_chunk: bool = False) -> DataFrame:
    """Add ``rank_col`` (1-based row number in ``order`` within ``by``) and, for
    each ``name -> expr`` in ``sums``, the inclusive running sum ``name``.

    ``order`` must be a total order within a group (end it with a unique id).
    """
    sums = sums or {}
    p = _chunks(df, chunks)
    base = df
    for name, expr in sums.items():
        base = base.withColumn(f"_v_{name}", expr)
    r = _chunked(base, by, order, p)
    w = Window.partitionBy(*by, "_chunk").orderBy(*order)
    wr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = r.withColumn("_lrn", F.row_number().over(w))
    for name in sums:
        r = r.withColumn(f"_l_{name}", F.sum(f"_v_{name}").over(wr))
    tot = r.groupBy(*by, "_chunk").agg(F.count(F.lit(1)).alias("_cnt"),
                                      *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    wc = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*by, "_chunk", F.coalesce(F.sum("_cnt").over(wc), F.lit(0)).alias("_o_rn"),
                     *[F.coalesce(F.sum(f"_t_{n}").over(wc), F.lit(0)).alias(f"_o_{n}") for n in sums])
    out = r.join(off, [*by, "_chunk"])
    if rank_col:
        out = out.withColumn(rank_col, F.col("_lrn") + F.col("_o_rn"))
    for name in sums:
        out = out.withColumn(name, F.col(f"_l_{name}") + F.col(f"_o_{name}"))
    drop = ["_lrn", "_cnt", "_o_rn"] + [f"_{p}_{n}" for n in sums for p in ("v", "l", "o")]
    if not keep_chunk:
        drop.append("_chunk")
    return out.drop(*drop)


def suffix_max(df: DataFrame, by: list[str], order: list[Column], value: str, out_col: str,
               reverse_order: list[Column], chunks: int | None = None) -> DataFrame:
    """``out_col`` = max of ``value`` over this row and all later rows of its group.

    ``reverse_order`` is ``order`` with every direction flipped: the suffix
    max is computed as a running max in reverse order, because Spark
    evaluates a (current row, unbounded following) frame by re-aggregating
    the rest of the partition for every row (quadratic).  Input that still
    carries ``_chunk`` from ``running(keep_chunk=True)`` is reused as is.
    """
    if "_chunk" in df.columns:
        r = df
    else:
        r = _chunked(df, by, order, _chunks(df, chunks))
    w = Window.partitionBy(*by, "_chunk").orderBy(*reverse_order) \
              .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = r.withColumn("_lmax", F.max(value).over(w))
    tot = r.groupBy(*by, "_chunk").agg(F.max(value).alias("_cmax"))
    wc = Window.partitionBy(*by).orderBy(F.col("_chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*by, "_chunk", F.max("_cmax").over(wc).alias("_later"))
    out = r.join(off, [*by, "_chunk"])
    return out.withColumn(out_col, F.greatest("_lmax", F.coalesce("_later", "_lmax"))) \
              .drop("_chunk", "_lmax", "_later")
