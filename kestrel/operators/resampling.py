"""Samplers that go round their sources: class-aware, ratio batches, resampled concatenation (K3, K4, K6).

The reference draws from endless shuffled iterators.  Here a row's place follows
from its rank in a pseudo-random order of its group and cycle, so places are
computed on all rows at once: rows are repeated only as often as their group is
gone round, and ranks come from the skew-safe ``plans.ordered.running``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.plans.ordered import running


def _mix(*parts) -> Column:
    return F.md5(F.concat_ws("-", *[p.cast("string") for p in parts]))


def _go_round(rows: DataFrame, group: str, row_id: str, want: DataFrame, seed: int) -> DataFrame:
    """``want(group, size, take, ...)``: the first ``take`` rows of the group's shuffled cycles, with their ``draw`` from 0."""
    cycles = F.ceil(F.col("take") / F.col("size")).cast("long")
    many = (rows.join(want.where("take > 0"), group)
            .withColumn("_cycle", F.explode(F.sequence(F.lit(0).cast("long"), cycles - 1))).withColumn("_mix", _mix(F.lit(seed), F.col("_cycle"), F.col(row_id))))
    ranked = running(many, [group, "_cycle"], [F.col("_mix"), F.col(row_id)], rank_col="_rank")
    return ranked.withColumn("draw", F.col("_cycle") * F.col("size") + F.col("_rank") - 1).where("draw < take").drop("_cycle", "_mix", "_rank")


def class_aware(rows: DataFrame, label: str, row_id: str, per_visit: int = 1, seed: int = 42) -> DataFrame:
    """K3: as many draws as rows, going round the classes in shuffled order, ``per_visit`` rows a visit.

    Returns ``position``, label and id.  Rows of a null class aren't drawn.
    """
    sizes = rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("size"))
    of_all = Window.partitionBy(F.lit(1))  # one row a class
    c = (F.row_number().over(of_all.orderBy(_mix(F.lit(seed), F.col(label)), label)) - 1).cast("long")
    lap = F.lit(per_visit) * F.count(F.lit(1)).over(of_all)
    want = (sizes.select(label, "size", c.alias("_c"), lap.alias("_lap"), F.sum("size").over(of_all).alias("_n"))
            .withColumn("take", F.floor(F.col("_n") / F.col("_lap")) * per_visit
                        + F.least(F.greatest(F.col("_n") % F.col("_lap") - F.col("_c") * per_visit, F.lit(0)), F.lit(per_visit))))
    drawn = _go_round(rows.select(label, row_id), label, row_id, want, seed)
    position = F.floor(F.col("draw") / per_visit) * F.col("_lap") + F.col("_c") * per_visit + F.col("draw") % per_visit
    return drawn.select(position.cast("long").alias("position"), label, row_id)


def ratio_batches(rows: DataFrame, source: str, row_id: str, ratios: dict, batch_size: int, batches: int | None = None, seed: int = 42) -> DataFrame:
    """K4: batches of rows of the sources in the given ratios, what rounding leaves going to the first source.

    Without ``batches`` there are as many as it takes to draw every row at least once.  Returns ``batch``, ``slot``, source and id; slots follow the order of ``ratios``.  Each source is reshuffled when used up.
    """
    share = {s: int(batch_size * r / sum(ratios.values())) for s, r in ratios.items()}
    first = next(iter(share))
    share[first] += batch_size - sum(share.values())
    starts, at = {}, 0
    for s, n in share.items():
        starts[s], at = at, at + n

    def choose(values: dict) -> Column:
        out = F.lit(None).cast("long")
        for s, v in values.items():
            out = F.when(F.col(source) == s, F.lit(v).cast("long")).otherwise(out)
        return out

    want = (rows.groupBy(source).agg(F.count(F.lit(1)).alias("size")).where(F.col(source).isin(*ratios))
            .withColumns({"_share": choose(share), "_start": choose(starts)}))
    rounds = F.ceil(F.max(F.col("size") / F.col("_share")).over(Window.partitionBy())) if batches is None else F.lit(batches)  # a row a source
    want = want.withColumn("take", (F.col("_share") * rounds).cast("long"))
    drawn = _go_round(rows.select(source, row_id), source, row_id, want, seed)
    return drawn.select(F.floor(F.col("draw") / F.col("_share")).alias("batch"), (F.col("_start") + F.col("draw") % F.col("_share")).alias("slot"), source, row_id)


def resampled_concat(rows: DataFrame, source: str, order: list[str], factors: dict, seed: int = 42) -> DataFrame:
    """K6: ``round(size * factor)`` strided rows of each source with jitter inside a stride.

    Returns source, ``draw`` (from 0 in its source) and the row's other columns.  Every row finds its own draws, so no index table is built.
    """
    factor = F.lit(None).cast("double")
    for s, f in factors.items():
        factor = F.when(F.col(source) == s, F.lit(float(f))).otherwise(factor)
    sizes = (rows.groupBy(source).agg(F.count(F.lit(1)).alias("_size")).withColumn("_m", F.rint(F.col("_size") * factor).cast("long"))
             .where("_m > 0").withColumn("_gap", (F.col("_size") - 1e-4) / F.col("_m")))
    ranked = running(rows, [source], [F.col(c) for c in order], rank_col="_r").withColumn("_r", F.col("_r") - 1).join(sizes, source)
    near = F.sequence(F.floor(F.col("_r") / F.col("_gap")) - 1, F.ceil((F.col("_r") + 1) / F.col("_gap")))
    jitter = F.conv(F.substring(_mix(F.lit(seed), F.col(source), F.col("draw")), 1, 8), 16, 10).cast("double") / 2.0**32
    place = F.rint(F.col("_gap") * F.col("draw") + jitter * F.col("_gap") - 0.5).cast("long")
    return (ranked.withColumn("draw", F.explode(near)).where((F.col("draw") >= 0) & (F.col("draw") < F.col("_m")) & (place == F.col("_r")))
            .drop("_size", "_m", "_gap", "_r"))
