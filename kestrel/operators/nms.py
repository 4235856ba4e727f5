"""Removal of overlapping rows: greedy NMS, class-aware NMS, match groups,
soft NMS (D1-D3, D7).

Groups (an image, or image x class) are ordered by ``score DESC, <id>``.
Bounded groups (at most ``max_group_rows``) are streamed in that order past
the boxes that they kept (``blocks.keep_first``), so a task holds the kept
boxes and a slab of pairs.  Groups with a null score or id are folded with
built-in higher-order functions: ``array_sort(collect_list)`` then
``aggregate`` keeps a box unless a kept box overlaps it.  Larger groups
never go to one task: their conflict edges come from the grid overlap join
and the greedy result is computed in distributed rounds
(``greedy_independent_set``).  All paths return the same rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.operators.blocks import keep_first
from kestrel.operators.boxjoin import overlap_pairs
from kestrel.operators.matching import greedy_independent_set
from kestrel.session import cut_lineage

BOX = ("x1", "y1", "x2", "y2")
#: Most rows of a group that one task streams past those it kept.
MAX_GROUP_ROWS = 200_000
#: Most rows of a group that is folded, of those that aren't streamed.
FOLDED = 20_000


def _iou_struct(a: Column, b: Column, offset: float) -> Column:
    w = F.greatest(F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]) + offset, F.lit(0.0))
    h = F.greatest(F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]) + offset, F.lit(0.0))
    inter = w * h
    aa = (a["x2"] - a["x1"] + offset) * (a["y2"] - a["y1"] + offset)
    ab = (b["x2"] - b["x1"] + offset) * (b["y2"] - b["y1"] + offset)
    union = aa + ab - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def _split_by_size(df: DataFrame, group: list[str], max_group_rows: int):
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_gn"))
    small = df.join(sizes.where(F.col("_gn") <= max_group_rows).select(*group), group, "left_semi")
    big = df.join(sizes.where(F.col("_gn") > max_group_rows).select(*group), group, "left_semi")
    return small, big


def _fold_small(df: DataFrame, group: list[str], id_col: str, thr: float, offset: float) -> DataFrame:
    rec = F.struct((-F.col("score")).alias("ns"), F.col(id_col).alias("id"), *[F.col(c) for c in BOX])
    g = df.groupBy(*group).agg(F.array_sort(F.collect_list(rec)).alias("_boxes"))
    empty = F.slice(F.col("_boxes"), 1, 0)
    kept = F.aggregate("_boxes", empty, lambda acc, b: F.when(
        F.exists(acc, lambda k: _iou_struct(k, b, offset) > thr), acc).otherwise(F.concat(acc, F.array(b))))
    return g.select(*group, F.explode(kept).alias("_k")).select(*group, F.col("_k.id").alias(id_col))


def _edges_big(df: DataFrame, group: list[str], id_col: str, thr: float, offset: float, cell: float):
    p = overlap_pairs(df, df, group, id_col, id_col, cell=cell, offset=offset, left_cols=("score",),
                      right_cols=("score",), self_join=True, out="_iou")
    # recompute IoU without eps, as the reference's suppression test does
    la = F.struct(*[F.col(f"l_{c}").alias(c) for c in BOX])
    ra = F.struct(*[F.col(f"r_{c}").alias(c) for c in BOX])
    p = p.where(_iou_struct(la, ra, offset) > thr)
    l_first = (F.col("l_score") > F.col("r_score")) | (
        (F.col("l_score") == F.col("r_score")) & (F.col(f"l_{id_col}") < F.col(f"r_{id_col}")))
    left, right = F.struct(*group, F.col(f"l_{id_col}").alias(id_col)), F.struct(*group, F.col(f"r_{id_col}").alias(id_col))
    return p.select(F.when(l_first, left).otherwise(right).alias("u"), F.when(l_first, right).otherwise(left).alias("v"))


def _parts(rows: DataFrame, group: list[str], id_col: str, thr: float, max_group_rows: int) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of groups that are streamed, rows of the others): larger groups and those with a null score or id, which have no place in the order."""
    if thr < 0 or rows.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return None, rows
    n = F.count(F.lit(1))
    odd = rows.dropna(subset=group).groupBy(*group).agg(n.alias("_n"), F.count("score").alias("_s"), F.count(id_col).alias("_i"))
    odd = cut_lineage(odd.where((F.col("_n") > max_group_rows) | (F.col("_s") < F.col("_n")) | (F.col("_i") < F.col("_n"))).select(*group))
    if odd.isEmpty():
        return rows, None
    return rows.join(odd, group, "left_anti"), rows.join(odd, group, "left_semi")


def _streamed(rows: DataFrame, group: list[str], id_col: str, thr: float, offset: float, owners: bool = False) -> DataFrame:
    """``keep_first`` by IoU: a group goes in order past the boxes that it kept."""
    def over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        w = np.minimum(a[:, 2], b[:, 2]) - np.maximum(a[:, 0], b[:, 0]) + offset
        h = np.minimum(a[:, 3], b[:, 3]) - np.maximum(a[:, 1], b[:, 1]) + offset
        inter = np.maximum(w, 0.0) * np.maximum(h, 0.0)
        areas = [(c[:, 2] - c[:, 0] + offset) * (c[:, 3] - c[:, 1] + offset) for c in (a, b)]
        union = areas[0] + areas[1] - inter
        return np.divide(inter, union, out=np.zeros_like(inter), where=union > 0) > thr

    hull = [F.col("x1"), F.col("y1"), F.col("x2") + offset, F.col("y2") + offset]
    return keep_first(rows, group, id_col, "score", hull, [F.col(c) for c in BOX], over, alike=True, owners=owners)


def _kept_apart(rows: DataFrame, group: list[str], id_col: str, thr: float, offset: float, max_group_rows: int, cell: float) -> DataFrame:
    """Ids kept in the groups that aren't streamed: small ones by a fold, large ones by rounds over their conflicts."""
    small, big = _split_by_size(rows, group, min(max_group_rows, FOLDED))
    edges = _edges_big(big, group, id_col, thr, offset, cell)
    nodes = big.select(F.struct(*group, id_col).alias("_node"))  # ids need only be unique within their group
    mis = greedy_independent_set(nodes, edges, node="_node")
    return _fold_small(small, group, id_col, thr, offset).unionByName(mis.where("kept").select("_node.*"))


def nms(df: DataFrame, group: list[str], id_col: str, iou_thr: float, score_thr: float | None = None,
        offset: float = 0.0, max_num: int | None = None, max_group_rows: int = MAX_GROUP_ROWS,
        cell: float = 64.0) -> DataFrame:
    """Rows of ``df`` kept by greedy NMS within each group.

    Suppression when IoU > iou_thr (IoU = inter / union, no eps, offset 0/1).
    ``score_thr`` filters first (score > thr); ``max_num`` keeps the best n
    per group after suppression.  ``group`` = [image] gives class-agnostic
    NMS, [image, class] the class-aware form.
    """
    src = df if score_thr is None else df.where(F.col("score") > score_thr)
    rows = src.select(*group, id_col, "score", *BOX)
    plain, other = _parts(rows, group, id_col, iou_thr, max_group_rows)
    kept_ids = None if plain is None else _streamed(plain, group, id_col, iou_thr, offset)
    if other is not None:
        rest = _kept_apart(other, group, id_col, iou_thr, offset, max_group_rows, cell)
        kept_ids = rest if kept_ids is None else kept_ids.unionByName(rest)
    out = src.join(kept_ids, [*group, id_col], "left_semi")
    if max_num is not None:
        from kestrel.operators.selection import top_n_per_group
        out = top_n_per_group(out, group, [F.col("score").desc(), F.col(id_col)], max_num).drop("rank")
    return out


def nms_match_groups(df: DataFrame, group: list[str], id_col: str, iou_thr: float,
                     max_group_rows: int = MAX_GROUP_ROWS, cell: float = 64.0) -> DataFrame:
    """Every row with ``match_group`` = the id of the kept row it belongs to
    (itself when kept; else the first kept row, in score order, that
    overlaps it above the threshold)."""
    plain, other = _parts(df.select(*group, id_col, "score", *BOX), group, id_col, iou_thr, max_group_rows)
    if plain is None:
        return _match_groups_apart(df, group, id_col, iou_thr, max_group_rows, cell)
    # the stream that removes a row knows the first kept one over it; rows of one id share the first of theirs
    owner = _streamed(plain, group, id_col, iou_thr, 0.0, owners=True).groupBy(*group, id_col).agg(
        F.min_by("_owner", "_place").cast(df.schema[id_col].dataType).alias("match_group"), F.count(F.lit(1)).alias("_copies"))
    times = F.when(F.col("match_group") == F.col(id_col), F.col("_copies").cast("int")).otherwise(1)  # a kept id meets each of its rows
    if other is None:
        mine = df
    else:
        odd = other.select(*group).distinct()
        mine, df = df.join(odd, group, "left_anti"), df.join(odd, group, "left_semi")
    out = mine.join(owner, [*group, id_col], "left").withColumn("_copies", F.explode(F.sequence(F.lit(1), F.coalesce(times, F.lit(1))))).drop("_copies")
    return out if other is None else out.unionByName(_match_groups_apart(df, group, id_col, iou_thr, max_group_rows, cell))


def _match_groups_apart(df: DataFrame, group: list[str], id_col: str, iou_thr: float, max_group_rows: int, cell: float) -> DataFrame:
    """``nms_match_groups`` of groups that aren't streamed: by the pairs of kept and other boxes."""
    kept = nms(df, group, id_col, iou_thr, max_group_rows=max_group_rows, cell=cell).select(
        *group, id_col, "score", *BOX)
    p = overlap_pairs(kept, df, group, id_col, id_col, cell=cell, left_cols=("score",), right_cols=("score",),
                      out="_iou")
    la = F.struct(*[F.col(f"l_{c}").alias(c) for c in BOX])
    ra = F.struct(*[F.col(f"r_{c}").alias(c) for c in BOX])
    l_first = (F.col("l_score") > F.col("r_score")) | (
        (F.col("l_score") == F.col("r_score")) & (F.col(f"l_{id_col}") < F.col(f"r_{id_col}")))
    p = p.where(l_first & (_iou_struct(la, ra, 0.0) > iou_thr))
    owner = p.groupBy(*group, F.col(f"r_{id_col}").alias(id_col)).agg(
        F.min_by(F.col(f"l_{id_col}"), F.struct(-F.col("l_score"), F.col(f"l_{id_col}"))).alias("_owner"))
    self_k = kept.select(*group, id_col, F.col(id_col).alias("_self"))
    return (df.join(self_k, [*group, id_col], "left").join(owner, [*group, id_col], "left")
              .withColumn("match_group", F.coalesce("_self", "_owner")).drop("_self", "_owner"))


def _decays(iou_thr: float, sigma: float) -> dict:
    """D3: by name, the factor that a remaining score takes for its overlap with the box picked."""
    return {"naive": lambda iou: (iou < iou_thr).astype(float), "linear": lambda iou: np.where(iou < iou_thr, 1.0, 1.0 - iou),
            "gaussian": lambda iou: np.exp(-iou * iou / sigma)}


def soft_nms(df: DataFrame, group: list[str], id_col: str, iou_thr: float = 0.3, sigma: float = 0.5,
             min_score: float = 1e-3, method: str = "linear", offset: float = 0.0) -> DataFrame:
    """D3: soft NMS per group: pick the best score (ties: smaller id), lower the
    scores that overlap it by ``method``, drop those under ``min_score``, repeat.

    A pick depends on every earlier one, so a group, which is an image, is one
    numpy fold of ``applyInPandas``.  Output: picked rows with the lowered
    ``score`` and ``pick`` (order from 1).
    """
    import pandas as pd

    decay = _decays(iou_thr, sigma)[method]
    cols = [*group, id_col, *BOX, "score"]

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(id_col, kind="stable")  # then the first of equal scores has the smallest id
        corners, scores = pdf[list(BOX)].to_numpy(float), pdf["score"].to_numpy(float)
        areas = (corners[:, 2:] - corners[:, :2] + offset).prod(axis=1)
        left, picked, final = np.arange(len(pdf)), [], []
        while len(left):
            best = scores.argmax()
            top, final_score = left[best], scores[best]
            picked.append(top)
            final.append(final_score)
            left, scores = np.delete(left, best), np.delete(scores, best)
            sides = np.minimum(corners[left, 2:], corners[top, 2:]) - np.maximum(corners[left, :2], corners[top, :2]) + offset
            inter = np.clip(sides, 0, None).prod(axis=1)
            union = areas[left] + areas[top] - inter
            scores = scores * decay(np.divide(inter, union, out=np.zeros_like(inter), where=union > 0))  # boxes without area don't overlap
            left, scores = left[scores >= min_score], scores[scores >= min_score]
        return pdf.iloc[picked].assign(score=final, pick=np.arange(1, len(picked) + 1, dtype=np.int64))

    schema = df.select(*cols).schema.add("pick", "long")
    return df.select(*cols).groupBy(*group).applyInPandas(fold, schema)
