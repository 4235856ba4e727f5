"""Panoptic quality (A23) and recall of listed masks (A24) from counted pixels.

``cells`` counts pixels per (image, gt_seg, pred_seg), segment 0 being no
segment (void).  ``gts`` lists segments (image, seg, category, crowd), ``preds``
(image, seg, category).  All is joins and grouped sums on these; no picture is
ever in a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = 0


def segment_overlaps(cells: DataFrame, gts: DataFrame, preds: DataFrame, image: str = "image_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs with iou, gts with area, preds with area and void): the union of a pair leaves out the prediction's void pixels."""
    n = cells.groupBy(image, "gt_seg", "pred_seg").agg(F.sum("pixels").alias("pixels"))
    g_area = n.groupBy(image, F.col("gt_seg").alias("seg")).agg(F.sum("pixels").alias("area"))
    p_area = n.groupBy(image, F.col("pred_seg").alias("seg")).agg(F.sum("pixels").alias("area"), F.sum(F.when(F.col("gt_seg") == VOID, F.col("pixels")).otherwise(0)).alias("void"))
    g = gts.join(g_area, [image, "seg"], "left").fillna(0, ["area"])
    p = preds.join(p_area, [image, "seg"])  # a prediction without a pixel isn't one
    gs = g.select(image, F.col("seg").alias("gt_seg"), F.col("category").alias("category"), "crowd", F.col("area").alias("_ga"))
    ps = p.select(image, F.col("seg").alias("pred_seg"), F.col("category").alias("_pc"), F.col("area").alias("_pa"), "void")
    pairs = n.join(gs, [image, "gt_seg"]).join(ps, [image, "pred_seg"])
    iou = F.col("pixels") / (F.col("_pa") + F.col("_ga") - F.col("pixels") - F.col("void"))
    return pairs.withColumn("iou", iou).withColumn("same", F.col("category") == F.col("_pc")), g, p


def panoptic_counts(cells: DataFrame, gts: DataFrame, preds: DataFrame, image: str = "image_id") -> DataFrame:
    """category, iou (sum over true positives), tp, fp, fn.

    A pair of one category with IoU > 0.5 is a match (there can be one only).  A
    crowd matches nothing and isn't missed.  An unmatched prediction more than
    half of which is void or in its image's crowd of its category (the last one
    by number) isn't counted.
    """
    pairs, g, p = segment_overlaps(cells, gts, preds, image)
    hits = pairs.where(F.col("same") & ~F.col("crowd") & (F.col("iou") > 0.5))
    tp = hits.groupBy("category").agg(F.sum("iou").alias("iou"), F.count(F.lit(1)).alias("tp"))
    missed = g.where(~F.col("crowd")).join(hits.select(image, F.col("gt_seg").alias("seg")), [image, "seg"], "left_anti")
    crowds = g.where("crowd").groupBy(image, "category").agg(F.max("seg").alias("gt_seg"))
    inside = pairs.select(image, "gt_seg", "pred_seg", "pixels").join(crowds, [image, "gt_seg"]).select(image, F.col("pred_seg").alias("seg"), "category", F.col("pixels").alias("_crowd"))
    rest = p.join(hits.select(image, F.col("pred_seg").alias("seg")), [image, "seg"], "left_anti").join(inside, [image, "seg", "category"], "left")
    wrong = rest.where((F.col("void") + F.coalesce("_crowd", F.lit(0))) / F.col("area") <= 0.5)
    parts = tp.select("category", "iou", "tp", F.lit(0).alias("fp"), F.lit(0).alias("fn"))
    for df, col in ((wrong, "fp"), (missed, "fn")):
        counted = df.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
        parts = parts.unionByName(counted.select("category", F.lit(0.0).alias("iou"), F.lit(0).alias("tp"), *[(F.col("n") if c == col else F.lit(0)).alias(c) for c in ("fp", "fn")]))
    return parts.groupBy("category").agg(F.sum("iou").alias("iou"), *[F.sum(c).cast("long").alias(c) for c in ("tp", "fp", "fn")])


def panoptic_quality(counts: DataFrame) -> DataFrame:
    """category, pq, sq, rq and the counts; categories without any count have no row."""
    whole = F.col("tp") + 0.5 * F.col("fp") + 0.5 * F.col("fn")
    sq = F.when(F.col("tp") > 0, F.col("iou") / F.col("tp")).otherwise(0.0)
    return counts.where(whole > 0).select("category", (F.col("iou") / whole).alias("pq"), sq.alias("sq"), (F.col("tp") / whole).alias("rq"), "tp", "fp", "fn")


def panoptic_summary(quality: DataFrame, things: list) -> DataFrame:
    """part (All, Things, Stuff), pq, sq, rq and n: means over the categories of a part."""
    thing = F.col("category").isin(things)
    part = F.explode(F.array(F.lit("All"), F.when(thing, F.lit("Things")).otherwise(F.lit("Stuff"))))
    return quality.withColumn("part", part).groupBy("part").agg(*[F.avg(c).alias(c) for c in ("pq", "sq", "rq")], F.count(F.lit(1)).alias("n"))


def listed_recall(pairs: DataFrame, listed: DataFrame, keys: tuple[str, ...] = ("image_id", "category"), gt: str = "gt_seg", score_thr: float = 0.3, iou_thr: float = 0.75) -> DataFrame:
    """A24, one row: hits, listed and recall of the masks in ``listed`` (keys, gt) that some prediction of their class covers.

    ``pairs`` has keys, gt, iou and score of predicted masks with ground truths.
    """
    found = pairs.where((F.col("iou") >= iou_thr) & (F.col("score") >= score_thr)).select(*keys, gt).distinct()
    flags = listed.select(*keys, gt).join(found.withColumn("_hit", F.lit(1)), [*keys, gt], "left")
    return flags.agg(F.count("_hit").alias("hits"), F.count(F.lit(1)).alias("listed")).withColumn("recall", F.when(F.col("listed") > 0, F.col("hits") / F.col("listed")).otherwise(0.0))
