"""Queries for annotation cleaning, nesting and COCO export/ingest
(P1, P3, P5, J4, J5, A39, A40, S4, S14)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kestrel.operators import annotations as A
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_views
from kestrel.session import checkpoint_dir
from kestrel.sources import tables as T

W, H = 40.0, 30.0
WANTED = ["A", "R"]


def _inputs(spark, sf_dir):
    g = T.gt_boxes(spark, sf_dir)
    images = g.select("image_id").distinct().select("image_id", F.lit(W).alias("width"), F.lit(H).alias("height"))
    anns = g.select(F.col("gt_id").alias("ann_id"), "image_id", F.col("x1").alias("x"), F.col("y1").alias("y"),
                    (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"),
                    ((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).alias("area"),
                    F.col("class_id").alias("category_id"), F.col("ignore_flag").alias("iscrowd"),
                    F.lit(False).alias("ignore"))
    cats = g.select(F.col("class_id").alias("category_id")).distinct()
    return images, anns, cats


def _clean(spark, sf_dir):
    images, anns, cats = _inputs(spark, sf_dir)
    return A.clean_instances(anns, images, A.label_map(cats, WANTED)), images


_CLEAN_SQL = with_views("gt_boxes") + f""",
lab AS (SELECT class_id, CAST(row_number() OVER (ORDER BY class_id) - 1 AS INTEGER) AS label
        FROM (SELECT DISTINCT class_id FROM gt_boxes WHERE class_id IN ('A', 'R'))),
a AS (SELECT gt_id AS ann_id, image_id, x1 AS x, y1 AS y, x2 - x1 AS w, y2 - y1 AS h, (x2-x1)*(y2-y1) AS area,
        class_id, ignore_flag FROM gt_boxes),
c AS (SELECT a.*, lab.label FROM a JOIN lab USING (class_id)
      WHERE greatest(least(x + w, {W}) - greatest(x, 0.0), 0.0) * greatest(least(y + h, {H}) - greatest(y, 0.0), 0.0) <> 0
        AND NOT (area <= 0 OR w < 1 OR h < 1))
"""


@register("clean_annotations", _CLEAN_SQL + """
SELECT ann_id, image_id, round(x, 6) AS x1, round(y, 6) AS y1, round(x + w, 6) AS x2, round(y + h, 6) AS y2,
  label, CAST(ignore_flag AS INTEGER) AS ignore_flag FROM c""")
def clean_annotations(spark, sf_dir):
    """P1 + J5: clean ground-truth boxes in a 40x30 image, classes A and R."""
    inst, _ = _clean(spark, sf_dir)
    return inst.select("ann_id", "image_id", *[F.round(c, 6).alias(c) for c in ("x1", "y1", "x2", "y2")],
                       "label", "ignore_flag")


@register("filter_images", with_views("gt_boxes") + "SELECT DISTINCT image_id FROM gt_boxes WHERE class_id IN ('A', 'R')")
def filter_images(spark, sf_dir):
    """Images with an annotation of a wanted class."""
    images, anns, cats = _inputs(spark, sf_dir)
    return A.filter_images(images, anns, A.label_map(cats, WANTED), True, 0.0).select("image_id")


@register("images_with_empty", _CLEAN_SQL + """
SELECT i.image_id, count(c.ann_id) AS n_instances
FROM (SELECT DISTINCT image_id FROM gt_boxes) i LEFT JOIN c USING (image_id) GROUP BY i.image_id""")
def images_with_empty(spark, sf_dir):
    """Every image, including those left without instances."""
    inst, images = _clean(spark, sf_dir)
    rows = A.with_empty_images(inst, images)
    return rows.groupBy("image_id").agg(F.count("ann_id").alias("n_instances"))


@register("filter_small_boxes", _CLEAN_SQL + """,
k AS (SELECT * FROM c WHERE w > 30 AND h > 20)
SELECT i.image_id, count(k.ann_id) AS n_kept FROM (SELECT DISTINCT image_id FROM c) i
LEFT JOIN k USING (image_id) GROUP BY i.image_id""")
def filter_small_boxes(spark, sf_dir):
    """P5: keep boxes wider than 30 and taller than 20; emptied images are kept."""
    inst, _ = _clean(spark, sf_dir)
    f = A.filter_annotations(inst, 30.0, 20.0, keep_empty=False)
    return f.groupBy("image_id").agg(F.count("ann_id").alias("n_kept"))


@register("class_image_index", _CLEAN_SQL + "SELECT DISTINCT label, image_id FROM c")
def class_image_index(spark, sf_dir):
    """Distinct (class, image) pairs."""
    inst, _ = _clean(spark, sf_dir)
    return A.class_images(inst)


@register("nested_images", _CLEAN_SQL + """
SELECT image_id, count(*) AS n_instances, min(ann_id) AS first_ann, round(sum(x), 6) AS sum_x1 FROM c GROUP BY image_id""")
def nested_images(spark, sf_dir):
    """Instances nested per image, then unnested again."""
    inst, _ = _clean(spark, sf_dir)
    nested = A.nest_by_image(inst)
    flat = A.unnest(nested)
    first = nested.select("image_id", F.size("instances").cast("long").alias("n_instances"),
                          F.col("instances")[0]["ann_id"].alias("first_ann"))
    sx = flat.groupBy("image_id").agg(F.round(F.sum("x1"), 6).alias("sum_x1"))
    return first.join(sx, "image_id")


@register("coco_results_roundtrip", with_views("det_boxes") + """
SELECT det_id, image_id, class_id, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2,
  round(score, 6) AS score FROM det_boxes""")
def coco_results_roundtrip(spark, sf_dir):
    """S14 then S4: detections written as COCO result JSON lines and read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/coco-results-{uuid.uuid4().hex}"
    A.to_coco_results(T.det_boxes(spark, sf_dir)).write.text(path)
    r = A.read_coco_results(spark, path)
    return r.select("det_id", "image_id", "class_id", *[F.round(c, 6).alias(c) for c in ("x1", "y1", "x2", "y2")],
                    F.round("score", 6).alias("score"))
