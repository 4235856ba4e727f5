"""Round trips through annotation and sample formats (S1, S2, S6-S10, S13, S15, S16): the tables written in the format and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kestrel.operators import classification as C
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_views
from kestrel.session import checkpoint_dir
from kestrel.sources import formats as FM
from kestrel.sources import tables as T


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("landmark_scan", """SELECT vec_id AS sample_id, CAST(label AS VARCHAR) AS emotion, concat('s/', vec_id) AS file_path,
  CAST(round(embedding[1], 6) AS DOUBLE) AS first_x, CAST(round(embedding[64], 6) AS DOUBLE) AS last_y FROM embeddings WHERE label IN (1, 3, 5) AND vec_id % 7 <> 0""")
def landmark_scan(spark, sf_dir):
    """Samples in a folder per label, three labels read; every seventh sample is empty."""
    path = _folder(spark, "landmarks")
    points = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda p: F.array(F.element_at("embedding", 2 * p + 1).cast("double"), F.element_at("embedding", 2 * p + 2).cast("double")))
    e = T.table(spark, sf_dir, "embeddings")
    FM.write_samples(e.select(F.col("label").cast("string").alias("emotion"), F.concat(F.lit("s/"), "vec_id").alias("input_file"),
                              F.when(F.col("vec_id") % 7 != 0, points).otherwise(F.array().cast("array<array<double>>")).alias("head_keypoints")), path)
    r = FM.read_samples(spark, path, labels=["1", "3", "5", "none such"])
    return r.select(F.substring("file_path", 3, 20).cast("long").alias("sample_id"), "emotion", "file_path", F.round(F.col("head_keypoints")[0][0], 6).alias("first_x"),
                    F.round(F.col("head_keypoints")[31][1], 6).alias("last_y"))


@register("feature_scan", """SELECT CAST(label AS VARCHAR) AS emotion, count(*) AS n, round(sum(CAST(embedding[2] AS DOUBLE)), 4) AS s FROM embeddings GROUP BY label""")
def feature_scan(spark, sf_dir):
    """Precomputed features by label."""
    path = _folder(spark, "features")
    e = T.table(spark, sf_dir, "embeddings")
    FM.write_samples(e.select(F.col("label").cast("string").alias("emotion"), F.col("embedding").cast("array<double>").alias("features")), path)
    r = FM.read_samples(spark, path, FM.FEATURES, "features").where("file_path IS NOT NULL")
    return r.groupBy("emotion").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("features")[1]), 4).alias("s"))


_GT = with_views("gt_boxes")


def _boxes(spark, sf_dir):
    return T.gt_boxes(spark, sf_dir)


@register("crowd_scan", _GT + """SELECT CAST(image_id AS VARCHAR) AS img_id, CASE WHEN class_id = 'A' OR ignore_flag THEN -1 WHEN class_id = 'N' THEN 0 ELSE 1 END AS label,
  CASE WHEN class_id = 'A' OR ignore_flag THEN 1 ELSE 0 END AS ignore_flag, round(x1, 4) AS x1, round(x2, 4) AS x2, round(y1 + (y2 - y1) / 2, 4) AS head_y2 FROM gt_boxes""")
def crowd_scan(spark, sf_dir):
    """A record an image; class A is an unknown tag, ignored boxes say so."""
    path = _folder(spark, "crowd")
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    box = F.struct(F.col("class_id").alias("tag"), F.array("x1", "y1", w, h).alias("fbox"), F.array(F.col("x1"), F.col("y1"), w / 2, h / 2).alias("hbox"),
                   F.array("x1", "y1", w, h).alias("vbox"), F.when(F.col("ignore_flag"), F.struct(F.lit(1).alias("ignore"))).alias("extra"))
    _boxes(spark, sf_dir).groupBy(F.col("image_id").cast("string").alias("ID")).agg(F.collect_list(box).alias("gtboxes")).write.json(path)
    r = FM.read_crowd(spark, path, ("N", "R"))
    return r.select("img_id", "label", "ignore_flag", F.round(F.col("bbox")[0], 4).alias("x1"), F.round(F.col("bbox")[2], 4).alias("x2"), F.round(F.col("hbox")[3], 4).alias("head_y2"))


@register("open_boxes_scan", _GT + """SELECT CAST(image_id AS VARCHAR) AS image_id, CASE class_id WHEN 'N' THEN 0 ELSE 1 END AS label, round(x1, 3) AS x1, round(y2, 3) AS y2,
  ignore_flag AS is_occluded, gt_id % 4 = 0 AS is_group_of FROM gt_boxes WHERE class_id <> 'A' AND image_id % 10 <> 3""")
def open_boxes_scan(spark, sf_dir):
    """Boxes as shares of an image of 200 by 100, one class and some images unknown."""
    path = _folder(spark, "open")
    g = _boxes(spark, sf_dir)
    flag = lambda c: c.cast("int")
    g.select(F.col("image_id").cast("string").alias("ImageID"), F.lit("xclick").alias("Source"), F.col("class_id").alias("LabelName"), F.lit(1.0).alias("Confidence"),
             (F.col("x1") / 200).alias("XMin"), (F.col("x2") / 200).alias("XMax"), (F.col("y1") / 100).alias("YMin"), (F.col("y2") / 100).alias("YMax"), flag(F.col("ignore_flag")).alias("IsOccluded"),
             F.lit(0).alias("IsTruncated"), flag(F.col("gt_id") % 4 == 0).alias("IsGroupOf"), F.lit(0).alias("IsDepiction"), F.lit(0).alias("IsInside")).write.option("header", True).csv(path)
    images = g.where("image_id % 10 <> 3").select(F.col("image_id").cast("string").alias("image_id")).distinct().withColumns({"width": F.lit(200), "height": F.lit(100)})
    classes = spark.createDataFrame([("N", 0), ("R", 1)], "label_name string, label int")
    r = FM.read_open_boxes(spark, path, images, classes)
    return r.select("image_id", "label", F.round("x1", 3).alias("x1"), F.round("y2", 3).alias("y2"), "is_occluded", "is_group_of")


@register("voc_scan", _GT + """SELECT CAST(image_id AS VARCHAR) AS img_id, CASE class_id WHEN 'N' THEN 0 ELSE 1 END AS label,
  CAST(ignore_flag OR round(x2, 2) - round(x1, 2) < 30 OR round(y2, 2) - round(y1, 2) < 30 AS INTEGER) AS ignore_flag, round(round(x1, 2) - 1, 4) AS x1, round(round(y2, 2) - 1, 4) AS y2
FROM gt_boxes WHERE class_id <> 'A'""")
def voc_scan(spark, sf_dir):
    """An XML record an image; class A is unknown, boxes under 30 units ignored."""
    path = _folder(spark, "voc")
    r = lambda c: F.round(c, 2).alias({"x1": "xmin", "y1": "ymin", "x2": "xmax", "y2": "ymax"}[c])
    o = F.struct(F.col("class_id").alias("name"), F.col("ignore_flag").cast("int").alias("difficult"), F.struct(*[r(c) for c in ("x1", "y1", "x2", "y2")]).alias("bndbox"))
    rows = _boxes(spark, sf_dir).groupBy("image_id").agg(F.collect_list(o).alias("object"))
    FM.write_voc(rows.select(F.concat(F.col("image_id").cast("string"), F.lit(".jpg")).alias("filename"),
                             F.struct(F.lit(200).alias("width"), F.lit(100).alias("height"), F.lit(3).alias("depth")).alias("size"), "object"), path)
    v = FM.read_voc(spark, path, ["N", "R"], 30.0)
    return v.select("img_id", "label", "ignore_flag", F.round("x1", 4).alias("x1"), F.round("y2", 4).alias("y2"))


@register("keypoint_scan", _GT + """SELECT gt_id AS id, image_id AS img_id, round(least(x1, 49), 4) AS x1, round(least(y2, 39), 4) AS y2, round(x2, 4) AS last_x,
  CASE WHEN gt_id % 3 = 0 THEN 0.0 ELSE 1.0 END AS first_visible, CASE WHEN gt_id % 5 = 0 THEN 2 ELSE 1 + CAST(greatest(x1, y1) <> 0 AS INTEGER) END AS num_keypoints,
  round(CASE WHEN gt_id % 2 = 0 THEN 7.5 ELSE greatest((least(x2, 49) - least(x1, 49)) * (least(y2, 39) - least(y1, 39)) * 0.53, 1) END, 4) AS area FROM gt_boxes WHERE image_id % 3 = 0""")
def keypoint_scan(spark, sf_dir):
    """Every third image of 50 by 40, corners as joints; some areas and numbers of keypoints are missing."""
    path = _folder(spark, "joints")
    g = _boxes(spark, sf_dir)
    v = F.when(F.col("gt_id") % 3 == 0, 0.0).otherwise(2.0)
    g.select(F.col("gt_id").alias("id"), "image_id", F.lit(1).alias("category_id"), F.array("x1", "y1", F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")).alias("bbox"),
             F.array(F.col("x1"), F.col("y1"), v, F.col("x2"), F.col("y2"), F.lit(1.0)).alias("keypoints"), F.when(F.col("gt_id") % 5 == 0, 2).alias("num_keypoints"),
             F.when(F.col("gt_id") % 2 == 0, 7.5).alias("area")).write.json(path)
    images = g.select("image_id").distinct().withColumns({"width": F.lit(50), "height": F.lit(40)})
    r = FM.read_keypoints(spark, path, images, 3)
    return r.select("id", "img_id", F.round("x1", 4).alias("x1"), F.round("y2", 4).alias("y2"), F.round(F.col("keypoints")[1][0], 4).alias("last_x"),
                    F.col("visible")[0].alias("first_visible"), "num_keypoints", F.round("area", 4).alias("area"))


_DETS = with_views("det_boxes") + """, d AS (SELECT *, CASE WHEN class_id = 'N' THEN 1 ELSE 2 END AS cat FROM det_boxes)"""


@register("detections_scan", _DETS + """SELECT row_number() OVER (ORDER BY image_id, score DESC, x1, y1, x2 - x1, y2 - y1) - 1 AS id, image_id, x1, round(x2, 4) AS x2, score, 5 AS joints
FROM d WHERE cat = 1 AND image_id % 10 <> 3""")
def detections_scan(spark, sf_dir):
    """Detections of category 1 on known images, with joints to be filled."""
    path = _folder(spark, "dets")
    d = T.det_boxes(spark, sf_dir)
    d.select("image_id", F.when(F.col("class_id") == "N", 1).otherwise(2).alias("category_id"), F.array("x1", "y1", F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")).alias("bbox"), "score").write.json(path)
    images = d.where("image_id % 10 <> 3").select("image_id").distinct().withColumns({"width": F.lit(200), "height": F.lit(100)})
    r = FM.read_detections(spark, path, images, 5)
    return r.select("id", "image_id", "x1", F.round("x2", 4).alias("x2"), "score", F.size("keypoints").alias("joints"))


@register("split_manifest", """WITH r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat('42-', vec_id)), vec_id) AS rk, count(*) OVER (PARTITION BY label) AS n FROM embeddings)
SELECT CASE WHEN rk <= ceil(n*0.2) THEN 'test' WHEN rk <= ceil(n*0.2) + ceil((n-ceil(n*0.2))*(0.3/(1.0-0.2))) THEN 'val' ELSE 'train' END AS split, count(*) AS n FROM r GROUP BY 1""")
def split_manifest(spark, sf_dir):
    """The stratified split as CSV, and the rows per split that it holds."""
    e = T.table(spark, sf_dir, "embeddings").select("vec_id", "label", F.concat(F.lit("s/"), "vec_id").alias("path"))
    return FM.write_split_manifest(C.stratified_split(e, "label", "vec_id"), _folder(spark, "manifest"), "path", "label")


@register("proposal_dump", with_views("det_boxes") + """SELECT image_id, CAST(row_number() OVER w - 1 AS INTEGER) AS pos, det_id, score, round(x2, 4) AS x2 FROM det_boxes
WINDOW w AS (PARTITION BY image_id ORDER BY score DESC, det_id) QUALIFY row_number() OVER w <= 5""")
def proposal_dump(spark, sf_dir):
    """The five best predictions of every image, in order."""
    path = _folder(spark, "proposals")
    FM.dump_predictions(T.det_boxes(spark, sf_dir), path, 5)
    r = spark.read.parquet(path).select("image_id", F.posexplode("predictions").alias("pos", "p"))
    return r.select("image_id", "pos", "p.det_id", "p.score", F.round("p.x2", 4).alias("x2"))


@register("bad_cases", with_views("predictions") + """SELECT sample_id, label, pred, confidence FROM predictions WHERE confidence <= 0.1""")
def bad_cases(spark, sf_dir):
    """Predictions of a confidence of 0.1 or less, through JSON."""
    p = T.predictions(spark, sf_dir).select("sample_id", "label", "pred", "confidence")
    return FM.write_bad_cases(p, _folder(spark, "bad"), "confidence", 0.1, "accuracy")
