"""Annotation ingest, cleaning, joins and exports (S4, S14, P1, P3, P5, P14,
P34, J4, J5, A39, A40).

Tables: ``images(image_id, width, height)``, ``annotations(ann_id,
image_id, x, y, w, h, area, category_id, iscrowd, ignore)`` (COCO xywh),
``categories(category_id)``.  Categories are a small dimension (one row per
class), the only side that is ever broadcast here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def label_map(categories: DataFrame, wanted: list | None = None, key: str = "category_id") -> DataFrame:
    """Wanted categories in id order -> dense label 0..k-1 (a dimension of k rows)."""
    c = categories.select(key).distinct()
    if wanted is not None:
        c = c.where(F.col(key).isin(wanted))
    return c.withColumn("label", (F.row_number().over(Window.orderBy(key)) - 1).cast("int"))


def clean_instances(anns: DataFrame, images: DataFrame, labels: DataFrame) -> DataFrame:
    """Drop ignored annotations, boxes with no overlap with the image,
    area <= 0 or w < 1 or h < 1, and unwanted categories; convert xywh to
    xyxy; crowd -> ignore_flag 1."""
    a = anns.join(images.select("image_id", "width", "height"), "image_id")
    iw = F.greatest(F.least(F.col("x") + F.col("w"), F.col("width")) - F.greatest(F.col("x"), F.lit(0.0)), F.lit(0.0))
    ih = F.greatest(F.least(F.col("y") + F.col("h"), F.col("height")) - F.greatest(F.col("y"), F.lit(0.0)), F.lit(0.0))
    keep = (~F.coalesce(F.col("ignore"), F.lit(False)) & (iw * ih != 0)
            & ~((F.col("area") <= 0) | (F.col("w") < 1) | (F.col("h") < 1)))
    a = a.where(keep).join(labels, "category_id")
    return a.select("ann_id", "image_id", F.col("x").alias("x1"), F.col("y").alias("y1"),
                    (F.col("x") + F.col("w")).alias("x2"), (F.col("y") + F.col("h")).alias("y2"),
                    "label", F.coalesce(F.col("iscrowd"), F.lit(False)).cast("int").alias("ignore_flag"))


def filter_images(images: DataFrame, annotations: DataFrame, labels: DataFrame, filter_empty_gt: bool = True,
                  min_size: float = 0.0) -> DataFrame:
    """Keep images that an annotation of a wanted class names, as it
    stands in the file (cleaning may leave none of them), and with
    min(width, height) >= min_size.  The id-set intersection is a semi join."""
    out = images
    if filter_empty_gt:
        wanted = annotations.join(labels, "category_id", "left_semi").select("image_id").distinct()
        out = out.join(wanted, "image_id", "left_semi")
    return out.where(F.least("width", "height") >= min_size)


def filter_annotations(inst: DataFrame, min_w: float = 1.0, min_h: float = 1.0,
                       keep_empty: bool = True) -> DataFrame:
    """P5: keep boxes with w > min_w and h > min_h.  As in the reference, an image
    whose boxes all fail is dropped if ``keep_empty`` is true; if it is false the
    image stays, as a row without a box."""
    ok = ((F.col("x2") - F.col("x1")) > min_w) & ((F.col("y2") - F.col("y1")) > min_h)
    kept = inst.where(ok)
    if keep_empty:
        return kept
    emptied = inst.select("image_id").distinct().join(kept.select("image_id").distinct(), "image_id", "left_anti")
    return kept.unionByName(emptied, allowMissingColumns=True)


def with_empty_images(instances: DataFrame, images: DataFrame) -> DataFrame:
    """Images without instances are added as rows with NULL instance
    columns (anti join + union by name)."""
    empty = images.select("image_id").join(instances.select("image_id").distinct(), "image_id", "left_anti")
    return instances.unionByName(empty, allowMissingColumns=True)


def class_images(instances: DataFrame, label: str = "label") -> DataFrame:
    """Distinct (class, image) pairs, the long form of the class -> images index."""
    return instances.select(label, "image_id").distinct()


def nest_by_image(instances: DataFrame, order: str = "ann_id") -> DataFrame:
    """One row per image with its instances as an ordered array."""
    rec = F.struct(F.col(order).alias("_o"), *[F.col(c) for c in instances.columns if c != "image_id"])
    return instances.groupBy("image_id").agg(F.array_sort(F.collect_list(rec)).alias("instances"))


def unnest(nested: DataFrame) -> DataFrame:
    """Back to one row per instance."""
    return nested.select("image_id", F.inline("instances")).drop("_o")


def to_coco_results(dets: DataFrame) -> DataFrame:
    """Detections as COCO result records (xyxy -> xywh), one JSON per row."""
    return dets.select(F.to_json(F.struct(
        F.col("image_id"), F.col("class_id").alias("category_id"), F.col("det_id").alias("id"),
        F.array(F.col("x1"), F.col("y1"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")).alias("bbox"),
        F.col("score"))).alias("value"))


def read_coco_results(spark, path: str) -> DataFrame:
    """S4 for result files: JSON lines of COCO records -> xyxy rows."""
    schema = "image_id long, category_id string, id long, bbox array<double>, score double"
    r = spark.read.schema(schema).json(path)
    b = F.col("bbox")
    return r.select("image_id", F.col("category_id").alias("class_id"), F.col("id").alias("det_id"),
                    b[0].alias("x1"), b[1].alias("y1"), (b[0] + b[2]).alias("x2"), (b[1] + b[3]).alias("y2"), "score")


def read_coco_dataset(spark, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A COCO dataset file (images, annotations, categories arrays) ->
    (images, annotations, categories) DataFrames; the optional unique-id check
    is ``annotations.groupBy('ann_id').count().where('count > 1')``."""
    raw = spark.read.option("multiLine", True).json(path)
    images = raw.select(F.explode("images").alias("i")).select(
        F.col("i.id").alias("image_id"), F.col("i.width").alias("width"), F.col("i.height").alias("height"),
        F.col("i.file_name").alias("file_name"))
    named = raw.schema["annotations"].dataType.elementType.names
    ignore = F.coalesce(F.col("a.ignore").cast("boolean"), F.lit(False)) if "ignore" in named else F.lit(False)
    anns = raw.select(F.explode("annotations").alias("a")).select(
        F.col("a.id").alias("ann_id"), F.col("a.image_id").alias("image_id"),
        F.col("a.bbox")[0].alias("x"), F.col("a.bbox")[1].alias("y"), F.col("a.bbox")[2].alias("w"),
        F.col("a.bbox")[3].alias("h"), F.col("a.area").alias("area"), F.col("a.category_id").alias("category_id"),
        (F.col("a.iscrowd") == 1).alias("iscrowd"), ignore.alias("ignore"))
    cats = raw.select(F.explode("categories").alias("c")).select(F.col("c.id").alias("category_id"))
    return images, anns, cats
