"""Annotation and sample formats: scans with declared schemas, and the writers that make them.

No scan infers a schema, so a read is one pass and extra fields cost nothing.
Records that don't parse are left out, and nested lists become rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.selection import top_n_per_group

LANDMARKS = "head_keypoints array<array<double>>, head_scores array<double>, image_size array<double>, input_file string"
FEATURES = "features array<double>, original_landmark_path string, input_file string"


# -- S1, S2: samples in a folder per label

def write_samples(df: DataFrame, path: str, label: str = "emotion") -> None:
    """One JSON record a sample, in folders ``<label>=<value>``."""
    df.write.partitionBy(label).json(path)


def read_samples(spark: SparkSession, path: str, schema: str = LANDMARKS, values: str = "head_keypoints", labels: list[str] | None = None, label: str = "emotion") -> DataFrame:
    """S1 (S2 with ``FEATURES`` and "features"): samples with their label and ``file_path``.

    Only folders of the wanted ``labels`` are listed and read (a label without a
    folder gives no row); records that don't parse, and samples of null or no
    ``values``, are left out.  ``file_path`` is the sample's original path if it
    has one, else its file.
    """
    read = spark.read.schema(f"{schema}, {label} string").option("mode", "DROPMALFORMED").json(path)
    if labels is not None:
        read = read.where(F.col(label).isin(labels))
    paths = [F.col(c) for c in ("original_landmark_path", "input_file") if c in read.columns]
    return read.where(F.size(values) > 0).withColumn("file_path", F.coalesce(*paths, F.input_file_name()))


# -- S7: one JSON record an image, a list of people

CROWD = ("ID string, gtboxes array<struct<tag: string, fbox: array<double>, hbox: array<double>, vbox: array<double>, extra: struct<ignore: int>, head_attr: struct<ignore: int>>>")


def _corners(box: Column) -> Column:
    x, y, w, h = (F.get(box, i) for i in range(4))
    return F.array(x, y, x + w, y + h)


def read_crowd(spark: SparkSession, path: str, classes: tuple[str, ...] = ("person",)) -> DataFrame:
    """img_id, pos, label, ignore_flag, bbox, hbox, vbox (x1, y1, x2, y2) per box; an unknown tag or ``extra.ignore`` other than 0 is label -1, ignored."""
    rows = spark.read.schema(CROWD).option("mode", "DROPMALFORMED").json(path)
    b = rows.select(F.col("ID").alias("img_id"), F.posexplode("gtboxes").alias("pos", "b"))
    at = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("b.tag")) - 1
    ignored = (F.coalesce(at, F.lit(-1)) < 0) | (F.coalesce("b.extra.ignore", F.lit(0)) != 0)
    return b.select("img_id", "pos", F.when(ignored, -1).otherwise(at).cast("int").alias("label"), ignored.cast("int").alias("ignore_flag"),
                    _corners(F.col("b.fbox")).alias("bbox"), _corners(F.col("b.hbox")).alias("hbox"), _corners(F.col("b.vbox")).alias("vbox"))


# -- S6: boxes and image-level labels as CSV

OPEN_BOXES = ("ImageID string, Source string, LabelName string, Confidence double, XMin double, XMax double, YMin double, YMax double, "
              "IsOccluded int, IsTruncated int, IsGroupOf int, IsDepiction int, IsInside int")
OPEN_LABELS = "ImageID string, Source string, LabelName string, Confidence double"


def read_open_boxes(spark: SparkSession, path: str, images: DataFrame, classes: DataFrame) -> DataFrame:
    """image_id, label, x1, y1, x2, y2 in pixels and the five flags per box; shares of width and height times the image's size.

    ``images`` has image_id, width, height, ``classes`` label_name, label; boxes of
    other images or classes are left out.
    """
    b = spark.read.schema(OPEN_BOXES).option("header", True).option("mode", "DROPMALFORMED").csv(path)
    j = b.join(images.select(F.col("image_id").alias("ImageID"), "width", "height"), "ImageID").join(classes.withColumnRenamed("label_name", "LabelName"), "LabelName")
    flags = {"is_occluded": "IsOccluded", "is_truncated": "IsTruncated", "is_group_of": "IsGroupOf", "is_depiction": "IsDepiction", "is_inside": "IsInside"}
    return j.select(F.col("ImageID").alias("image_id"), "label", (F.col("XMin") * F.col("width")).alias("x1"), (F.col("YMin") * F.col("height")).alias("y1"),
                    (F.col("XMax") * F.col("width")).alias("x2"), (F.col("YMax") * F.col("height")).alias("y2"), *[(F.col(c) == 1).alias(n) for n, c in flags.items()])


def read_open_labels(spark: SparkSession, path: str, classes: DataFrame) -> DataFrame:
    """image_id, label, confidence of image-level labels."""
    rows = spark.read.schema(OPEN_LABELS).option("header", True).option("mode", "DROPMALFORMED").csv(path)
    return rows.join(classes.withColumnRenamed("label_name", "LabelName"), "LabelName").select(F.col("ImageID").alias("image_id"), "label", F.col("Confidence").alias("confidence"))


# -- S8: one XML record an image

VOC = ("filename string, size struct<width: int, height: int, depth: int>, "
       "object array<struct<name: string, difficult: int, bndbox: struct<xmin: double, ymin: double, xmax: double, ymax: double>>>")


def write_voc(images: DataFrame, path: str) -> None:
    """Rows of the columns of ``VOC`` as XML."""
    images.write.format("xml").option("rootTag", "annotations").option("rowTag", "annotation").save(path)


def read_voc(spark: SparkSession, path: str, classes: list[str], min_size: float = 0.0, minus_one: bool = True) -> DataFrame:
    """img_id (file name without its ending), pos, label, ignore_flag, x1, y1, x2, y2 per object of a known class.

    Coordinates are counted from 0 (``minus_one``); difficult objects and boxes
    narrower or lower than ``min_size`` are ignored.
    """
    rows = spark.read.format("xml").option("rowTag", "annotation").schema(VOC).load(path)
    o = rows.select(F.regexp_replace("filename", r"\.[^.]*$", "").alias("img_id"), F.posexplode("object").alias("pos", "o"))
    known = F.array(*[F.lit(c) for c in classes])
    off = 1 if minus_one else 0
    x1, y1, x2, y2 = (F.col(f"o.bndbox.{c}") - off for c in ("xmin", "ymin", "xmax", "ymax"))
    small = (x2 - x1 < min_size) | (y2 - y1 < min_size)
    return o.where(F.array_contains(known, F.col("o.name"))).select(
        "img_id", "pos", (F.array_position(known, F.col("o.name")) - 1).cast("int").alias("label"),
        ((F.coalesce("o.difficult", F.lit(0)) != 0) | small).cast("int").alias("ignore_flag"), x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


# -- S9: keypoint annotations, a record a line

KEYPOINTS = ("id long, image_id long, category_id int, iscrowd int, bbox array<double>, keypoints array<double>, num_keypoints int, area double")


def keypoint_instances(annotations: DataFrame, images: DataFrame, sample_interval: int = 1) -> DataFrame:
    """Id, img_id, category_id, x1, y1, x2, y2, keypoints (x, y), visible, num_keypoints, area and iscrowd per annotation.

    ``annotations`` has the columns of ``KEYPOINTS`` (keypoints x, y, v in a row),
    ``images`` image_id, width, height.  Only images whose id is a multiple of
    ``sample_interval`` are read.  Boxes are clipped to the image, visibility is at
    most 1; a missing area is 0.53 of the clipped box (1 at least), a missing
    number of keypoints that of joints with a coordinate over 0 (or both under).
    Annotations without box or keypoints, or on unknown images, are left out.
    """
    a = annotations.where((F.col("image_id") % sample_interval == 0) & F.col("bbox").isNotNull() & F.col("keypoints").isNotNull())
    j = a.join(images.select("image_id", "width", "height"), "image_id")

    def clipped(v: Column, side: str) -> Column:
        return F.least(F.greatest(v, F.lit(0.0)), F.col(side) - 1.0)

    x, y, w, h = (F.get("bbox", i) for i in range(4))
    j = j.withColumns({"x1": clipped(x, "width"), "y1": clipped(y, "height"), "x2": clipped(x + w, "width"), "y2": clipped(y + h, "height")})
    joints = F.transform(F.sequence(F.lit(0), F.floor(F.size("keypoints") / 3).cast("int") - 1), lambda k: F.struct(
        F.get("keypoints", 3 * k).alias("x"), F.get("keypoints", 3 * k + 1).alias("y"), F.get("keypoints", 3 * k + 2).alias("v")))
    j = j.withColumn("_j", F.when(F.size("keypoints") >= 3, joints).otherwise(F.array().cast("array<struct<x:double,y:double,v:double>>")))
    counted = F.size(F.filter("_j", lambda p: F.greatest(p["x"], p["y"]) != 0))
    area = F.greatest((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) * 0.53, F.lit(1.0))
    return j.select("id", F.col("image_id").alias("img_id"), "category_id", "x1", "y1", "x2", "y2", F.transform("_j", lambda p: F.array(p["x"], p["y"])).alias("keypoints"),
                    F.transform("_j", lambda p: F.least(F.lit(1.0), p["v"])).alias("visible"), F.coalesce("num_keypoints", counted).alias("num_keypoints"),
                    F.coalesce("area", area).alias("area"), F.coalesce("iscrowd", F.lit(0)).alias("iscrowd"))


def read_keypoints(spark: SparkSession, path: str, images: DataFrame, sample_interval: int = 1) -> DataFrame:
    """S9 from JSON records, one a line."""
    rows = spark.read.schema(KEYPOINTS).option("mode", "DROPMALFORMED").json(path)
    return keypoint_instances(rows, images, sample_interval)


# -- S10: detections for a pose model

DETECTIONS = "image_id long, category_id int, bbox array<double>, score double"


def read_detections(spark: SparkSession, path: str, images: DataFrame, n_joints: int, category: int = 1) -> DataFrame:
    """Id, image_id, x1, y1, x2, y2, score, width, height, keypoints (zeros) and visible (ones) of the detections of one category.

    Ids run from 0 by image, then falling score, then box; images not in
    ``images`` (image_id, width, height) give nothing.
    """
    from kestrel.plans.ordered import running

    d = spark.read.schema(DETECTIONS).option("mode", "DROPMALFORMED").json(path).where(F.col("category_id") == category)
    j = d.join(images.select("image_id", "width", "height"), "image_id")
    order = [F.col("image_id"), F.col("score").desc(), F.col("bbox")]
    r = running(j.withColumn("_all", F.lit(0)), ["_all"], order, rank_col="_r")
    x, y, w, h = (F.get("bbox", i) for i in range(4))
    return r.select((F.col("_r") - 1).alias("id"), "image_id", x.alias("x1"), y.alias("y1"), (x + w).alias("x2"), (y + h).alias("y2"), "score", "width", "height",
                    F.array_repeat(F.array(F.lit(0.0), F.lit(0.0)), n_joints).alias("keypoints"), F.array_repeat(F.lit(1.0), n_joints).alias("visible"))


# -- S13, S15, S16: sinks

def write_split_manifest(rows: DataFrame, path: str, file_path: str, label: str, split: str = "split") -> DataFrame:
    """``file_path, emotion, split`` as CSV with a header; returns the rows per split."""
    rows.select(F.col(file_path).alias("file_path"), F.col(label).alias("emotion"), F.col(split).alias("split")).write.option("header", True).csv(path)
    return read_split_manifest(rows.sparkSession, path).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def read_split_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file_path string, emotion string, split string").option("header", True).csv(path)


def dump_predictions(dets: DataFrame, path: str, top: int | None = None, image: str = "image_id", det_id: str = "det_id") -> None:
    """A row an image, its predictions by falling score (ties: smaller id), the ``top`` best if given."""
    if top is not None:
        dets = top_n_per_group(dets, [image], [F.col("score").desc(), F.col(det_id)], top).drop("rank")
    others = [c for c in dets.columns if c not in (image, "score", det_id)]
    lists = dets.groupBy(image).agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("_s"), det_id, "score", *others))).alias("predictions"))
    lists.select(image, F.transform("predictions", lambda p: F.struct(*[p[c].alias(c) for c in (det_id, "score", *others)])).alias("predictions")).write.parquet(path)


def write_bad_cases(rows: DataFrame, path: str, metric: str, threshold: float, kind: str = "loss") -> DataFrame:
    """Rows whose ``metric`` is at or over the threshold (kind "loss"), or at or under it ("accuracy"), as JSON; returns what was written."""
    if kind not in ("loss", "accuracy"):
        raise ValueError("kind must be loss or accuracy")
    bad = rows.where(F.col(metric) >= threshold if kind == "loss" else F.col(metric) <= threshold)
    bad.write.json(path)
    return rows.sparkSession.read.schema(rows.schema).json(path)
