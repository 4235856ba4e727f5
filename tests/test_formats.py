"""Formats with records that don't parse, nulls, unknown names and nothing at all."""

import uuid

import pytest
from pyspark.sql import functions as F

from kestrel.session import checkpoint_dir
from kestrel.sources import formats as FM


@pytest.fixture
def folder(spark):
    return f"{checkpoint_dir(spark)}/formats-{uuid.uuid4().hex}"


def text(spark, lines, path):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_samples(spark, folder):
    rows = [("happy", [[1.0, 2.0]], "a"), ("sad", [[3.0, 4.0]], None), ("happy", [], "c"), ("happy", None, "d"), ("angry", [[5.0, 6.0]], "e")]
    FM.write_samples(spark.createDataFrame(rows, "emotion string, head_keypoints array<array<double>>, input_file string"), folder)
    got = FM.read_samples(spark, folder, labels=["happy", "sad", "nowhere"])
    assert sorted((r.emotion, r.head_keypoints) for r in got.collect()) == [("happy", [[1.0, 2.0]]), ("sad", [[3.0, 4.0]])]
    paths = {r.emotion: r.file_path for r in got.collect()}
    assert paths["happy"] == "a" and paths["sad"].endswith(".json") and "emotion=sad" in paths["sad"]
    assert "PartitionFilters: [isnotnull(emotion" in got._jdf.queryExecution().executedPlan().toString().replace("PartitionFilters: [emotion", "PartitionFilters: [isnotnull(emotion")
    assert FM.read_samples(spark, folder).count() == 3


def test_crowd(spark, folder):
    text(spark, ['{"ID": "a", "gtboxes": [{"tag": "person", "fbox": [1, 2, 3, 4], "hbox": [0, 0, 1, 1], "vbox": [1, 1, 1, 1], "extra": {"ignore": 0}},'
                 ' {"tag": "mask", "fbox": [1, 2, 3, 4], "hbox": [0, 0, 1, 1], "vbox": [1, 1, 1, 1]},'
                 ' {"tag": "person", "fbox": [5, 5, 1, 1], "hbox": [0, 0, 1, 1], "vbox": [1, 1, 1, 1], "extra": {"ignore": 1}}]}',
                 '{"ID": "b", "gtboxes": []}', "{not a record", '{"ID": "c"}'], folder)
    got = sorted((r.img_id, r.pos, r.label, r.ignore_flag, r.bbox) for r in FM.read_crowd(spark, folder).collect())
    assert got == [("a", 0, 0, 0, [1.0, 2.0, 4.0, 6.0]), ("a", 1, -1, 1, [1.0, 2.0, 4.0, 6.0]), ("a", 2, -1, 1, [5.0, 5.0, 6.0, 6.0])]


def test_open_images(spark, folder):
    text(spark, ["ImageID,Source,LabelName,Confidence,XMin,XMax,YMin,YMax,IsOccluded,IsTruncated,IsGroupOf,IsDepiction,IsInside", "i1,x,/m/a,1,0.1,0.5,0.2,0.4,1,0,-1,0,0",
                 "i1,x,/m/zz,1,0,1,0,1,0,0,0,0,0", "i9,x,/m/a,1,0,1,0,1,0,0,0,0,0"], folder)
    images = spark.createDataFrame([("i1", 100, 50)], "image_id string, width int, height int")
    classes = spark.createDataFrame([("/m/a", 4)], "label_name string, label int")
    (r,) = FM.read_open_boxes(spark, folder, images, classes).collect()
    assert (r.image_id, r.label, r.is_occluded, r.is_group_of) == ("i1", 4, True, False) and (r.x1, r.y1, r.x2, r.y2) == pytest.approx((10, 10, 50, 20))
    text(spark, ["ImageID,Source,LabelName,Confidence", "i1,v,/m/a,0.5", "i1,v,/m/b,1"], folder + "-l")
    assert [tuple(r) for r in FM.read_open_labels(spark, folder + "-l", classes).collect()] == [("i1", 4, 0.5)]


def test_voc(spark, folder):
    text(spark, ["<annotation><filename>x.y.jpg</filename><size><width>9</width><height>9</height><depth>3</depth></size>"
                 "<object><name>cat</name><difficult>0</difficult><bndbox><xmin>3</xmin><ymin>4</ymin><xmax>23</xmax><ymax>34</ymax></bndbox></object>"
                 "<object><name>dog</name><difficult>1</difficult><bndbox><xmin>1</xmin><ymin>1</ymin><xmax>31</xmax><ymax>31</ymax></bndbox></object>"
                 "<object><name>cow</name><bndbox><xmin>1</xmin><ymin>1</ymin><xmax>2</xmax><ymax>2</ymax></bndbox></object>"
                 "<object><name>cat</name><bndbox><xmin>1</xmin><ymin>1</ymin><xmax>4</xmax><ymax>41</ymax></bndbox></object></annotation>",
                 "<annotation><filename>none.jpg</filename></annotation>"], folder)
    got = sorted((r.img_id, r.pos, r.label, r.ignore_flag, r.x1, r.y2) for r in FM.read_voc(spark, folder, ["cat", "dog"], 10).collect())
    assert got == [("x.y", 0, 0, 0, 2.0, 33.0), ("x.y", 1, 1, 1, 0.0, 30.0), ("x.y", 3, 0, 1, 0.0, 40.0)]


def test_keypoints(spark, folder):
    text(spark, ['{"id": 1, "image_id": 4, "category_id": 1, "bbox": [-5, 2, 20, 30], "keypoints": [1, 2, 2, 0, 0, 0, -1, -2, 1]}',
                 '{"id": 2, "image_id": 4, "category_id": 1, "bbox": [1, 1, 0, 0], "keypoints": [], "num_keypoints": 9, "area": 5, "iscrowd": 1}',
                 '{"id": 3, "image_id": 4, "keypoints": [1, 1, 1]}', '{"id": 4, "image_id": 5, "bbox": [0, 0, 1, 1], "keypoints": [1, 1, 1]}', "{"], folder)
    images = spark.createDataFrame([(4, 10, 20), (5, 10, 20), (6, 1, 1)], "image_id long, width int, height int")
    got = {r.id: r for r in FM.read_keypoints(spark, folder, images, 2).collect()}
    assert set(got) == {1, 2}
    a, b = got[1], got[2]
    assert (a.x1, a.y1, a.x2, a.y2, a.keypoints, a.visible, a.num_keypoints, a.iscrowd) == (0.0, 2.0, 9.0, 19.0, [[1.0, 2.0], [0.0, 0.0], [-1.0, -2.0]], [1.0, 0.0, 1.0], 2, 0)
    assert a.area == pytest.approx(9 * 17 * 0.53) and (b.area, b.num_keypoints, b.iscrowd, b.keypoints) == (5.0, 9, 1, [])


def test_detections(spark, folder):
    text(spark, ['{"image_id": 2, "category_id": 1, "bbox": [1, 2, 3, 4], "score": 0.5}', '{"image_id": 2, "category_id": 1, "bbox": [0, 0, 3, 4], "score": 0.9}',
                 '{"image_id": 1, "category_id": 2, "bbox": [1, 2, 3, 4], "score": 0.5}', '{"image_id": 7, "category_id": 1, "bbox": [1, 2, 3, 4], "score": 0.5}', "?"], folder)
    images = spark.createDataFrame([(1, 10, 10), (2, 20, 10)], "image_id long, width int, height int")
    got = FM.read_detections(spark, folder, images, 2).orderBy("id").collect()
    assert [(r.id, r.image_id, r.score, r.x2, r.width, r.keypoints, r.visible) for r in got] == [
        (0, 2, 0.9, 3.0, 20, [[0.0, 0.0]] * 2, [1.0, 1.0]), (1, 2, 0.5, 4.0, 20, [[0.0, 0.0]] * 2, [1.0, 1.0])]


def test_sinks(spark, folder):
    rows = spark.createDataFrame([("a,b.json", "sad", "train"), ("c", "sad", "test"), ("d", None, "test")], "p string, e string, split string")
    assert {r.split: r.n for r in FM.write_split_manifest(rows, folder, "p", "e").collect()} == {"train": 1, "test": 2}
    assert ("a,b.json", "sad", "train") in {tuple(r) for r in FM.read_split_manifest(spark, folder).collect()}
    dets = spark.createDataFrame([(1, 5, 0.5, "x"), (1, 4, 0.5, "y"), (1, 6, 0.9, "z"), (2, 1, 0.1, "w")], "image_id int, det_id int, score double, k string")
    FM.dump_predictions(dets, folder + "-d", 2)
    got = {r.image_id: [tuple(p) for p in r.predictions] for r in spark.read.parquet(folder + "-d").collect()}
    assert got == {1: [(6, 0.9, "z"), (4, 0.5, "y")], 2: [(1, 0.1, "w")]}
    FM.dump_predictions(dets.drop("k"), folder + "-e")
    assert spark.read.parquet(folder + "-e").agg(F.max(F.size("predictions"))).first()[0] == 3
    assert FM.write_bad_cases(dets, folder + "-b", "score", 0.5).count() == 3 and FM.write_bad_cases(dets, folder + "-c", "score", 0.1, "accuracy").count() == 1
    with pytest.raises(ValueError):
        FM.write_bad_cases(dets, folder + "-x", "score", 1, "other")
