"""Edge cases of pose, region and resampling operators."""

import pytest
from pyspark.sql import functions as F

from kestrel.operators import poses as P
from kestrel.operators import regions as R
from kestrel.operators import resampling as S


def test_decode_ties_and_empty_scores(spark):
    df = spark.createDataFrame([([0.5, 0.5], [0.1, 0.4]), ([-1.0, -2.0], [1.0, 2.0]), (None, [1.0])], "a array<double>, b array<double>")
    x, y, score = P.decode_axes("a", "b", 2.0)
    assert [tuple(r) for r in df.select(x, y, score).collect()] == [(0.0, 0.5, 0.4), (-0.5, -0.5, -1.0), (None, None, None)]
    with pytest.raises(ValueError):
        P.decode_axes("a", "b", combine="max")


def test_weak_part_is_null(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0], [0.2, 0.3])], "x array<double>, y array<double>, s array<double>")
    got = P.parts("x", "y", "s", {"one": (0, 1), "two": (0, 2)})
    row = df.select(got["one"].alias("one"), got["two"].alias("two"), P.part_score(got["one"]).alias("none"), P.part_score(got["two"]).alias("sum")).first()
    assert row.one is None and row.two[0] is None and row.two[1].x == 2.0 and (row.none, row.sum) == (0.0, 0.3)


def test_capture_key_of_other_names(spark):
    df = spark.createDataFrame([("a/b/S1_Directions 1.54138969_000001.jpg",), ("plain.jpg",)], "p string")
    assert [tuple(r) for r in df.select(*P.capture_key("p")).collect()] == [("S1", "Directions 1", "54138969"), ("", "", "")]


def test_box_top_is_closed_and_sides_open(spark):
    pts = spark.createDataFrame([(1, 1, 0.0, 0.0, 2.0), (1, 2, 1.0, 0.0, 1.0), (1, 3, 0.0, 0.0, 2.1), (2, 4, 0.0, 0.0, 1.0)], "c long, p long, x double, y double, z double")
    boxes = spark.createDataFrame([(1, 0, 0.0, 0.0, 0.0, 2.0, 2.0, 2.0, 0.0), (3, 0, 0.0, 0.0, 0.0, 2.0, 2.0, 2.0, 0.0)], ["c", "b", *R.BOX3D])
    assert {(r.p, r.b) for r in R.first_box(pts, boxes, "c", "p", "b").collect()} == {(1, 0), (2, -1), (3, -1), (4, -1)}
    pooled = {(r.c, r.p, r.empty) for r in R.pool_by_box(pts, boxes, "c", "p", "b", 2).collect()}
    assert pooled == {(1, 1, False), (3, None, True)}
    assert R.first_box(pts.limit(0), boxes, "c", "p", "b").count() == 0


def test_polygon_with_level_sides(spark):
    pts = spark.createDataFrame([(1, 1, 1.0, 1.0), (1, 2, 3.0, 1.0), (1, 3, 1.0, 5.0)], "c long, p long, x double, y double")
    square = spark.createDataFrame([(1, 9, 0.0, 0.0, 2.0, 0.0, 2.0, 2.0, 0.0, 2.0)], ["c", "q", "x1", "y1", "x2", "y2", "x3", "y3", "x4", "y4"])
    assert [r.p for r in R.points_in_polygons(pts, square, "c", "p", "q", cell=0.5).collect()] == [1]


def test_closure_ends_on_loops(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), (None, "x")], "child string, parent string")
    got = {(r.child, r.ancestor) for r in R.closure(edges).collect()}
    assert got == {(x, y) for x in "abc" for y in "abc"} | {("d", y) for y in "abcd"}


def test_class_aware_draws_are_balanced(spark):
    rows = spark.range(100).select(F.col("id"), F.when(F.col("id") < 90, "big").when(F.col("id") < 98, "mid").when(F.col("id") < 99, "one").alias("k"))
    got = S.class_aware(rows, "k", "id").collect()  # one row has no class
    assert sorted(r.position for r in got) == list(range(99))
    assert {k: sum(r.k == k for r in got) for k in ("big", "mid", "one")} == {"big": 33, "mid": 33, "one": 33}
    assert {r.id for r in got if r.k == "mid"} == set(range(90, 98))


def test_resampled_concat_keeps_sizes(spark):
    rows = spark.range(103).select("id", F.when(F.col("id") < 40, "a").when(F.col("id") < 100, "b").otherwise("c").alias("s"))
    got = S.resampled_concat(rows, "s", ["id"], {"a": 2.5, "b": 0.1}).collect()
    assert sorted((r.s, r.draw) for r in got) == [("a", i) for i in range(100)] + [("b", i) for i in range(6)]
