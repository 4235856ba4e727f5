"""Ids that repeat per group, sparse clouds, and rows that must not vanish."""

from kestrel.operators import annotations as A
from kestrel.operators import keypoints as K
from kestrel.operators import matching as M
from kestrel.operators import nms as N
from kestrel.operators import spatial as S

BOXES = [(0, 1, .9, 0., 0., 10., 10.), (0, 2, .8, 0., 0., 10., 10.), (1, 1, .9, 0., 0., 10., 10.), (1, 2, .8, 50., 50., 60., 60.)]


def test_nms_with_ids_per_image(spark):
    df = spark.createDataFrame(BOXES, "image_id long, det_id long, score double, x1 double, y1 double, x2 double, y2 double")
    for rows in (20_000, 0):
        kept = {(r.image_id, r.det_id) for r in N.nms(df, ["image_id"], "det_id", 0.5, max_group_rows=rows).collect()}
        assert kept == {(0, 1), (1, 1), (1, 2)}
    groups = sorted((r.image_id, r.det_id, r.match_group) for r in N.nms_match_groups(df, ["image_id"], "det_id", 0.5).collect())
    assert groups == [(0, 1, 1), (0, 2, 1), (1, 1, 1), (1, 2, 2)]


def test_assignment_keeps_groups_apart(spark):
    df = spark.createDataFrame([(1, 1, 1, .9), (2, 1, 2, .8)], "g long, a long, b long, w double")
    assert {(r.g, r.a, r.b) for r in M.greedy_assignment(df, "g", "a", "b", "w").collect()} == {(1, 1, 1), (2, 1, 2)}


def test_knn_of_sparse_and_empty_clouds(spark):
    points = spark.createDataFrame([(1, 1, 127., 127., 127.), (1, 2, 132., 0., 0.)], "cloud_id long, pt_id long, x double, y double, z double")
    queries = spark.createDataFrame([(1, 7, 0., 0., 0.), (9, 8, 0., 0., 0.)], "cloud_id long, q_id long, x double, y double, z double")
    got = [(r.q_id, r.rank, r.pt_id, r.d2) for r in S.knn(points, queries, 1).collect()]
    assert got == [(7, 1, 2, 17424.0)]


def test_oks_of_an_instance_without_visible_joints(spark):
    rows = [(1, p, float(p), float(p * p), float(p), float(p * p), False) for p in range(4)]
    df = spark.createDataFrame(rows, "sample_id long, pt int, gx double, gy double, px double, py double, visible boolean")
    assert [r.oks for r in K.oks(df, vis_thr=True).collect()] == [0.0]
    assert [round(r.oks, 6) for r in K.oks(df).collect()] == [1.0]


def test_images_whose_boxes_all_fail(spark):
    df = spark.createDataFrame([(5, 0., 0., .5, .5)], "image_id long, x1 double, y1 double, x2 double, y2 double")
    assert A.filter_annotations(df, keep_empty=True).count() == 0
    assert A.filter_annotations(df, keep_empty=False).count() == 1
