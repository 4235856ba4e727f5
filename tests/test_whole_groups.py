"""Groups met whole in one task against the plans by rows: F2, F4-F10, F21, F27-F32."""

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from kestrel.functions import geometry as G
from kestrel.operators import blocks as B
from kestrel.operators import detection as D
from kestrel.operators import features as feat
from kestrel.operators import matchers as M
from kestrel.operators import nms as N
from kestrel.operators import selection as sel
from kestrel.operators import spatial as SP
from kestrel.operators.boxjoin import overlap_pairs

KEYS = ["image_id", "class_id"]
DET = "image_id long, class_id string, det_id long, x1 double, y1 double, x2 double, y2 double, score double"
GT = "image_id long, class_id string, gt_id long, x1 double, y1 double, x2 double, y2 double, ignore_flag boolean"


def box(rng):
    x, y = rng.randrange(20), rng.randrange(20)
    return float(x), float(y), float(x + rng.randrange(8, 30)), float(y + rng.randrange(8, 30))


def scene(spark, n=60, seed=1):
    """Boxes that lie close, some rows twice, some ids in two images, some values null."""
    rng = random.Random(seed)
    dets = [(k % 3, "a", k // 2, *box(rng), rng.randrange(10) / 10) for k in range(n)]
    gts = [(k % 3, "a", k // 2, *box(rng), rng.random() < 0.3) for k in range(n // 2)]
    dets += [(0, "a", 800, *box(rng)[:2], None, 40.0, 0.9), (1, "a", 801, *box(rng)[:3], None, 0.5), *dets[:6], (None, "a", 7, *dets[0][3:]), (0, "a", None, *dets[0][3:]), (1, "a", 900, None, *dets[0][4:]), (1, "a", 901, *dets[0][3:7], None)]
    gts += [(0, "a", 800, *box(rng)[:2], None, 40.0, False), (1, "a", 801, *box(rng)[:3], None, True), *gts[:3], (None, "a", 7, *gts[0][3:]), (0, "a", None, *gts[0][3:]), (1, "a", 900, *gts[0][3:7], None)]
    return spark.createDataFrame(dets, DET), spark.createDataFrame(gts, GT)


def rows(df):
    return Counter(tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tp_fp_of_whole_groups(spark, monkeypatch):
    d, g = scene(spark)
    whole = D.assign_tp_fp(d, g, 0.5)
    assert "Join" not in plan(whole)
    got = rows(whole)
    monkeypatch.setattr(D, "BLOCK", 2)
    assert "Join" in plan(D.assign_tp_fp(d, g, 0.5)) and rows(D.assign_tp_fp(d, g, 0.5)) == got
    assert {r[-2:] for r in got} >= {(1, 0), (0, 1), (0, 0)} and sum(got.values()) == d.count()


def test_free_boxes_come_with_their_rows(spark):
    d, g = scene(spark)
    got = M.assign_imagenet(d, g)
    assert "Join" not in plan(got)
    ids = Counter((r.image_id, r.det_id) for r in d.dropna(subset=["image_id", "det_id"]).collect())
    assert Counter((r.image_id, r.det_id) for r in got.collect()) == Counter({k: v * v for k, v in ids.items()})


def test_points_are_shuffled_once(spark):
    rng = random.Random(3)
    p = spark.createDataFrame([(k % 2, k, *[float(rng.randrange(9)) for _ in "xyz"], None if k % 7 == 0 else float(k)) for k in range(40)], "cloud_id long, pt_id long, x double, y double, z double, feat double")
    q = p.withColumnRenamed("pt_id", "q_id")
    near = SP.knn(p, q, 3)
    assert plan(near).count("strategy=broadcast") >= 2
    three = SP.three_interpolate(p, q, "feat")
    assert plan(three).count("Aggregate") == plan(near).count("Aggregate")
    f = {r.pt_id: r.feat for r in p.collect()}
    want: dict = {}
    for r in near.collect():
        w = 1 / (math.sqrt(r.d2) + 1e-8)
        a, b, n = want.get(r.q_id, (None, 0.0, 0))
        want[r.q_id] = (a if f[r.pt_id] is None else (a or 0.0) + w * f[r.pt_id], b + w, n + 1)
    for r in three.collect():
        a, b, n = want.pop(r.q_id)
        assert r.n_nn == n and (r.interp_feat is None if a is None else abs(r.interp_feat - a / b) < 1e-9)
    assert not want
    b = p.withColumn("x", F.col("x") + 0.5)
    both = SP.chamfer(p, b)
    one = {(r.q_id, r.pt_id, r.d2) for r in SP.knn(b, q, 1).collect()}
    assert {(r.pt, r.nn_pt, r.d2) for r in both.where("side = 'a->b'").collect()} == one and both.count() == 80


def test_totals_are_those_of_the_pairs(spark):
    d, g = scene(spark)
    p = overlap_pairs(d, g, KEYS, "det_id", "gt_id", out="iou")
    la, ra = (tuple(F.col(f"{s}_{c}") for c in N.BOX) for s in "lr")
    p = p.withColumn("iof", G.overlap(la, ra, "iof")).withColumn("giou", G.overlap(la, ra, "giou"))
    modes = ("iou", "iof", "giou")
    want = p.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_pairs"), *[f(m).alias(f"{n}_{m}") for m in modes for n, f in (("sum", F.sum), ("max", F.max))])
    assert rows(overlap_pairs(d, g, KEYS, "det_id", "gt_id", totals=modes)) == rows(want)
    over = p.where("iou >= 0.4").dropna(subset=[f"{s}_{c}" for s in "lr" for c in N.BOX]).select(*KEYS, "l_det_id", "r_gt_id", "iou")
    assert rows(B.likely_pairs(d, g, KEYS, "det_id", "gt_id", 0.4)) == rows(over)


def test_basis_is_first_basis():
    rng = np.random.default_rng(4)
    for size in (3, 8, 30):
        for share in (0.05, 0.2, 0.6):
            near = rng.random((size, size // 2 + 1)) < share
            first = M.first_basis({i: np.flatnonzero(row).tolist() for i, row in enumerate(near)}, list(range(size)))
            assert set(np.flatnonzero(M.basis(near)).tolist()) == first


def test_jaccard_of_whole_images(spark, monkeypatch):
    d, g = scene(spark, 40, 5)
    thrs = (0.0, 0.35, 0.8)
    got = rows(M.jaccard_index(d, g, thrs, 0.3))
    monkeypatch.setattr(M, "BLOCK", 0)
    assert rows(M.jaccard_index(d, g, thrs, 0.3)) == got and len(got) == 3


def test_removal_streams_groups(spark):
    d, _ = scene(spark)
    d = d.where("score IS NOT NULL AND det_id IS NOT NULL")
    kept = N.nms(d, ["image_id"], "det_id", 0.4)
    assert "collect_list" not in plan(kept) and rows(kept) == rows(d.join(N._fold_small(d, ["image_id"], "det_id", 0.4, 0.0), ["image_id", "det_id"], "left_semi").select(*kept.columns))
    groups = N.nms_match_groups(d, ["image_id"], "det_id", 0.4)
    assert "collect_list" not in plan(groups) and "_cx" not in plan(groups)
    apart = N._match_groups_apart(d, ["image_id"], "det_id", 0.4, 20_000, 64.0).select(*groups.columns)
    assert {(r.image_id, r.det_id, r.match_group) for r in groups.collect()} == {(r.image_id, r.det_id, r.match_group) for r in apart.collect()}


def test_ratio_moments_give_the_same_f(spark):
    rng = random.Random(6)
    data = [(k, k % 3, [rng.random() for _ in range(7)], [rng.random() for _ in range(7)]) for k in range(90)]
    data += [(90, 1, [None] + [0.5] * 6, [0.1 * k for k in range(7)]), (91, None, [float(k) for k in range(7)], [1.0] * 7), (92, 5, [None] * 7, [None] * 7), (93, 1, None, None)]
    df = spark.createDataFrame(data, "sample_id long, class_id long, xs array<double>, ys array<double>")
    by = ["i", "j", "k", "m"]
    want = {tuple(r[:4]): r.f_score for r in sel.anova_f(feat.all_ratios_long(df), by).collect()}
    got = {tuple(r[:4]): r.f_score for r in sel.anova_f(feat.all_ratios_long(df, moments="class_id"), by, moments=True).collect()}
    assert got.keys() == want.keys() and len(got) == 35 and all(abs(got[k] - want[k]) <= 1e-9 * max(1, abs(want[k])) for k in want)
