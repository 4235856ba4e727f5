"""Joins by blocks against plain loops: F1, F3-F11, F15-F20, F22 (pairs no longer become rows that are sorted on disk)."""

import random

import numpy as np
from pyspark.sql import functions as F

from kestrel.operators import blocks as B
from kestrel.operators import detection as D
from kestrel.operators import matchers as M
from kestrel.operators import pose_nms as PN
from kestrel.operators import rotated as R
from kestrel.operators import spatial as SP

DET = "image_id long, class_id string, det_id long, x1 double, y1 double, x2 double, y2 double, score double"
GT = "image_id long, class_id string, gt_id long, x1 double, y1 double, x2 double, y2 double, ignore_flag boolean"
POINT = "cloud_id long, pt_id long, x double, y double, z double, feat double"


def boxes(n, rng):
    out = []
    for k in range(n):
        x, y = rng.randrange(60), rng.randrange(60)
        out.append((k % 2, "a", k, float(x), float(y), float(x + rng.randrange(5, 40)), float(y + rng.randrange(5, 40))))
    return out


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_nearest_and_within():
    rng = np.random.default_rng(1)
    for spread in (1, 1000):
        p = np.concatenate([rng.integers(0, 9, (3, 80)), spread * rng.integers(0, 9, (3, 20))], axis=1).astype(float)
        d2 = ((p[:, :, None] - p[:, None]) ** 2).sum(0)
        i, j, d = B.nearest(p, p, 5)
        want = [sorted((v, k) for k, v in enumerate(row))[:5] for row in d2]
        assert [(v, int(b)) for v, b in zip(d, j)] == [w for k in dict.fromkeys(i.tolist()) for w in want[k]] and len(i) == 500
        i, j = B.within(p, p, 1.5, 3.0, 4)
        got = sorted(zip(i.tolist(), j.tolist()))
        assert got == [(a, b) for a in range(100) for b in [k for k, v in enumerate(d2[a]) if v == 0 or 2.25 <= v < 9][:4]]
    assert len(B.nearest(p, p[:, :0], 3)[0]) == len(B.nearest(p[:, :0], p, 3)[0]) == 0


def test_blocks_see_every_pair_once(spark):
    rng = random.Random(2)
    d = spark.createDataFrame([(*b, rng.random()) for b in boxes(40, rng)], DET)
    g = spark.createDataFrame([(*b, rng.random() < 0.3) for b in boxes(30, rng)], GT)
    whole, cut = ({(r.l_det_id, r.r_gt_id, r.overlap) for r in B.best_overlaps(d, g, ["image_id", "class_id"], "det_id", "gt_id", prefer=("gt_id",), block=n).collect()} for n in (1000, 4))
    best = {}
    for det, gt, v in cut:
        best[det] = max(best.get(det, (0, 0)), (v, -gt))
    assert {(k, -gt, v) for k, (v, gt) in best.items()} == whole and len(cut) > len(whole)


def test_no_pairs_are_spread_to_cells(spark):
    rng = random.Random(3)
    d = spark.createDataFrame([(*b, rng.random()) for b in boxes(12, rng)], DET)
    g = spark.createDataFrame([(*b, False) for b in boxes(9, rng)], GT)
    for df in (D.assign_tp_fp(d, g), M.assign_imagenet(d, g), M.match_crowd(d, g)):
        assert "_cx" not in plan(df) and df.count() == 12
    p = spark.createDataFrame([(k % 2, k, *[float(rng.randrange(9)) for _ in "xyz"], 1.0) for k in range(20)], POINT)
    q = p.withColumnRenamed("pt_id", "q_id")
    for df in (SP.knn(p, q, 3), SP.ball_query(p, q, 0.5, 2.0, 4), SP.three_interpolate(p, q, "feat")):
        assert "_cx" not in plan(df) and df.count() > 0


def test_a_dense_group_is_thinned_without_pairs(spark):
    """Thousands of boxes on one another: kept rows are few, pairs would be millions."""
    rng = random.Random(4)
    rows = [(1, k, rng.random(), [x + rng.random(), y + rng.random()] + [x + 9, y, x + 9, y + 9, x, y + 9]) for k in range(3000) for x, y in [(200.0 * (k % 3), 0.0)]]
    df = spark.createDataFrame(rows, "image_id long, det_id long, score double, quad array<double>")
    kept = R.nms_quads(df, ["image_id"], "det_id", 0.3)
    assert "_cx" not in plan(kept)
    assert {r.det_id for r in kept.collect()} == {max((r for r in rows if r[1] % 3 == m), key=lambda r: r[2])[1] for m in range(3)}
    poses = spark.createDataFrame([(1, r[1], r[2], 81.0, r[3][::2], r[3][1::2]) for r in rows], "image_id long, det_id long, score double, area double, xs array<double>, ys array<double>")
    want = {r.det_id for r in kept.collect()}
    assert {r.det_id for r in PN.oks_nms(poses, ["image_id"], "det_id", 0.3, [0.5] * 4).collect()} == want
    soft = PN.soft_oks_nms(poses, ["image_id"], "det_id", 0.1, [0.5] * 4, max_dets=3)
    assert {r.det_id for r in soft.collect()} == want
    near = PN.nearby_joints_nms(poses, ["image_id"], "det_id", 0.3, 2)
    assert "_cx" not in plan(soft) and "_cx" not in plan(near) and {r.det_id for r in near.collect()} == want


def test_points_that_meet_themselves_are_shuffled_once(spark):
    """a cloud's points and queries are the same rows, so one exchange serves both sides."""
    from kestrel.operators import spatial as SP
    rows = [(i % 3, i, float(i * 7 % 11), float(i * 5 % 13), float(i % 4)) for i in range(90)]
    p = spark.createDataFrame(rows, "cloud_id long, pt_id long, x double, y double, z double")
    got = SP.knn(p, p.withColumnRenamed("pt_id", "q_id"), 2)
    found = {(r.q_id, r["rank"]): r.pt_id for r in got.collect()}
    for c, q, *at in rows:
        near = sorted((sum((a - b) ** 2 for a, b in zip(at, o[2:], strict=True)), o[1]) for o in rows if o[0] == c)
        assert [found[q, 1], found[q, 2]] == [near[0][1], near[1][1]]
    assert "ReusedExchange" in got._jdf.queryExecution().executedPlan().toString()


def test_small_groups_are_thinned_together(spark):
    """what is compared at once is a round of all groups of a batch, not a chunk of one group."""
    rng = random.Random(5)
    rows = [(g, k % (25 if g % 2 else 23), float(rng.randrange(9)), float(x), float(y), float(x + rng.randrange(1, 9)), float(y + rng.randrange(1, 9)))
            for g in range(300) for k in range(25) for x, y in [(rng.randrange(20), rng.randrange(20))]]
    rows += [(300, k, float(k % 50), float(k % 70), 0.0, float(k % 70 + 1), 4.0) for k in range(1300)]
    df = spark.createDataFrame(rows, "g long, id long, score double, x1 double, y1 double, x2 double, y2 double")
    box = [F.col(c) for c in B.BOX]
    calls = spark.sparkContext.accumulator(0)

    def shared(a, b):
        return max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1]))

    def conflict(a, b):
        calls.add(1)
        return np.array([shared(p, q) > 3 for p, q in zip(a, b, strict=True)], bool)

    want, last = [], None
    for g, k, _, *b in sorted(rows, key=lambda r: (r[0], -r[2], r[1], *r[3:])):
        kept, last = (kept if g == last else []), g
        n = next((n for n, (_, o) in enumerate(kept) if shared(o, b) > 3), len(kept))
        if n == len(kept):
            kept.append((k, b))
        want.append((g, k, kept[n][0], n))
    got = B.keep_first(df, ["g"], "id", "score", box, box, conflict, alike=True, owners=True).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert calls.value < 300

    # rows of one id stay, whatever they have in common
    twice = spark.createDataFrame([(g, k // 2, 1.0, 0.0, 0.0, 9.0, 9.0) for g in range(5) for k in range(4)], df.schema)
    assert sorted(map(tuple, B.keep_first(twice, ["g"], "id", "score", box, box, conflict).collect())) == [(g, 0) for g in range(5) for _ in range(2)]
