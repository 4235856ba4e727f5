"""Shared areas against plain clipping, removal against plain loops, Procrustes against the closed form on turned poses."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import alignment as AL
from kestrel.operators import panoptic as PA
from kestrel.operators import pose_nms as PN
from kestrel.operators import rotated as R


def rect(cx, cy, w, h, t):
    c, s = np.cos(t), np.sin(t)
    return [(cx + dx * w * c - dy * h * s, cy + dx * w * s + dy * h * c) for dx, dy in ((-.5, -.5), (.5, -.5), (.5, .5), (-.5, .5))]


def clipped_area(a, b):
    """One corner after the other against one edge after the other."""
    def area(p):
        return sum(x * v - y * u for (x, y), (u, v) in zip(p, p[1:] + p[:1], strict=True)) / 2

    a, b = ([*p] if area([*p]) > 0 else [*p][::-1] for p in (a, b))
    out = a
    for (ax, ay), (bx, by) in zip(b, b[1:] + b[:1], strict=True):
        side = lambda p: (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)  # noqa: E731, B023
        new = []
        for p, q in zip(out, out[1:] + out[:1], strict=True):
            s, t = side(p), side(q)
            if s >= 0:
                new.append(p)
            if (s > 0 > t) or (s < 0 < t):
                k = s / (s - t)
                new.append((p[0] + k * (q[0] - p[0]), p[1] + k * (q[1] - p[1])))
        out = new
        if not out:
            return 0.0
    return max(area(out), 0.0)


def test_shared_area():
    rng = random.Random(1)
    pairs = []
    for _ in range(2000):
        a = rect(rng.uniform(0, 10), rng.uniform(0, 10), rng.uniform(1, 8), rng.uniform(1, 8), rng.uniform(0, 7))
        b = rect(rng.uniform(0, 10), rng.uniform(0, 10), rng.uniform(1, 8), rng.uniform(1, 8), rng.uniform(0, 7))
        pairs.append((a, b))
    for _ in range(1000):  # shared edges, corners and centres, equal boxes, boxes in boxes
        t, w, h = rng.randrange(12) * np.pi / 12, rng.randrange(1, 5), rng.randrange(1, 5)
        u = (t + rng.choice([0, 0, np.pi / 2, np.pi, np.pi / 4]))
        off = rng.randrange(-3, 4) / 2, rng.randrange(-3, 4) / 2
        a = rect(0, 0, w, h, t)
        c, s = np.cos(t), np.sin(t)
        b = rect(off[0] * c - off[1] * s, off[0] * s + off[1] * c, rng.choice([w, h, 2]), rng.choice([w, h, 2]), u)
        pairs.append((a, b if rng.random() < 0.5 else b[::-1]))
    for _ in range(300):  # convex quadrilaterals: corners at rising angles on an ellipse
        quad = lambda: [(rng.uniform(3, 4) * 0 + 3 * np.cos(v) + ox, 2 * np.sin(v) + oy) for v in sorted(rng.uniform(0, 6.28) for _ in range(4))]  # noqa: E731, B023
        ox, oy = rng.uniform(-2, 2), rng.uniform(-2, 2)
        a = quad()
        ox, oy = rng.uniform(-2, 2), rng.uniform(-2, 2)
        pairs.append((a, quad()))
    a, b = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
    want = np.array([clipped_area(list(map(tuple, p)), list(map(tuple, q))) for p, q in zip(a, b, strict=True)])
    for got in (R.shared_area(a, b), R.shared_area(b, a), R.shared_area(a + 1000, b + 1000)):
        worst = np.abs(got - want).argmax()
        assert np.abs(got - want).max() < 1e-9, (pairs[worst], got[worst], want[worst])
    # the whole, nothing, a point
    one = np.array([rect(5, 5, 4, 2, 0.3)])
    assert R.shared_area(one, one)[0] == pytest.approx(8) and R.shared_area(one, one + 100)[0] == 0
    assert R.shared_area(one, np.array([[(5, 5)] * 4]))[0] == pytest.approx(0, abs=1e-12)


DET = "image_id long, det_id long, score double, quad array<double>"


def flat(q):
    return [float(v) for p in q for v in p]


def test_pairs_and_removal(spark):
    rng = random.Random(2)
    rows = [(i, k, rng.randrange(9) / 9, flat(rect(rng.uniform(0, 40), rng.uniform(0, 40), rng.uniform(4, 20), rng.uniform(4, 20), rng.uniform(0, 7)))) for i in range(3) for k in range(15)]
    rows += [(0, 90, 0.5, None), (0, 91, 0.5, [500.0, 500.0, -300.0, 500.0, -300.0, -300.0, 500.0, -300.0])]  # no corners; a very large one
    area = lambda q: clipped_area(q, q)
    pts = {(r[0], r[1]): list(zip(r[3][::2], r[3][1::2], strict=True)) for r in rows if r[3]}
    like = {}
    for (i, a), (j, b) in itertools.combinations(sorted(pts), 2):
        if i == j and (s := clipped_area(pts[i, a], pts[i, b])) > 0:
            like[i, a, b] = (s / (area(pts[i, a]) + area(pts[i, b]) - s), s / area(pts[i, a]))
    df = spark.createDataFrame(rows, DET)
    for mode in (0, 1):
        got = R.quad_pairs(df, df, ["image_id"], "det_id", "det_id", self_join=True, mode=("iou", "iof")[mode]).collect()
        assert {(r.image_id, r.l_det_id, r.r_det_id): pytest.approx(r.overlap, abs=1e-9) for r in got} == {k: v[mode] for k, v in like.items()}
    for thr in (0.1, 0.4):
        kept = set()
        for i, k, _, q in sorted(rows, key=lambda r: (-r[2], r[1])):
            if q and all((like.get((i, min(k, o), max(k, o))) or (0,))[0] <= thr for j, o in kept if j == i):
                kept.add((i, k))
        got = {(r.image_id, r.det_id) for r in R.nms_quads(df.where("quad IS NOT NULL"), ["image_id"], "det_id", thr).collect()}
        assert got == kept
    best = R.nms_quads(df.where("quad IS NOT NULL"), ["image_id"], "det_id", 0.4, pre_max=5, post_max=2).groupBy("image_id").count().collect()
    assert all(r["count"] <= 2 for r in best) and len(best) == 3
    assert R.nms_quads(df.limit(0), ["image_id"], "det_id", 0.4).count() == 0


def test_boxes_in_space(spark):
    schema = "g int, id long, x double, y double, z double, dx double, dy double, dz double, heading double, score double"
    rows = [(1, 1, 0., 0., 0., 4., 2., 2., 0., .9), (1, 2, 0., 0., 1., 2., 4., 2., 0., .8), (1, 3, 0., 0., 5., 4., 2., 2., np.pi / 2, .7), (1, 4, 1., 0., 0., 4., 2., 2., 0., .6)]
    df = spark.createDataFrame(rows, schema)
    got = {(r.l_id, r.r_id): r for r in R.pairs_3d(df, df, ["g"], "id", "id", self_join=True).collect()}
    assert got[1, 2].bev == pytest.approx(4) and got[1, 2].bev_iou == pytest.approx(4 / 12) and got[1, 2].iou_3d == pytest.approx(4 / (32 - 4))
    assert got[2, 3].bev_iou == pytest.approx(1) and got[2, 3].iou_3d == 0 and got[1, 4].iou_3d == pytest.approx(12 / 20)
    assert sorted(r.id for r in R.nms_3d(df, ["g"], "id", 0.5).collect()) == [1, 2]  # 3 lies on 2, 4 on 1
    assert sorted(r.id for r in R.nms_3d(df, ["g"], "id", 0.5, upright=True).collect()) == [1, 2]  # without its heading 3 lies on 1


POSE = "g int, id long, score double, area double, xs array<double>, ys array<double>"
SIGMAS = [0.1, 0.2, 0.15, 0.1]


def poses(seed):
    rng = random.Random(seed)
    bases = [[(rng.uniform(0, 30), rng.uniform(0, 30)) for _ in SIGMAS] for _ in range(4)]
    rows = []
    for g in range(3):
        for k in range(14):
            b = rng.choice(bases)
            p = [(x + rng.gauss(0, 1.5), y + rng.gauss(0, 1.5)) for x, y in b]
            rows.append((g, k, rng.randrange(12) / 12, rng.uniform(50, 200), [x for x, _ in p], [y for _, y in p]))
    return rows


def oks(a, b):
    e = [np.exp(-((x - u) ** 2 + (y - v) ** 2) / (2 * s) ** 2 / ((a[3] + b[3]) / 2 + np.spacing(1)) / 2) for x, y, u, v, s in zip(a[4], a[5], b[4], b[5], SIGMAS, strict=True)]
    return sum(e) / len(e)


def test_pose_removal(spark):
    rows = poses(4)
    df = spark.createDataFrame(rows, POSE)
    order = sorted(rows, key=lambda r: (-r[2], r[1]))
    for thr in (0.3, 0.8):
        kept = []
        for r in order:
            if all(k[0] != r[0] or oks(k, r) <= thr for k in kept):
                kept.append(r)
        assert {(r.g, r.id) for r in PN.oks_nms(df, ["g"], "id", thr, SIGMAS).collect()} == {k[:2] for k in kept}
    for method in ("gaussian", "linear"):
        want = []
        for g in range(3):
            left = {r[1]: [r[2], r] for r in rows if r[0] == g}
            for pick in range(1, 6):
                i = max(left, key=lambda i: (left[i][0], -i))
                s, top = left.pop(i)
                want.append((g, i, pick, pytest.approx(s)))
                for v in left.values():
                    o = oks(top, v[1])
                    v[0] *= np.exp(-o * o / 0.4) if method == "gaussian" else (1 - o if o >= 0.4 else 1)
        got = sorted((r.g, r.pick, r.id, r.score) for r in PN.soft_oks_nms(df, ["g"], "id", 0.4, SIGMAS, max_dets=5, method=method).collect())
        assert [(g, i, p, s) for g, p, i, s in got] == want


def test_near_poses(spark):
    rows = poses(5)
    df = spark.createDataFrame(rows, POSE)

    def near(a, b):
        r = 0.1 * np.hypot(max(a[4]) - min(a[4]), max(a[5]) - min(a[5]))
        return sum(np.hypot(x - u, y - v) < r for x, y, u, v in zip(a[4], a[5], b[4], b[5], strict=True)) > 2

    want = []
    for g in range(3):
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
        gone = set()
        for r in mine:
            if r[1] not in gone:
                some = [o for o in mine if near(r, o)]
                if some and some[0][1] not in gone:
                    want.append((g, some[0][1]))
                    gone |= {o[1] for o in some}
    got = PN.nearby_joints_nms(df, ["g"], "id", 0.1).collect()
    assert sorted((r.g, r.id) for r in got) == sorted(want) and len(want) > 6
    assert PN.nearby_joints_nms(df, ["g"], "id", 0.1, max_dets=1).count() == 3
    assert PN.mean_score(F.array(F.lit(1.0), F.lit(2.0))) is not None


def test_procrustes(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        g = rng.standard_normal((7, 3))
        q = np.linalg.qr(rng.standard_normal((3, 3)))[0]
        q *= np.sign(np.linalg.det(q))  # turned, never mirrored
        p = (g @ q) * 0.3 + 5
        if i % 4 == 1:
            p = g * [-1, 1, 1] + 0.1 * rng.standard_normal((7, 3))  # mirrored: a best turn that is no mirror
        if i % 4 == 2:
            p[:, 2] = 0  # flat
        if i % 4 == 3:
            p[:] = 4.0  # a point
        rows += [(i, k, *map(float, g[k]), *map(float, p[k]), bool(k % 3), i % 2) for k in range(7)]
    kp = spark.createDataFrame(rows, "sample_id long, pt int, gx double, gy double, gz double, px double, py double, pz double, visible boolean, act int")
    got = {}
    for r in AL.procrustes_errors(kp).collect():
        got.setdefault(r.sample_id, {})[r.pt] = r.error
    for i in range(40):
        mine = np.array([r[2:8] for r in rows if r[0] == i])
        g, p = mine[:, :3], mine[:, 3:]
        a, b = p - p.mean(0), g - g.mean(0)
        u, s, vt = np.linalg.svd(a.T @ b)
        z = np.diag([1, 1, np.sign(np.linalg.det(u) * np.linalg.det(vt))])
        size = (a * a).sum()
        hat = (np.trace(np.diag(s) @ z) / size if size else 0) * a @ (u @ z @ vt) + g.mean(0)
        want = np.linalg.norm(hat - g, axis=1)
        assert set(got[i]) == {1, 2, 4, 5}
        assert all(abs(got[i][k] - want[k]) < 1e-9 for k in got[i])
        if i % 4 == 0:
            assert want.max() < 1e-9
    per = {r.act: r.mpjpe for r in AL.procrustes_mpjpe(kp, by=("act",)).collect()}
    assert per[0] == pytest.approx(np.mean([e for i, v in got.items() if i % 2 == 0 for e in v.values()]))
    # two dimensions, a null coordinate and an empty table
    flat_kp = kp.drop("gz", "pz").withColumn("px", F.when((F.col("sample_id") == 0) & (F.col("pt") == 0), None).otherwise(F.col("px")))
    assert 0 not in {r.sample_id for r in AL.procrustes_errors(flat_kp).collect()}
    assert AL.procrustes_errors(kp.limit(0)).count() == 0


def test_panoptic_by_hand(spark):
    cells = [(0, 1, 1, 60), (0, 1, 2, 10), (0, 2, 2, 30), (0, 0, 2, 20), (0, 3, 3, 5), (0, 0, 3, 6), (0, 4, 4, 9), (0, 5, 4, 1), (1, 1, 1, 10), (1, 0, 2, 7)]
    gts = [(0, 1, 7, False), (0, 2, 8, False), (0, 3, 7, False), (0, 4, 9, True), (0, 5, 9, False), (1, 1, 7, False)]
    preds = [(0, 1, 7), (0, 2, 8), (0, 3, 7), (0, 4, 9), (1, 1, 8), (1, 2, 7), (1, 9, 7)]
    c = spark.createDataFrame(cells, "image_id long, gt_seg int, pred_seg int, pixels long")
    g = spark.createDataFrame(gts, "image_id long, seg int, category int, crowd boolean")
    p = spark.createDataFrame(preds, "image_id long, seg int, category int")
    got = {r.category: (pytest.approx(r.iou), r.tp, r.fp, r.fn) for r in PA.panoptic_counts(c, g, p).collect()}
    # 7: 60/70; image 0's third pair is 5/(11+5-5-6), image 1's is of another category; 8: 30/(60+30-30-20); 9: nine tenths of the mask lie in the crowd
    assert got == {7: (60 / 70 + 1.0, 2, 0, 1), 8: (0.75, 1, 1, 0), 9: (0.0, 0, 0, 1)}
    q = PA.panoptic_quality(PA.panoptic_counts(c, g, p))
    parts = {r.part: (r.n, pytest.approx(r.pq)) for r in PA.panoptic_summary(q, [7]).collect()}
    seven, eight = (60 / 70 + 1) / 2.5, 0.75 / 1.5
    assert parts == {"All": (3, (seven + eight) / 3), "Things": (1, seven), "Stuff": (2, eight / 2)}


def test_large_ids_keep_their_bits(spark):
    from kestrel.operators import matchers as M

    big = 1 << 60
    box = [0.0, 0.0, 10.0, 10.0]
    dets = spark.createDataFrame([(1, "a", big + k, *box, 1.0 - k / 10) for k in range(3)],
                                 "image_id long, class_id string, det_id long, x1 double, y1 double, x2 double, y2 double, score double")
    gts = spark.createDataFrame([(1, "a", big + 7, *box, False)], "image_id long, class_id string, gt_id long, x1 double, y1 double, x2 double, y2 double, ignore_flag boolean")
    got = {r.det_id: r.gt_match for r in M.match_crowd(dets, gts, keys=("image_id",)).collect()}
    assert got == {big: big + 7, big + 1: None, big + 2: None}
    pose = [(1, big + 1, 0.9, 4.0, [0.0, 2.0], [0.0, 2.0]), (1, big + 2, 0.8, 4.0, [0.0, 2.0], [0.0, 2.0]), (1, big + 3, 0.7, 4.0, [5.0, 5.0], [5.0, 5.0])]
    assert [r.id for r in PN.nearby_joints_nms(spark.createDataFrame(pose, POSE), ["g"], "id", 0.1, 1).collect()] == [big + 1]  # a point is near nothing
