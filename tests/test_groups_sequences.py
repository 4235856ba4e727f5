"""Groups about centres, sequences of tracks and nearest neighbours at any density, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from kestrel.operators import resampling as RS
from kestrel.operators import sequence as Q
from kestrel.operators import spatial as S

P = "cloud_id long, pt_id long, x double, y double, z double, f double"
C = "cloud_id long, q_id long, x double, y double, z double"


def clouds(seed):
    """Three clouds: even, two clusters far apart, and three points."""
    rng = random.Random(seed)
    pts = [(1, i, rng.uniform(0, 20), rng.uniform(0, 20), rng.uniform(0, 20), float(i)) for i in range(80)]
    pts += [(2, i, *(rng.gauss(0, 0.01) + (5000 if i % 2 else -300) for _ in "xyz"), float(i)) for i in range(60)]
    pts += [(3, i, i * 1000.0, 0.0, 0.0, float(i)) for i in range(3)]
    qs = [(c, i, *(rng.uniform(-5, 25) for _ in "xyz")) for c in (1, 2, 3) for i in range(12)] + [(9, 1, 0.0, 0.0, 0.0)]
    return pts, qs


def near(pts, q):
    return sorted((sum((a - b) ** 2 for a, b in zip(p[2:5], q[2:], strict=True)), p[1]) for p in pts if p[0] == q[0])


def test_nearest_at_any_density(spark):
    pts, qs = clouds(1)
    got = {}
    for r in S.knn(spark.createDataFrame(pts, P), spark.createDataFrame(qs, C), 5).collect():
        got.setdefault((r.cloud_id, r.q_id), []).append((r["rank"], r.pt_id, pytest.approx(r.d2)))
    for q in qs:
        want = [(k, i, d) for k, (d, i) in enumerate(near(pts, q)[:5], 1)]
        assert sorted(got.get(q[:2], []), key=lambda r: r[0]) == want


@pytest.mark.parametrize("radius,uniform,normalize", [(None, False, False), (6.0, False, True), (6.0, True, False)])
def test_groups(spark, radius, uniform, normalize):
    pts, qs = clouds(2)
    n, at = 7, {p[:2]: p for p in pts}
    rows = S.query_and_group(spark.createDataFrame(pts, P), spark.createDataFrame(qs, C), n, radius, 1.0 if radius else 0.0, ("f",), normalize, uniform).collect()
    groups = {}
    for r in rows:
        groups.setdefault((r.cloud_id, r.q_id), {})[r.slot] = r
    for q in qs:
        hits = [i for _, i in near(pts, q)[:n]] if radius is None else sorted(i for d, i in near(pts, q) if d == 0 or 1 <= d < radius ** 2)[:n]
        mine = groups.get(q[:2], {})
        if not hits:
            assert not mine
            continue
        ids = [mine[k].pt_id for k in sorted(mine)]
        assert {r.unique_cnt for r in mine.values()} == {len(hits)} and ids[:len(hits)] == hits
        if radius is not None:
            assert len(ids) == n and (set(ids) <= set(hits) if uniform else ids[len(hits):] == [hits[0]] * (n - len(hits)))
        for r in mine.values():
            p = at[q[0], r.pt_id]
            assert (r.dx, r.dy, r.dz) == pytest.approx(tuple((a - b) / (radius if normalize else 1) for a, b in zip(p[2:5], q[2:], strict=True))) and r.f == p[5]


def test_refilled_slots_repeat(spark):
    pts, qs = clouds(3)
    p, q = spark.createDataFrame(pts, P), spark.createDataFrame(qs, C)
    runs = [sorted((r.cloud_id, r.q_id, r.slot, r.pt_id) for r in S.query_and_group(p.repartition(k), q, 9, 5.0, uniform=True).collect()) for k in (1, 4)]
    assert runs[0] == runs[1]
    with pytest.raises(ValueError):
        S.query_and_group(p, q, 3, normalize=True)


def test_group_all(spark):
    pts, _ = clouds(4)
    got = S.group_all(spark.createDataFrame(pts, P), ("f",)).collect()
    assert sorted((r.cloud_id, r.slot, r.pt_id, r.f) for r in got) == sorted((c, k, p[1], p[5]) for c in (1, 2, 3) for k, p in enumerate(sorted(p for p in pts if p[0] == c)))


@pytest.mark.parametrize("target", [-1, 0, 6, -4, 100])
def test_track_sequences(spark, target):
    rng = random.Random(target)
    rows = [(v, f * 3, rng.choice([0, 0, 1, 2, -1, None])) for v in range(3) for f in range(10) for _ in range(3)]
    want = set()
    for v in range(3):
        frames = sorted({r[1] for r in rows if r[0] == v})
        at = target % len(frames)
        has = lambda t, p: (v, frames[p], t) in set(rows)  # noqa: E731, B023
        for t in {r[2] for r in rows if r[:2] == (v, frames[at]) and r[2] is not None and r[2] >= 0}:
            lo = hi = at
            while lo > 0 and has(t, lo - 1):
                lo -= 1
            while hi + 1 < len(frames) and has(t, hi + 1):
                hi += 1
            want |= {(v, t, p, frames[min(max(p, lo), hi)]) for p in range(len(frames))}
    got = Q.track_sequences(spark.createDataFrame(rows, "video_id long, frame_idx long, track_id int"), target).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_batches_draw_every_row(spark):
    rows = spark.createDataFrame([("a", i) for i in range(50)] + [("b", i) for i in range(9)] + [("c", 1)], "kind string, id long")
    got = RS.ratio_batches(rows, "kind", "id", {"a": 3, "b": 1}, 8).collect()
    assert {(r.kind, r.id) for r in got} == {("a", i) for i in range(50)} | {("b", i) for i in range(9)}
    assert len(got) == 8 * 9 and {r.batch for r in got} == set(range(9))  # 50 rows, six a batch
    assert RS.ratio_batches(rows, "kind", "id", {"a": 3, "b": 1}, 8, 2).agg(F.max("batch")).first()[0] == 1
