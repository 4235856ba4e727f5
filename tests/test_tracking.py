"""Tracking against a plain loop, cuts at every size, streams in any file order."""

import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import tracking as TR
from kestrel.session import checkpoint_dir
from kestrel.streaming import debounce as DB
from kestrel.streaming import tracks as ST
from kestrel.streaming.ordered import dropped_rows, ordered_fold, run_files

SCHEMA = "video_id long, frame_idx long, det_id long, numbers array<double>, eligible boolean"


def tracks_by_hand(rows, threshold=0.3, restart=True):
    """Box by box over lists, as the tracker works."""
    def iou(a, b):
        w, h = max(0, min(a[2], b[2]) - max(a[0], b[0])), max(0, min(a[3], b[3]) - max(a[1], b[1]))
        u = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
        return w * h / (u or 1e-5)

    out = {}
    for v in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == v]
        boxes, ids, next_id = [], [], 0
        for f in range(min(r[1] for r in mine), max(r[1] for r in mine) + 1):
            if not ids and restart:
                next_id = 0
            now, tracks = [], []
            for r in sorted((r for r in mine if r[1] == f), key=lambda r: r[2]):
                scores = [iou(r[3], b) for b in boxes]
                best = scores.index(max(scores)) if scores else -1
                if scores and scores[best] > threshold:
                    t = ids.pop(best)
                    boxes.pop(best)
                elif r[4]:
                    t, next_id = next_id, next_id + 1
                else:
                    t = -1
                out[r[:3]] = t
                if t >= 0:
                    now.append(r[3])
                    tracks.append(t)
            boxes, ids = now, tracks
    return out


def scenes(rng, videos=4, frames=40):
    rows = []
    for v in range(videos):
        things = [[rng.uniform(0, 60), rng.uniform(0, 60), rng.uniform(8, 30), rng.random() < 0.8] for _ in range(5)]
        for f in range(frames):
            if rng.random() < 0.08:
                continue  # a frame without detections
            for k, t in enumerate(things):
                t[0] += rng.gauss(0, 3)
                t[1] += rng.gauss(0, 3)
                if rng.random() < 0.85:
                    rows.append((v, f, rng.randrange(1000) * 10 + k, [t[0], t[1], t[0] + t[2], t[1] + t[2]], t[3] and rng.random() < 0.97))
                if rng.random() < 0.05:
                    t[0], t[1] = rng.uniform(0, 60), rng.uniform(0, 60)
    return rows


@pytest.mark.parametrize("restart,chunk", [(True, 1), (True, 5), (False, 3), (True, 1000)])
def test_tracks_against_plain_loop(spark, restart, chunk):
    rng = random.Random(chunk)
    rows = scenes(rng)
    want = tracks_by_hand(rows, restart=restart)
    assert len(set(want.values())) > 6 and -1 in want.values()
    rng.shuffle(rows)
    got = TR.track(spark.createDataFrame(rows, SCHEMA).repartition(7), "numbers", "eligible", restart=restart, chunk=chunk).collect()
    assert {(r.video_id, r.frame_idx, r.det_id): r.track_id for r in got} == want and len(got) == len(want)


def test_odd_rows(spark):
    assert TR.track(spark.createDataFrame([], SCHEMA), "numbers", "eligible").count() == 0
    box = [0.0, 0.0, 10.0, 10.0]
    rows = [(1, 0, 1, box, True), (1, 0, 1, box, True), (1, 1, 1, box, None), (1, 2, 1, [50.0, 50.0, 60.0, 60.0], None), (1, 3, 1, box, True),
            (None, 0, 1, box, True), (1, None, 1, box, True), (1, 9, 5, None, True), (2, -3, 1, [3.0, 3.0, 3.0, 3.0], True), (2, -2, 1, [3.0, 3.0, 3.0, 3.0], True)]
    got = sorted(tuple(r) for r in TR.track(spark.createDataFrame(rows, SCHEMA), "numbers", "eligible").collect())
    # the repeated row is one; a null eligibility may be matched but begins nothing; boxes without area match nothing
    assert got == [(1, 0, 1, 0), (1, 1, 1, 0), (1, 2, 1, -1), (1, 3, 1, 0), (2, -3, 1, 0), (2, -2, 1, 1)]


def test_pose_similarity_by_hand():
    one, last = np.array([100.0, 1, 2, 3, 4]), np.array([[80.0, 1, 3, 5, 4]])
    want = sum(np.exp(-d2 / (2 * s) ** 2 / (90 + np.spacing(1)) / 2) for d2, s in ((1, 0.1), (4, 0.2))) / 2
    assert abs(TR.pose_similarity([0.1, 0.2])(one, last)[0] - want) < 1e-15


def test_pose_boxes_and_rules(spark):
    r = spark.range(1).select(F.array(F.lit(0.0), F.lit(8.0)).alias("x"), F.array(F.lit(0.0), F.lit(4.0)).alias("y")).select(
        TR.expanded_pose_box("x", "y").alias("b"), TR.enough_joints(F.array(F.lit(0.0), F.lit(1.0), F.lit(2.0))).alias("two"),
        TR.large_enough(F.array(*[F.lit(v) for v in (0.0, 0.0, 50.0, 20.0)])).alias("edge")).first()
    assert r.b == [-1.0, -0.5, 9.0, 4.5] and not r.two and r.edge


def write_files(spark, rows, schema, files):
    folder = f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}"
    for k in range(files):
        spark.createDataFrame(rows[k::files], schema).coalesce(1).write.mode("append").parquet(folder)
    return folder


def test_stream_equals_batch_over_shuffled_files(spark):
    rng = random.Random(8)
    rows = scenes(rng, videos=2, frames=25)
    want = tracks_by_hand(rows)
    rng.shuffle(rows)
    schema = SCHEMA + ", ts_ms long"
    folder = write_files(spark, [(*r, (r[1] + 1) * 40) for r in rows], schema, 8)
    got = run_files(spark, folder, schema, lambda s: ST.track_stream(s, delay="1 hour"), "ts_ms", ST.TRACK_SCHEMA, delay_ms=3_600_000).collect()
    assert {(r.video_id, r.frame_idx, r.det_id): r.track_id for r in got} == want and len(got) == len(want)


def test_debounce_over_shuffled_files(spark):
    rng = random.Random(9)
    rows = [(d, d * 1000 + i, 1000 + i * 200 + rng.randrange(100), None if rng.random() < 0.03 else float(rng.choice([5, 10, 20, 90]) if rng.random() < 0.7 else 5))
            for d in range(4) for i in range(60)]
    want = sorted(tuple(r) for r in DB.debounce_batch(spark.createDataFrame(rows, "device long, seq long, ts_ms long, value double"), 30, 500).collect())
    assert len(want) > 5
    rng.shuffle(rows)
    schema = "device long, seq long, ts_ms long, value double"
    folder = write_files(spark, rows, schema, 8)
    got = run_files(spark, folder, schema, lambda s: DB.debounce_stream(s, 30, 500, "1 hour"), "ts_ms", DB.TRIGGER_SCHEMA, delay_ms=3_600_000)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_late_rows_are_counted_and_rows_wait_for_the_watermark(spark):
    """Two files: the first brings the watermark to 90 s; the second holds one row behind it and one ahead."""
    schema = "k long, ts_ms long, v long"
    folder, base = write_files(spark, [(1, 100_000, 1), (1, 99_000, 2)], schema, 1), f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}"

    def order(key, rows, state):
        seen = (state or 0)
        return [(r[0], r[1], seen + i) for i, r in enumerate(rows)], seen + len(rows)

    def go():
        s = spark.readStream.schema(schema).parquet(folder)
        q = (ordered_fold(s, ["k"], "ts_ms", ["v"], order, "k long, ts_ms long, place long", "10 seconds").writeStream.format("parquet")
             .option("path", f"{base}/out").option("checkpointLocation", f"{base}/chk").trigger(availableNow=True).start())
        q.awaitTermination()
        return q

    go()
    out = spark.read.schema("k long, ts_ms long, place long")
    assert out.parquet(f"{base}/out").count() == 0
    spark.createDataFrame([(1, 50_000, 3), (1, 200_000, 4)], schema).coalesce(1).write.mode("append").parquet(folder)
    assert dropped_rows(go()) == 1
    assert sorted(tuple(r) for r in out.parquet(f"{base}/out").collect()) == [(1, 99_000, 0), (1, 100_000, 1)]


def test_stream_runs_in_a_session_with_the_default_state_store(spark):
    """A cluster's session has no RocksDB provider set; the query brings its own and leaves the session as it was."""
    from kestrel.plans.q_tracking import causal_windows_stream

    name = "spark.sql.streaming.stateStore.providerClass"
    before, default = spark.conf.get(name), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(name, default)
    try:
        assert causal_windows_stream(spark, "/root/testdata/sf0.001").count() > 0
        assert spark.conf.get(name) == default
    finally:
        spark.conf.set(name, before)
