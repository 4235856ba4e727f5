"""Queries for tracking, batch and stream (T3, T4, T5), and frame windows on a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kestrel.operators import tracking as TR
from kestrel.plans.catalog import register
from kestrel.plans.oracle import VIEWS, with_views
from kestrel.session import checkpoint_dir
from kestrel.sources import tables as T
from kestrel.streaming import tracks as ST
from kestrel.streaming.ordered import run_files

DAY = 86_400_000


def _recursive(rows: str, like: str, restart: bool, views: str = "tracked_boxes") -> str:
    """A row at a time of every video at once: the state is what the last frame left free, what this one kept, and the next id."""
    fresh = "CASE WHEN len(CASE WHEN n.frame_idx = s.frame_idx + 1 THEN s.kept ELSE [] END) = 0 THEN 0 ELSE s.next_id END" if restart else "s.next_id"
    return f"""WITH RECURSIVE {views} AS ({VIEWS[views]}),
r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY frame_idx, det_id) AS i FROM ({rows})),
step AS (
  SELECT video_id, 0::BIGINT AS i, -9::BIGINT AS frame_idx, -1::BIGINT AS det_id, -1::BIGINT AS track_id, 0::BIGINT AS next_id,
         [{{'t': -1::BIGINT, 'n': [0.0::DOUBLE]}}][2:] AS free, [{{'t': -1::BIGINT, 'n': [0.0::DOUBLE]}}][2:] AS kept FROM (SELECT DISTINCT video_id FROM r)
  UNION ALL
  SELECT video_id, i, frame_idx, det_id, CASE WHEN hit THEN free[p].t WHEN eligible THEN next_id ELSE -1 END,
         CASE WHEN NOT hit AND eligible THEN next_id + 1 ELSE next_id END,
         CASE WHEN hit THEN list_concat(free[:p - 1], free[p + 1:]) ELSE free END,
         CASE WHEN hit THEN list_append(kept, {{'t': free[p].t, 'n': numbers}}) WHEN eligible THEN list_append(kept, {{'t': next_id, 'n': numbers}}) ELSE kept END
  FROM (SELECT *, coalesce(likes[p] > 0.3, false) AS hit FROM (SELECT *, list_position(likes, list_max(likes)) AS p FROM (
    SELECT *, list_transform(free, lambda f: {like}) AS likes FROM (
      SELECT n.video_id, n.i, n.frame_idx, n.det_id, n.numbers, n.eligible,
             CASE WHEN n.frame_idx = s.frame_idx THEN s.next_id ELSE {fresh} END AS next_id,
             CASE WHEN n.frame_idx = s.frame_idx THEN s.free WHEN n.frame_idx = s.frame_idx + 1 THEN s.kept ELSE [] END AS free,
             CASE WHEN n.frame_idx = s.frame_idx THEN s.kept ELSE [] END AS kept
      FROM step s JOIN r n ON n.video_id = s.video_id AND n.i = s.i + 1)))))
SELECT video_id, frame_idx, det_id, track_id FROM step WHERE i > 0"""


_BOX_ROWS = "SELECT video_id, frame_idx, det_id, [x1, y1, x2, y2] AS numbers, (x2-x1)*(y2-y1) >= 1000 AS eligible FROM tracked_boxes"
_INTER = "(greatest(least(numbers[3], f.n[3]) - greatest(numbers[1], f.n[1]), 0) * greatest(least(numbers[4], f.n[4]) - greatest(numbers[2], f.n[2]), 0))"
_IOU = f"{_INTER} / ((numbers[3]-numbers[1])*(numbers[4]-numbers[2]) + (f.n[3]-f.n[1])*(f.n[4]-f.n[2]) - {_INTER})"
_BOX_SQL = _recursive(_BOX_ROWS, _IOU, True)

#: Corners and centre of a box as joints; a box marked ``few`` has y = 0 in three of them.
SIGMAS = [0.05, 0.05, 0.08, 0.08, 0.1]
_POSE_ROWS = """SELECT video_id, frame_idx, det_id, [(x2-x1)*(y2-y1), x1, CASE WHEN few THEN 0 ELSE y1+1 END, x2, CASE WHEN few THEN 0 ELSE y1+1 END,
    x1, CASE WHEN few THEN 0 ELSE y2 END, x2, y2, (x1+x2)/2, (y1+y2)/2] AS numbers, NOT few AS eligible FROM tracked_boxes"""
_OKS = "(" + " + ".join(
    f"exp(-((numbers[{2 * j + 2}]-f.n[{2 * j + 2}])*(numbers[{2 * j + 2}]-f.n[{2 * j + 2}]) + (numbers[{2 * j + 3}]-f.n[{2 * j + 3}])*(numbers[{2 * j + 3}]-f.n[{2 * j + 3}]))"
    f" / CAST({(2 * s) ** 2!r} AS DOUBLE) / ((numbers[1]+f.n[1])/2 + CAST(2.220446049250313e-16 AS DOUBLE)) / 2)" for j, s in enumerate(SIGMAS)) + ") / 5"


def _boxes(spark, sf_dir):
    box = F.array("x1", "y1", "x2", "y2")
    return T.tracked_boxes(spark, sf_dir).select("video_id", "frame_idx", "det_id", box.alias("numbers"), TR.large_enough(box).alias("eligible"))


def _poses(spark, sf_dir):
    b = T.tracked_boxes(spark, sf_dir)
    hidden = lambda c: F.when(F.col("few"), F.lit(0.0)).otherwise(c)
    cx, cy = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    top = hidden(F.col("y1") + 1)
    ys = F.array(top, top, hidden(F.col("y2")), F.col("y2"), cy)
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    numbers = F.array(area, "x1", top, "x2", top, "x1", hidden(F.col("y2")), "x2", "y2", cx, cy)
    return b.select("video_id", "frame_idx", "det_id", numbers.alias("numbers"), TR.enough_joints(ys).alias("eligible"))


@register("iou_tracks", _BOX_SQL)
def iou_tracks(spark, sf_dir):
    """Boxes of at least 1000 units of area begin tracks; ids begin again after a frame that kept nothing."""
    return TR.track(_boxes(spark, sf_dir), "numbers", "eligible", chunk=16)


@register("oks_tracks", _recursive(_POSE_ROWS, _OKS, False))
def oks_tracks(spark, sf_dir):
    """T4 with T5's rule: poses by OKS; a new track needs three joints with y other than 0, and ids never begin again."""
    return TR.track(_poses(spark, sf_dir), "numbers", "eligible", similarity=TR.pose_similarity(SIGMAS), restart=False, chunk=16)


def _shuffled_files(spark, rows, files: int = 8) -> str:
    """``rows`` in so many files, each with rows from all over."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/shuffled-{uuid.uuid4().hex}"
    rows.repartition(files, F.xxhash64(F.lit(5), *rows.columns)).write.parquet(folder)
    return folder


@register("iou_tracks_stream", _BOX_SQL)
def iou_tracks_stream(spark, sf_dir):
    """T3 as a stream over shuffled files: equal to the batch twin."""
    rows = _boxes(spark, sf_dir).withColumn("ts_ms", (F.col("frame_idx") + 1) * 1000)
    folder = _shuffled_files(spark, rows)
    return run_files(spark, folder, rows.schema, lambda s: ST.track_stream(s, delay="1 day"), "ts_ms", ST.TRACK_SCHEMA, files_at_once=2, delay_ms=DAY)


@register("causal_windows_stream", with_views("frames") + """,
f AS (SELECT video_id, frame_idx, row_number() OVER (PARTITION BY video_id ORDER BY frame_idx) - 1 AS pos FROM frames),
k AS (SELECT unnest(range(0, 4)) AS k)
SELECT f.video_id, f.frame_idx AS target_frame, CAST(k.k AS INTEGER) AS k, g.frame_idx AS src_frame
FROM f, k JOIN f g ON g.video_id = f.video_id AND g.pos = greatest(f.pos + k.k - 3, 0)""")
def causal_windows_stream(spark, sf_dir):
    """The four last frames of every frame, over shuffled files of a stream."""
    rows = T.frames(spark, sf_dir).withColumn("ts_ms", (F.col("frame_idx") + 1) * 1000)
    folder = _shuffled_files(spark, rows)
    return run_files(spark, folder, rows.schema, lambda s: ST.causal_windows_stream(s, 4, delay="1 day"), "ts_ms", ST.WINDOW_SCHEMA, files_at_once=2, delay_ms=DAY)
