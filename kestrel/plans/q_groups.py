"""Queries for points grouped about centres (J17) and sequences of tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import sequence as Q
from kestrel.operators import spatial as S
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_views
from kestrel.sources import tables as T

_C = with_views("points") + ", q AS (SELECT cloud_id, pt_id AS q_id, x AS qx, y AS qy, z AS qz FROM points WHERE pt_id % 23 = 0)"


def _centers(spark, sf_dir):
    return T.points(spark, sf_dir).where("pt_id % 23 = 0").select("cloud_id", F.col("pt_id").alias("q_id"), "x", "y", "z")


@register("grouped_in_ball", _C + """,
h AS (SELECT q.*, p.pt_id, p.x, p.y, p.z, p.feat, (p.x-qx)*(p.x-qx)+(p.y-qy)*(p.y-qy)+(p.z-qz)*(p.z-qz) AS d2 FROM q JOIN points p USING (cloud_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY cloud_id, q_id ORDER BY pt_id) - 1 AS slot FROM h WHERE d2 = 0 OR (d2 >= 1 AND d2 < 9) QUALIFY slot < 6),
n AS (SELECT cloud_id, q_id, count(*) AS u FROM r GROUP BY ALL),
s AS (SELECT n.cloud_id, n.q_id, n.u, CAST(k AS INTEGER) AS slot, CASE WHEN k < u THEN k ELSE 0 END AS src FROM n, (SELECT unnest(range(0, 6)) AS k))
SELECT s.cloud_id, s.q_id, s.slot, r.pt_id, round((x-qx)/3, 6) AS dx, round((y-qy)/3, 6) AS dy, round((z-qz)/3, 6) AS dz, feat, u AS unique_cnt
FROM s JOIN r ON r.cloud_id = s.cloud_id AND r.q_id = s.q_id AND r.slot = s.src""")
def grouped_in_ball(spark, sf_dir):
    """J17 by radius: offsets over the radius, short groups filled with their first hit."""
    g = S.query_and_group(T.points(spark, sf_dir), _centers(spark, sf_dir), 6, 3.0, 1.0, ("feat",), normalize=True)
    return g.select("cloud_id", "q_id", "slot", "pt_id", *[F.round(f"d{a}", 6).alias(f"d{a}") for a in "xyz"], "feat", "unique_cnt")


@register("grouped_nearest", _C + """,
h AS (SELECT q.*, p.pt_id, p.x, p.y, p.z, (p.x-qx)*(p.x-qx)+(p.y-qy)*(p.y-qy)+(p.z-qz)*(p.z-qz) AS d2 FROM q JOIN points p USING (cloud_id))
SELECT cloud_id, q_id, CAST(row_number() OVER w - 1 AS INTEGER) AS slot, pt_id, round(x-qx, 6) AS dx, round(y-qy, 6) AS dy, round(z-qz, 6) AS dz
FROM h WINDOW w AS (PARTITION BY cloud_id, q_id ORDER BY d2, pt_id) QUALIFY row_number() OVER w <= 4""")
def grouped_nearest(spark, sf_dir):
    """J17 by nearest neighbours."""
    g = S.query_and_group(T.points(spark, sf_dir), _centers(spark, sf_dir), 4)
    return g.select("cloud_id", "q_id", "slot", "pt_id", *[F.round(f"d{a}", 6).alias(f"d{a}") for a in "xyz"])


@register("track_sequences", with_views("tracked_boxes") + """,
t AS (SELECT DISTINCT video_id, frame_idx, det_id % 7 AS track_id FROM tracked_boxes),
f AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY frame_idx) - 1 AS pos, count(*) OVER (PARTITION BY video_id) AS n FROM (SELECT DISTINCT video_id, frame_idx FROM t)),
h AS (SELECT video_id, track_id, pos, n, n - least(n, 20) AS tgt FROM t JOIN f USING (video_id, frame_idx)),
g AS (SELECT *, pos - row_number() OVER (PARTITION BY video_id, track_id ORDER BY pos) AS run FROM h),
r AS (SELECT video_id, track_id, min(pos) AS lo, max(pos) AS hi, any_value(n) AS n, any_value(tgt) AS tgt FROM g GROUP BY video_id, track_id, run HAVING any_value(tgt) BETWEEN min(pos) AND max(pos)),
e AS (SELECT video_id, track_id, lo, hi, unnest(range(0, n)) AS pos FROM r)
SELECT e.video_id, e.track_id, e.pos, f.frame_idx AS src_frame FROM e JOIN f ON f.video_id = e.video_id AND f.pos = least(greatest(e.pos, e.lo), e.hi)""")
def track_sequences(spark, sf_dir):
    """W5 about the twentieth frame from the end; a detection's number gives its track."""
    rows = T.tracked_boxes(spark, sf_dir).select("video_id", "frame_idx", (F.col("det_id") % 7).alias("track_id"))
    return Q.track_sequences(rows, -20)
