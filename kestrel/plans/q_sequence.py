"""Queries for frame sequences and running means."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import sequence as S
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_views
from kestrel.sources import tables as T

_POS = with_views("frames") + """,
f AS (SELECT video_id, frame_idx, row_number() OVER (PARTITION BY video_id ORDER BY frame_idx) - 1 AS pos,
        count(*) OVER (PARTITION BY video_id) AS n FROM frames)
"""


@register("padded_frame_windows", _POS + """,
k AS (SELECT unnest(range(0, 5)) AS k),
s AS (SELECT f.video_id, f.frame_idx AS target_frame, k.k, least(greatest(f.pos + (k.k - 2)*2, 0), f.n - 1) AS sp
      FROM f, k)
SELECT s.video_id, s.target_frame, CAST(s.k AS INTEGER) AS k, g.frame_idx AS src_frame
FROM s JOIN f g ON g.video_id = s.video_id AND g.pos = s.sp""")
def padded_frame_windows(spark, sf_dir):
    """Centred 5-frame windows with step 2, padded at both video ends."""
    return S.padded_windows(T.frames(spark, sf_dir), seq_len=5, causal=False, step=2)


@register("causal_frame_windows", _POS + """,
k AS (SELECT unnest(range(0, 4)) AS k),
s AS (SELECT f.video_id, f.frame_idx AS target_frame, k.k, least(greatest(f.pos + (k.k - 3), 0), f.n - 1) AS sp
      FROM f, k)
SELECT s.video_id, s.target_frame, CAST(s.k AS INTEGER) AS k, g.frame_idx AS src_frame
FROM s JOIN f g ON g.video_id = s.video_id AND g.pos = s.sp""")
def causal_frame_windows(spark, sf_dir):
    """W1 causal: the target frame last in a 4-frame window."""
    return S.padded_windows(T.frames(spark, sf_dir), seq_len=4, causal=True, step=1)


@register("sliding_sequences", _POS + """,
k AS (SELECT unnest(range(0, 3)) AS k)
SELECT f.video_id, f.frame_idx AS seq_start, CAST(k.k AS INTEGER) AS k, g.frame_idx AS src_frame
FROM f, k JOIN f g ON g.video_id = f.video_id AND g.pos = f.pos + k.k*2
WHERE f.pos + 5 <= f.n""")
def sliding_sequences(spark, sf_dir):
    """Unpadded 3-frame sequences with step 2 (span 5) from every start."""
    return S.sliding_sequences(T.frames(spark, sf_dir), seq_len=3, step=2)


@register("multi_target_chunks", _POS + """,
k AS (SELECT unnest(range(0, 4)) AS k)
SELECT f.video_id, CAST(f.pos / 2 AS BIGINT) AS chunk, CAST(k.k AS INTEGER) AS k, g.frame_idx AS src_frame
FROM f, k JOIN f g ON g.video_id = f.video_id AND g.pos = f.pos + k.k
WHERE f.pos % 2 = 0 AND f.pos / 2 < floor((f.n + 2 - 4) / 2)""")
def multi_target_chunks(spark, sf_dir):
    """Chunks of 4 frames every 2 frames, incomplete tail dropped."""
    return S.multi_target_chunks(T.frames(spark, sf_dir), size=4, stride=2, step=1)


@register("supporting_frames", _POS + """,
o AS (SELECT * FROM (VALUES (0, 0), (1, -2), (2, -1), (3, 1), (4, 2)) t(slot, off))
SELECT f.video_id, f.frame_idx AS frame, slot, g.frame_idx AS support_frame
FROM f, o JOIN f g ON g.video_id = f.video_id AND g.pos = least(greatest(f.pos + o.off, 0), f.n - 1)""")
def supporting_frames(spark, sf_dir):
    """Current frame then offsets -2, -1, +1, +2 clipped to the video."""
    return S.supporting_frames(T.frames(spark, sf_dir), [-2, -1, 0, 1, 2])


@register("supporting_frames_online", _POS + """,
o AS (SELECT * FROM (VALUES (0, 0), (1, -2), (2, -1), (3, 1)) t(slot, off))
SELECT f.video_id, f.frame_idx AS frame, slot, g.frame_idx AS support_frame
FROM f, o JOIN f g ON g.video_id = f.video_id AND g.pos = least(greatest(f.pos + o.off, 0), f.pos)""")
def supporting_frames_online(spark, sf_dir):
    """W7 online: future offsets clipped to the current frame."""
    return S.supporting_frames(T.frames(spark, sf_dir), [-2, -1, 0, 1], online=True)


@register("detection_reuse_frames", _POS + """
SELECT f.video_id, f.frame_idx AS frame, g.frame_idx AS det_frame
FROM f JOIN f g ON g.video_id = f.video_id AND g.pos = f.pos - f.pos % 3""")
def detection_reuse_frames(spark, sf_dir):
    """Detect on every third frame, reuse boxes in between."""
    return S.detection_frames(T.frames(spark, sf_dir), 3)


@register("sensor_running_mean", with_views("sensor_readings") + """
SELECT device, seq, round(avg(value) OVER (PARTITION BY device ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6)
  AS running_mean FROM sensor_readings""")
def sensor_running_mean(spark, sf_dir):
    """Mean of the last 10 readings per device."""
    r = S.last_n_mean(T.sensor_readings(spark, sf_dir), "device", "seq", "value", 10)
    return r.select("device", "seq", F.round("running_mean", 6).alias("running_mean"))
