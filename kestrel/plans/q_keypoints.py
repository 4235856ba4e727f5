"""Queries for keypoint metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import keypoints as K
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_views
from kestrel.sources import tables as T

_KP = with_views("landmarks", "kp")

_BBOX_DIST = """,
b AS (SELECT sample_id, greatest(max(gx)-min(gx), max(gy)-min(gy)) AS nrm FROM kp GROUP BY sample_id),
dist AS (SELECT kp.*, CASE WHEN visible AND nrm <> 0 THEN
   sqrt(((px-gx)/n2)*((px-gx)/n2) + ((py-gy)/n2)*((py-gy)/n2)) END AS dist
   FROM kp JOIN (SELECT *, CASE WHEN nrm <= 0 THEN 1e6 ELSE nrm END AS n2 FROM b) USING (sample_id))
"""


def _dist_bbox(spark, sf_dir):
    kp = T.keypoint_pairs(spark, sf_dir)
    return K.normalized_distances(kp, K.bbox_norm(kp))


@register("pck_accuracy", _KP + _BBOX_DIST + """
SELECT CAST(pt AS BIGINT) AS pt, count(dist) AS n_valid, CAST(sum(CASE WHEN dist < 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS n_hit,
  round(CASE WHEN count(dist) > 0 THEN sum(CASE WHEN dist < 0.05 THEN 1 ELSE 0 END) / count(dist) END, 6) AS acc
FROM dist GROUP BY pt""")
def pck_accuracy(spark, sf_dir):
    """PCK@0.05 per joint, normalized by the larger side of the keypoint box."""
    per, _ = K.pck(_dist_bbox(spark, sf_dir), 0.05)
    return per.select(F.col("pt").cast("long"), "n_valid", "n_hit", F.round("acc", 6).alias("acc"))


@register("pck_summary", _KP + _BBOX_DIST + """,
per AS (SELECT pt, CASE WHEN count(dist) > 0 THEN sum(CASE WHEN dist < 0.1 THEN 1 ELSE 0 END) / count(dist) END AS acc
        FROM dist GROUP BY pt)
SELECT round(coalesce(avg(acc), 0.0), 6) AS pck, count(acc) AS n_joints FROM per""")
def pck_summary(spark, sf_dir):
    _, s = K.pck(_dist_bbox(spark, sf_dir), 0.1)
    return s.select(F.round("pck", 6).alias("pck"), "n_joints")


#: Groups of the fixture's landmarks, in the way of head, shoulders, elbows.
GROUPS = {"Head": [9], "Shoulder": [12, 13], "Elbow": [11, 14], "Wrist": [10, 15], "Hip": [2, 3], "Knee": [1, 4], "Ankle": [0, 5]}


@register("grouped_pck", _KP + _BBOX_DIST + """,
per AS (SELECT pt, count(dist) AS n, sum(CASE WHEN dist < 0.05 THEN 1 ELSE 0 END) AS h FROM dist GROUP BY pt HAVING count(dist) > 0),
g AS (SELECT * FROM (VALUES """ + ", ".join(f"('{k}', {j})" for k, v in GROUPS.items() for j in v) + """) t(name, pt))
SELECT name, round(avg(h / n), 6) AS pck FROM g JOIN per USING (pt) GROUP BY name UNION ALL SELECT 'PCK', round(sum(h) / sum(n), 6) FROM g JOIN per USING (pt)""")
def grouped_pck(spark, sf_dir):
    """Joint groups, and their joints together by how often they are valid."""
    return K.grouped_pck(_dist_bbox(spark, sf_dir), GROUPS, 0.05).select("name", F.round("pck", 6).alias("pck"))


@register("keypoint_auc", _KP + """,
dist AS (SELECT kp.*, CASE WHEN visible THEN sqrt(((px-gx)/0.1)*((px-gx)/0.1) + ((py-gy)/0.1)*((py-gy)/0.1)) END AS dist FROM kp),
th AS (SELECT unnest(range(0, 20)) AS i),
per AS (SELECT i, pt, sum(CASE WHEN dist < i/20.0 THEN 1 ELSE 0 END) / count(dist) AS acc
        FROM dist, th GROUP BY i, pt HAVING count(dist) > 0),
pt_avg AS (SELECT i, avg(acc) AS a FROM per GROUP BY i)
SELECT round(sum(a) / 20.0, 6) AS auc FROM pt_avg""")
def keypoint_auc(spark, sf_dir):
    """AUC of PCK over thresholds 0, 0.05, ..., 0.95 with normalizer 0.1."""
    kp = T.keypoint_pairs(spark, sf_dir)
    d = K.normalized_distances(kp, K.const_norm(kp, 0.1))
    return K.auc(d, 20).select(F.round("auc", 6).alias("auc"))


@register("keypoint_nme", _KP + """,
a AS (SELECT sample_id, gx AS ax, gy AS ay FROM kp WHERE pt = 0),
c AS (SELECT sample_id, gx AS cx, gy AS cy FROM kp WHERE pt = 16),
n AS (SELECT sample_id, sqrt((ax-cx)*(ax-cx) + (ay-cy)*(ay-cy)) AS nrm FROM a JOIN c USING (sample_id)),
dist AS (SELECT CASE WHEN visible AND nrm <> 0 THEN
  sqrt(((px-gx)/n2)*((px-gx)/n2) + ((py-gy)/n2)*((py-gy)/n2)) END AS dist
  FROM kp JOIN (SELECT *, CASE WHEN nrm <= 0 THEN 1e6 ELSE nrm END AS n2 FROM n) USING (sample_id))
SELECT round(coalesce(sum(dist), 0.0) / greatest(count(dist), 1), 6) AS error FROM dist""")
def keypoint_nme(spark, sf_dir):
    """NME normalized by the distance of ground-truth points 0 and 16."""
    kp = T.keypoint_pairs(spark, sf_dir)
    d = K.normalized_distances(kp, K.pair_norm(kp, 0, 16))
    return K.mean_error(d).select(F.round("error", 6).alias("error"))


@register("keypoint_epe", _KP + """
SELECT round(coalesce(sum(CASE WHEN visible THEN sqrt((px-gx)*(px-gx) + (py-gy)*(py-gy)) END), 0.0)
  / greatest(count(CASE WHEN visible THEN 1 END), 1), 6) AS error FROM kp""")
def keypoint_epe(spark, sf_dir):
    """Mean end-point error of visible joints (normalizer 1)."""
    kp = T.keypoint_pairs(spark, sf_dir)
    d = K.normalized_distances(kp, K.const_norm(kp, 1.0))
    return K.mean_error(d).select(F.round("error", 6).alias("error"))


@register("mpjpe_by_class", _KP + """,
s AS (SELECT sample_id, sum(px*gx + py*gy) / sum(px*px + py*py) AS sc FROM kp GROUP BY sample_id)
SELECT class_id, round(avg(CASE WHEN visible THEN sqrt((px-gx)*(px-gx) + (py-gy)*(py-gy)) END), 6) AS mpjpe,
  round(avg(CASE WHEN visible THEN sqrt((px*sc-gx)*(px*sc-gx) + (py*sc-gy)*(py*sc-gy)) END), 6) AS n_mpjpe
FROM kp JOIN s USING (sample_id) GROUP BY class_id""")
def mpjpe_by_class(spark, sf_dir):
    """MPJPE (no alignment) and N-MPJPE (scale alignment) per class."""
    kp = T.keypoint_pairs(spark, sf_dir)
    a = K.mpjpe(kp, alignment="none", by=("class_id",))
    b = K.mpjpe(kp, alignment="scale", by=("class_id",)).withColumnRenamed("mpjpe", "n_mpjpe")
    return a.join(b, "class_id").select("class_id", F.round("mpjpe", 6).alias("mpjpe"),
                                        F.round("n_mpjpe", 6).alias("n_mpjpe"))


@register("oks_pairs", _KP + """,
g AS (SELECT sample_id, (max(gx)-min(gx))*(max(gy)-min(gy)) AS ag, (max(px)-min(px))*(max(py)-min(py)) AS ap
      FROM kp GROUP BY sample_id)
SELECT sample_id, round(avg(exp(-(((px-gx)*(px-gx) + (py-gy)*(py-gy)) / ((0.05*2)*(0.05*2))
   / ((ag + ap)/2 + 2.220446049250313e-16) / 2))), 6) AS oks
FROM kp JOIN g USING (sample_id) GROUP BY sample_id""")
def oks_pairs(spark, sf_dir):
    """OKS of each sample's prediction against its ground truth (sigma 0.05)."""
    return K.oks(T.keypoint_pairs(spark, sf_dir), sigma=0.05).select("sample_id", F.round("oks", 6).alias("oks"))


@register("keypoint_instance_props", _KP + """
SELECT sample_id, round(coalesce(avg(CASE WHEN visible THEN gx END), 0.0), 6) AS root_x,
  round(coalesce(avg(CASE WHEN visible THEN gy END), 0.0), 6) AS root_y,
  round(greatest(min(gx) - 0.05, 0.0), 6) AS fx1, round(least(max(gx) + 0.05, 0.2), 6) AS fx2,
  CAST(sum(CASE WHEN visible AND NOT (gx < 0 OR gx > 0.2 OR gy < 0 OR gy > 0.2) THEN 1 ELSE 0 END) AS BIGINT) AS n_inside
FROM kp GROUP BY sample_id""")
def keypoint_instance_props(spark, sf_dir):
    """P20 root (mean of visible joints), P16 face box (margin 0.05, image 0.2 x 0.2)
    and P11 border clipping (visible joints left inside the 0.2 x 0.2 image)."""
    kp = T.keypoint_pairs(spark, sf_dir)
    root = K.instance_root(kp)
    fb = K.face_box(kp, F.lit(0.2), F.lit(0.2), margin=0.05)
    inside = K.clip_border(kp, 0.2, 0.2).groupBy("sample_id").agg(
        F.sum(F.col("visible").cast("long")).alias("n_inside"))
    return root.join(fb, "sample_id").join(inside, "sample_id").select(
        "sample_id", F.round("root_x", 6).alias("root_x"), F.round("root_y", 6).alias("root_y"),
        F.round("fx1", 6).alias("fx1"), F.round("fx2", 6).alias("fx2"), "n_inside")
