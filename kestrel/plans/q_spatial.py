"""Queries for point clouds."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import spatial as SP
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_views
from kestrel.sources import tables as T

SIZE, LO, HI = (5.0, 2.0, 2.0), (0.0, 0.0, 0.0), (50.0, 10.0, 8.0)

_VOX = with_views("points") + """,
v0 AS (SELECT *, floor(x / 5.0) AS cx, floor(y / 2.0) AS cy, floor(z / 2.0) AS cz FROM points),
v AS (SELECT *, CASE WHEN cx >= 0 AND cx < 10 AND cy >= 0 AND cy < 5 AND cz >= 0 AND cz < 4 THEN 1 ELSE 0 END AS ok
      FROM v0)
"""


def _pts(spark, sf_dir):
    return T.points(spark, sf_dir)


@register("voxel_scatter", _VOX + """
SELECT cloud_id, CAST(cz AS BIGINT) AS vz, CAST(cy AS BIGINT) AS vy, CAST(cx AS BIGINT) AS vx,
  round(max(feat), 6) AS max_feat, round(avg(feat), 6) AS mean_feat, count(*) AS n_points
FROM v WHERE ok = 1 GROUP BY cloud_id, cz, cy, cx""")
def voxel_scatter(spark, sf_dir):
    """A37 dynamic voxel coordinates + A38 max and mean of the feature per voxel."""
    v = SP.voxel_coords(_pts(spark, sf_dir), SIZE, LO, HI)
    mx = SP.dynamic_scatter(v, ["feat"], "max")
    mn = SP.dynamic_scatter(v, ["feat"], "mean").drop("n_points")
    return mx.join(mn, ["cloud_id", "vz", "vy", "vx"]).select(
        "cloud_id", "vz", "vy", "vx", F.round("max_feat", 6).alias("max_feat"),
        F.round("mean_feat", 6).alias("mean_feat"), "n_points")


@register("hard_voxels", _VOX + """,
f AS (SELECT cloud_id, cz, cy, cx, min(pt_id) AS fp FROM v WHERE ok = 1 GROUP BY ALL),
fr AS (SELECT *, row_number() OVER (PARTITION BY cloud_id ORDER BY fp) AS voxel_no FROM f),
pv AS (SELECT v.cloud_id, v.pt_id, fr.voxel_no, row_number() OVER (PARTITION BY v.cloud_id, fr.voxel_no ORDER BY v.pt_id) AS slot
       FROM v JOIN fr USING (cloud_id, cz, cy, cx) WHERE v.ok = 1 AND fr.voxel_no <= 20)
SELECT cloud_id, pt_id, CAST(voxel_no AS BIGINT) AS voxel_no, CAST(slot AS BIGINT) AS slot FROM pv WHERE slot <= 5""")
def hard_voxels(spark, sf_dir):
    """A37 hard voxels: first 20 voxels per cloud, first 5 points per voxel."""
    h = SP.hard_voxels(_pts(spark, sf_dir), SIZE, LO, HI, max_points=5, max_voxels=20)
    return h.select("cloud_id", "pt_id", F.col("voxel_no").cast("long"), F.col("slot").cast("long"))


_PAIRS = with_views("points") + """,
c AS (SELECT a.cloud_id, a.pt_id AS q_id, b.pt_id, b.feat,
        (a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z) AS d2
      FROM points a JOIN points b USING (cloud_id))
"""


@register("knn_join", _PAIRS + """,
r AS (SELECT *, row_number() OVER (PARTITION BY cloud_id, q_id ORDER BY d2, pt_id) AS rank FROM c)
SELECT cloud_id, q_id, CAST(rank AS INTEGER) AS rank, pt_id, round(d2, 6) AS d2 FROM r WHERE rank <= 4""")
def knn_join(spark, sf_dir):
    """4 nearest points of every point in its cloud (itself included)."""
    p = _pts(spark, sf_dir)
    k = SP.knn(p, p.withColumnRenamed("pt_id", "q_id"), 4, cell=2.0)
    return k.select("cloud_id", "q_id", "rank", "pt_id", F.round("d2", 6).alias("d2"))


@register("ball_query", _PAIRS + """,
h AS (SELECT *, row_number() OVER (PARTITION BY cloud_id, q_id ORDER BY pt_id) AS rn FROM c
      WHERE d2 = 0 OR (d2 >= 0.25 AND d2 < 4.0)),
k AS (SELECT cloud_id, q_id, count(*) AS n_hits, min(pt_id) AS first_hit,
        sum(CASE WHEN rn <= 8 THEN pt_id % 1000 END) AS s FROM h GROUP BY cloud_id, q_id)
SELECT cloud_id, q_id, CAST(least(n_hits, 8) AS BIGINT) AS n_hits, first_hit,
  CAST(s + (8 - least(n_hits, 8)) * (first_hit % 1000) AS BIGINT) AS slot_sum FROM k""")
def ball_query(spark, sf_dir):
    """Up to 8 points with d2 == 0 or 0.5 <= d < 2 (index order), padded
    with the first hit; summarized per centre (real hits, first hit, slot checksum)."""
    p = _pts(spark, sf_dir)
    b = SP.ball_query(p, p.withColumnRenamed("pt_id", "q_id"), 0.5, 2.0, 8)
    first = b.where(F.col("slot") == 0).select("cloud_id", "q_id", F.col("pt_id").alias("first_hit"))
    agg = b.groupBy("cloud_id", "q_id").agg(F.countDistinct("slot").alias("_slots"),
                                            F.sum(F.col("pt_id") % 1000).cast("long").alias("slot_sum"))
    real = b.groupBy("cloud_id", "q_id", "pt_id").agg(F.count(F.lit(1)).alias("_c")) \
            .groupBy("cloud_id", "q_id").agg(F.count(F.lit(1)).cast("long").alias("n_hits"))
    return agg.join(first, ["cloud_id", "q_id"]).join(real, ["cloud_id", "q_id"]) \
              .select("cloud_id", "q_id", "n_hits", "first_hit", "slot_sum")


@register("three_nn_interpolate", _PAIRS + """,
r AS (SELECT *, row_number() OVER (PARTITION BY cloud_id, q_id ORDER BY d2, pt_id) AS rank FROM c),
t AS (SELECT cloud_id, q_id, feat, 1.0 / (sqrt(d2) + 1e-8) AS w FROM r WHERE rank <= 3)
SELECT cloud_id, q_id, round(sum(w * feat) / sum(w), 4) AS interp_feat, count(*) AS n_nn FROM t GROUP BY cloud_id, q_id""")
def three_nn_interpolate(spark, sf_dir):
    """Inverse-distance weighted feature of the three nearest points."""
    p = _pts(spark, sf_dir)
    t = SP.three_interpolate(p, p.withColumnRenamed("pt_id", "q_id"), "feat")
    return t.select("cloud_id", "q_id", F.round("interp_feat", 4).alias("interp_feat"), "n_nn")


@register("furthest_point_sampling")
def furthest_point_sampling(spark, sf_dir):
    """K8: 6 farthest-point picks per cloud (xyz)."""
    return SP.furthest_point_sample(_pts(spark, sf_dir), 6)
