"""Queries for samplers and small geometric transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions import geometry as G
from kestrel.operators import sampling as K
from kestrel.operators import spatial as SP
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_views
from kestrel.sources import tables as T


@register("repeat_concat", with_views("frames") + """
SELECT video_id, count(*) * 4 AS n_rows, count(*) * 10 AS copy_sum FROM frames GROUP BY video_id""")
def repeat_concat(spark, sf_dir):
    """K7: the frame table concatenated with itself repeated three times."""
    f = T.frames(spark, sf_dir)
    r = K.concat_datasets(f.withColumn("copy", F.lit(1)), K.repeat_dataset(f, 3).withColumn("copy", F.col("copy") + 1))
    return r.groupBy("video_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("copy").cast("long").alias("copy_sum"))


@register("first_n_subset", with_views("det_boxes") + """
SELECT det_id, image_id FROM det_boxes ORDER BY det_id LIMIT 1000""")
def first_n_subset(spark, sf_dir):
    """K9: the first 1000 detections in index order."""
    return K.first_n(T.det_boxes(spark, sf_dir), 1000, [F.col("det_id")]).select("det_id", "image_id")


@register("box_distance_roundtrip", with_views("det_boxes") + """
SELECT det_id, round(least(greatest(((x1+x2)/2 - ((x1+x2)/2 - x1)), 0.0), 60.0), 6) AS bx1,
  round(least(greatest(((x1+x2)/2 + (x2 - (x1+x2)/2)), 0.0), 60.0), 6) AS bx2,
  round(((y1+y2)/2 - y1), 6) AS top, CAST(least(floor(least(greatest(score, 0.0), 1.0) * 10 / 1.0), 9) AS BIGINT) AS q,
  round((least(floor(least(greatest(score, 0.0), 1.0) * 10 / 1.0), 9) + 0.5) * 1.0 / 10 + 0.0, 6) AS dq
FROM det_boxes""")
def box_distance_roundtrip(spark, sf_dir):
    """P9 box centre -> (l, t, r, b) distances -> box clamped to a 60-wide
    image, and P22 quantization of the score into 10 levels and back."""
    d = T.det_boxes(spark, sf_dir)
    cx, cy = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    l, t, r, b = G.box_to_distance(cx, cy, "x1", "y1", "x2", "y2")
    bx1, _, bx2, _ = G.distance_to_box(cx, cy, l, t, r, b, max_w=F.lit(60.0), max_h=F.lit(80.0))
    q = G.quantize("score", 0.0, 1.0, 10)
    return d.select("det_id", F.round(bx1, 6).alias("bx1"), F.round(bx2, 6).alias("bx2"),
                    F.round(t, 6).alias("top"), q.alias("q"), F.round(G.dequantize(q, 0.0, 1.0, 10), 6).alias("dq"))


@register("chamfer_shifted", with_views("points") + """,
b AS (SELECT cloud_id, pt_id, x + 0.5 AS x, y + 0.25 AS y, z FROM points),
ab AS (SELECT a.cloud_id, a.pt_id AS pt, b.pt_id AS nn_pt,
         (a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z) AS d2, 'a->b' AS side
       FROM points a JOIN b USING (cloud_id)),
ba AS (SELECT b.cloud_id, b.pt_id AS pt, a.pt_id AS nn_pt,
         (b.x-a.x)*(b.x-a.x) + (b.y-a.y)*(b.y-a.y) + (b.z-a.z)*(b.z-a.z) AS d2, 'b->a' AS side
       FROM b JOIN points a USING (cloud_id)),
u AS (SELECT * FROM ab UNION ALL SELECT * FROM ba),
r AS (SELECT *, row_number() OVER (PARTITION BY side, cloud_id, pt ORDER BY d2, nn_pt) AS rn FROM u)
SELECT side, cloud_id, round(sum(d2), 4) AS sum_d2, count(*) AS n FROM r WHERE rn = 1 GROUP BY side, cloud_id""")
def chamfer_shifted(spark, sf_dir):
    """Chamfer nearest neighbours between each cloud and a shifted copy
    (x + 0.5, y + 0.25), summed per cloud and direction."""
    a = T.points(spark, sf_dir).select("cloud_id", "pt_id", "x", "y", "z")
    b = a.select("cloud_id", "pt_id", (F.col("x") + 0.5).alias("x"), (F.col("y") + 0.25).alias("y"), "z")
    c = SP.chamfer(a, b)
    return c.groupBy("side", "cloud_id").agg(F.round(F.sum("d2"), 4).alias("sum_d2"), F.count(F.lit(1)).alias("n"))
