"""Queries for pose layouts, cameras and decoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import keypoints as K
from kestrel.operators import poses as P
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_views
from kestrel.sources import tables as T

_MIRROR = [i + 1 - 2 * (i % 2) for i in range(32)]
_SCORED = """,
s AS (SELECT sample_id, pt, x, y, CAST((sample_id + pt) % 5 <> 0 AS INT)::DOUBLE AS v,
  CAST((sample_id * 7 + pt) % 10 AS DOUBLE) / 10 * CASE WHEN sample_id % 3 = 0 THEN CAST(0.2 AS DOUBLE) ELSE 1 END AS score FROM landmarks)
"""


def _poses(spark, sf_dir):
    """Landmark rows with a visibility and a score for each joint."""
    at = F.sequence(F.lit(0), F.lit(31))
    weak = F.when(F.col("sample_id") % 3 == 0, F.lit(0.2)).otherwise(F.lit(1.0))
    return T.landmarks(spark, sf_dir).withColumns({
        "vis": F.transform(at, lambda p: ((F.col("sample_id") + p) % 5 != 0).cast("int").cast("double")),
        "scores": F.transform(at, lambda p: ((F.col("sample_id") * 7 + p) % 10).cast("double") / 10 * weak)})


def _long(df, **arrays):
    """One row for each joint, with the arrays' values rounded."""
    zipped = df.select("sample_id", F.posexplode(F.arrays_zip(*[a.alias(n) for n, a in arrays.items()])).alias("pt", "_j"))
    return zipped.select("sample_id", F.col("pt").cast("long"), *[F.round(F.col("_j")[n], 6).alias(n) for n in arrays])


@register("keypoint_flips", with_views("landmarks") + _SCORED + """,
c AS (SELECT sample_id, avg(x) AS c FROM landmarks WHERE pt IN (11, 12) GROUP BY sample_id)
SELECT a.sample_id, CAST(a.pt AS BIGINT) AS pt, round(640.0::DOUBLE - b.x - 1, 6) AS hx, round(b.y, 6) AS hy, b.v AS hv,
  round(b.x, 6) AS vx, round(480.0::DOUBLE - b.y - 1, 6) AS vy, round(640.0::DOUBLE - a.x - 1, 6) AS dx, round(480.0::DOUBLE - a.y - 1, 6) AS dy,
  round(c * 2 - b.x, 6) AS rx, round(1.0::DOUBLE - b.x, 6) AS sx
FROM s a JOIN s b ON a.sample_id = b.sample_id AND b.pt = a.pt + 1 - 2 * (a.pt % 2) JOIN c ON c.sample_id = a.sample_id""")
def keypoint_flips(spark, sf_dir):
    """P10: horizontal, vertical and diagonal flips, and flips around root joints and a fixed x."""
    df, of = _poses(spark, sf_dir), ("xs", "ys", "vis")
    h, v, d = (P.flip(*of, _MIRROR, 640.0, 480.0, way) for way in ("horizontal", "vertical", "diagonal"))
    r, s = P.flip_about(*of, _MIRROR, root=[11, 12]), P.flip_about(*of, _MIRROR, 0.5)
    return _long(df, hx=h[0], hy=h[1], hv=h[2], vx=v[0], vy=v[1], dx=d[0], dy=d[1], rx=r[0], sx=s[0])


@register("layout_converted", with_views("landmarks") + _SCORED + """,
m(t, s1, s2) AS (VALUES (0, 0, 0), (1, 5, 6), (2, 3, 3), (4, 11, 12)), t(t) AS (VALUES (0), (1), (2), (3), (4), (5)),
i AS (SELECT DISTINCT sample_id FROM landmarks)
SELECT i.sample_id, CAST(t.t AS BIGINT) AS pt, coalesce(round((a.x + b.x) * 0.5, 6), 0) AS x, coalesce(round((a.y + b.y) * 0.5, 6), 0) AS y,
  coalesce(a.v * b.v, 0) AS v, CASE WHEN m.t IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS w
FROM i CROSS JOIN t LEFT JOIN m ON m.t = t.t LEFT JOIN s a ON a.sample_id = i.sample_id AND a.pt = m.s1
LEFT JOIN s b ON b.sample_id = i.sample_id AND b.pt = m.s2""")
def layout_converted(spark, sf_dir):
    """Four joints of a six-joint layout from single joints and pairs."""
    x, y, v, w = P.convert_layout("xs", "ys", "vis", 6, [(0, 0), ((5, 6), 1), (3, 2), ((11, 12), 4)])
    return _long(_poses(spark, sf_dir), x=x, y=y, v=v, w=w)


@register("neck_layout", with_views("landmarks") + _SCORED + """,
m(t, s1, s2) AS (VALUES (0,0,0), (1,5,6), (2,6,6), (3,8,8), (4,10,10), (5,5,5), (6,7,7), (7,9,9), (8,12,12), (9,14,14), (10,16,16), (11,11,11),
  (12,13,13), (13,15,15), (14,2,2), (15,1,1), (16,4,4), (17,3,3))
SELECT a.sample_id, CAST(t AS BIGINT) AS pt, round((a.x + b.x) / 2, 6) AS x, round((a.y + b.y) / 2, 6) AS y, round(least(a.score, b.score), 6) AS score
FROM m JOIN s a ON a.pt = s1 JOIN s b ON b.pt = s2 AND b.sample_id = a.sample_id""")
def neck_layout(spark, sf_dir):
    """17 joints to the 18-joint layout with a neck."""
    x, y, score = P.with_neck("xs", "ys", "scores")
    return _long(_poses(spark, sf_dir), x=x, y=y, score=score)


@register("pose_parts", with_views("landmarks") + _SCORED + """,
p AS (SELECT *, CASE WHEN pt < 18 THEN 'body' WHEN pt < 25 THEN 'left_hand' ELSE 'right_hand' END AS part FROM s)
SELECT sample_id, part, count(*) FILTER (score >= 0.3) AS n_joints, round(coalesce(sum(score) FILTER (score >= 0.3), 0), 6) AS part_score
FROM p GROUP BY sample_id, part""")
def pose_parts(spark, sf_dir):
    """Joints over 0.3 of three parts, and the sum of their scores."""
    got = P.parts("xs", "ys", "scores", {"body": (0, 18), "left_hand": (18, 25), "right_hand": (25, 32)})
    rows = F.array(*[F.struct(F.lit(n).alias("part"), F.coalesce(F.size(F.filter(c, lambda j: j.isNotNull())), F.lit(0)).cast("long").alias("n_joints"),
                              F.round(P.part_score(c), 6).alias("part_score")) for n, c in got.items()])
    return _poses(spark, sf_dir).select("sample_id", F.inline(rows))


@register("camera_pixels", with_views("points") + """,
c AS (SELECT pt_id, x, y, z, x * 0.8::DOUBLE + y * 0.6::DOUBLE + 1 AS a, y * 0.8::DOUBLE - x * 0.6::DOUBLE + 2 AS b, z + 30 AS d FROM points),
u AS (SELECT *, a / d AS u, b / d AS v, (a / d) * (a / d) + (b / d) * (b / d) AS r2 FROM c),
g AS (SELECT *, 1 + 0.1::DOUBLE * r2 - 0.02::DOUBLE * r2 * r2 + 0.003::DOUBLE * r2 * r2 * r2 + 2 * (u * -0.002::DOUBLE + v * 0.001::DOUBLE) AS g FROM u)
SELECT pt_id, round(1000 * (u * g - r2 * 0.002::DOUBLE) + 320, 4) AS px, round(1100 * (v * g + r2 * 0.001::DOUBLE) + 240, 4) AS py,
  round(a, 4) AS cam_x, round(b, 4) AS cam_y, round(x, 4) AS world_x, round(y, 4) AS world_y FROM g""")
def camera_pixels(spark, sf_dir):
    """World to camera to distorted pixel, and back from the undistorted pixel to the world."""
    turn, shift, focal, center = [[0.8, -0.6, 0.0], [0.6, 0.8, 0.0], [0.0, 0.0, 1.0]], [1.0, 2.0, 30.0], (1000.0, 1100.0), (320.0, 240.0)
    cam = P.world_to_camera([F.col(c) for c in "xyz"], turn, shift)
    px = P.camera_to_pixel(cam, focal, center, (0.1, -0.02, 0.003), (0.001, -0.002))
    back = P.pixel_to_camera(P.camera_to_pixel(cam, focal, center), cam[2], focal, center)
    world = P.camera_to_world(back, turn, shift)
    named = {"px": px[0], "py": px[1], "cam_x": back[0], "cam_y": back[1], "world_x": world[0], "world_y": world[1]}
    return T.points(spark, sf_dir).select("pt_id", *[F.round(c, 4).alias(n) for n, c in named.items()])


_AXES = """WITH j AS (SELECT vec_id AS sample_id, unnest([0, 1, 2, 3]) AS joint, embedding FROM embeddings),
a AS (SELECT sample_id, joint, embedding[16*joint+1 : 16*joint+8]::DOUBLE[] AS xs, embedding[16*joint+9 : 16*joint+16]::DOUBLE[] AS ys FROM j),
m AS (SELECT *, list_max(xs) AS mx, list_max(ys) AS my FROM a),
d AS (SELECT sample_id, CAST(joint AS BIGINT) AS joint, xs, ys, mx, my, least(mx, my) AS score,
  CASE WHEN least(mx, my) > 0 THEN list_position(xs, mx) - 1.0::DOUBLE ELSE -1.0::DOUBLE END / 2 AS x,
  CASE WHEN least(mx, my) > 0 THEN list_position(ys, my) - 1.0::DOUBLE ELSE -1.0::DOUBLE END / 2 AS y FROM m)
"""


def _axes(spark, sf_dir):
    """Four joints a sample, each with eight bins along either axis."""
    j = T.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sample_id"), F.col("embedding").cast("array<double>").alias("e"),
                                                    F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("j"))
    return j.select("sample_id", F.col("j").cast("long").alias("joint"), F.slice("e", F.col("j") * 16 + 1, F.lit(8)).alias("xs"),
                    F.slice("e", F.col("j") * 16 + 9, F.lit(8)).alias("ys"))


@register("axis_decode", _AXES + """SELECT sample_id, joint, x, y, round(score, 6) AS score, round((mx + my) / 2, 6) AS mean_score,
  round(1 / greatest(list_sum(list_transform(xs, lambda e: exp(e - mx))), list_sum(list_transform(ys, lambda e: exp(e - my)))), 6) AS soft_score FROM d""")
def axis_decode(spark, sf_dir):
    """Joints from their bins, with the smaller, the mean and the softmax score."""
    x, y, score = P.decode_axes("xs", "ys", 2.0)
    mean, soft = P.decode_axes("xs", "ys", 2.0, "mean")[2], P.decode_axes("xs", "ys", 2.0, normalise=True)[2]
    return _axes(spark, sf_dir).select("sample_id", "joint", x.alias("x"), y.alias("y"), F.round(score, 6).alias("score"),
                                       F.round(mean, 6).alias("mean_score"), F.round(soft, 6).alias("soft_score"))


@register("axis_pck", _AXES + """, e AS (SELECT p.joint, sqrt(((p.x - t.x) / 4) * ((p.x - t.x) / 4) + ((p.y - t.y) / 4) * ((p.y - t.y) / 4)) AS dist
  FROM d p JOIN d t ON t.sample_id = p.sample_id AND t.joint = (p.joint + 1) % 4 WHERE (p.sample_id + p.joint) % 5 <> 0)
SELECT joint, count(*) AS n_valid, count(*) FILTER (dist < 0.3) AS n_hit, round(count(*) FILTER (dist < 0.3) / count(*), 6) AS acc FROM e GROUP BY joint""")
def axis_pck(spark, sf_dir):
    """Accuracy of decoded joints, each held against the decoded next joint as its target."""
    x, y, _ = P.decode_axes("xs", "ys", 2.0)
    rows = _axes(spark, sf_dir).groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("joint", x.alias("x"), y.alias("y")))).alias("js"))  # four a sample
    pairs = rows.select("sample_id", F.explode("js").alias("p"), "js").select(
        "sample_id", "p.joint", "p.x", "p.y", F.get("js", ((F.col("p.joint") + 1) % 4).cast("int")).alias("t"))
    dx, dy = (F.col("x") - F.col("t.x")) / 4, (F.col("y") - F.col("t.y")) / 4
    dist = pairs.select("joint", F.when((F.col("sample_id") + F.col("joint")) % 5 != 0, F.sqrt(dx * dx + dy * dy)).alias("dist"))
    return K.pck(dist, 0.3, pt="joint")[0].select("joint", "n_valid", "n_hit", F.round("acc", 6).alias("acc"))


@register("capture_keys", """SELECT vec_id, 'S' || label AS subject, 'Walking ' || (vec_id % 3) AS action, CAST(54138969 + vec_id % 4 AS VARCHAR) AS camera
FROM embeddings""")
def capture_keys(spark, sf_dir):
    """Subject, action and camera read back from file names."""
    e = T.table(spark, sf_dir, "embeddings")
    path = F.concat(F.lit("images/S"), F.col("label"), F.lit("_Walking "), F.col("vec_id") % 3, F.lit("."), F.col("vec_id") % 4 + 54138969,
                    F.lit("_"), F.col("vec_id"), F.lit(".jpg"))
    subject, action, camera = P.capture_key(path)
    return e.select("vec_id", subject.alias("subject"), action.alias("action"), camera.alias("camera"))
