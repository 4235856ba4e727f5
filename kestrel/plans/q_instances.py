"""Queries for instance rows and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import instances as I
from kestrel.operators import keypoints as K
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_views
from kestrel.sources import tables as T


def _round(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@register("valid_instances", with_views("det_boxes") + """,
c AS (SELECT det_id, class_id, least(greatest(x1, 0.0), 59.0) AS cx1, least(greatest(y1, 0.0), 44.0) AS cy1,
   least(greatest(x2, 0.0), 59.0) AS cx2, least(greatest(y2, 0.0), 44.0) AS cy2, score FROM det_boxes)
SELECT det_id, cx1 AS x1, cy1 AS y1, cx2 AS x2, cy2 AS y2 FROM c
WHERE class_id <> 'N' AND det_id % 5 <> 0 AND cx2 > cx1 AND cy2 > cy1 AND det_id % 7 - 1 > 0 AND score >= 0.2""")
def valid_instances(spark, sf_dir):
    """Boxes clipped to a 60 x 45 image, invalid and low-scoring instances dropped."""
    d = T.det_boxes(spark, sf_dir)
    xywh = d.select("det_id", "score", F.col("x1").alias("x"), F.col("y1").alias("y"), (F.col("x2") - F.col("x1")).alias("w"),
                    (F.col("y2") - F.col("y1")).alias("h"), (F.col("class_id") == "N").alias("iscrowd"),
                    (F.col("det_id") % 5).alias("num_keypoints"), (F.col("det_id") % 7 - 1).alias("kp_max"))
    kept = I.drop_low_scores(I.valid_instances(I.clip_instances(xywh, F.lit(60.0), F.lit(45.0))), "score", 0.2)
    return kept.select("det_id", "x1", "y1", "x2", "y2")


@register("pose_normalized", with_views("landmarks") + """,
n AS (SELECT sample_id, pt, x / 640.0 AS fx, y / 480.0 AS fy, x, y, min(x) OVER s AS a1, max(x) OVER s AS a2, min(y) OVER s AS b1, max(y) OVER s AS b2,
   avg(CASE WHEN pt IN (11, 12) THEN x END) OVER s AS rx, avg(CASE WHEN pt IN (11, 12) THEN y END) OVER s AS ry
   FROM landmarks WINDOW s AS (PARTITION BY sample_id))
SELECT sample_id, CAST(pt AS BIGINT) AS pt, round(fx, 9) AS frac_x, round(fy, 9) AS frac_y,
   round((x - (a1 + a2) / 2) / greatest(a2 - a1, b2 - b1) * 1.5 + 0.25, 6) AS box_x, round((y - (b1 + b2) / 2) / greatest(a2 - a1, b2 - b1) * 1.5 + 0.5, 6) AS box_y,
   round(x - rx, 6) AS rel_x, round(y - ry, 6) AS rel_y FROM n WHERE pt NOT IN (11, 12)""")
def pose_normalized(spark, sf_dir):
    """Shares of the image, the pose in a common box, joints relative to the root."""
    lm = T.landmarks_long(spark, sf_dir).select("sample_id", "pt", "x", "y")
    boxed = lm.join(K.instance_bbox(lm, x="x", y="y"), "sample_id").withColumns({"ox": F.col("x"), "oy": F.col("y")})
    boxed = I.to_common_box(boxed, 1.5, (0.25, 0.5)).withColumnsRenamed({"x": "box_x", "y": "box_y", "ox": "x", "oy": "y"})
    rel = boxed.withColumns({"frac_x": F.col("x"), "frac_y": F.col("y")})
    rel = I.by_image_size(I.center_on_root(rel, [11, 12], drop_root=True), 640.0, 480.0, "frac_x", "frac_y")
    rel = rel.withColumns({"frac_x": F.round("frac_x", 9), "frac_y": F.round("frac_y", 9)})
    return _round(rel.select("sample_id", F.col("pt").cast("long"), "frac_x", "frac_y", "box_x", "box_y", F.col("x").alias("rel_x"), F.col("y").alias("rel_y")),
                  "box_x", "box_y", "rel_x", "rel_y")


@register("joints_standardized", with_views("landmarks") + """,
m AS (SELECT pt, avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, stddev_pop(y) AS sy FROM landmarks GROUP BY pt)
SELECT sample_id, CAST(pt AS BIGINT) AS pt, round(CASE WHEN sx > 0 THEN (x - mx) / sx ELSE 0.0 END, 6) AS x,
  round(CASE WHEN sy > 0 THEN (y - my) / sy ELSE 0.0 END, 6) AS y FROM landmarks JOIN m USING (pt)""")
def joints_standardized(spark, sf_dir):
    """Z-scores of every joint's coordinates."""
    z = I.standardize(T.landmarks_long(spark, sf_dir).select("sample_id", "pt", "x", "y"), ["pt"])
    return _round(z.select("sample_id", F.col("pt").cast("long"), "x", "y"), "x", "y")


@register("pose_scores", with_views("landmarks") + """,
j AS (SELECT sample_id, (sample_id % 100) / 100.0 AS b, ((sample_id * 7 + pt * 13) % 10) / 10.0 * ((sample_id % 11 <> 0)::INT) AS s FROM landmarks)
SELECT sample_id, round(CAST(any_value(b) AS DOUBLE), 6) AS score_bbox, round(avg(s), 6) AS score_keypoint,
  round(any_value(b) + avg(s) + max(s), 6) AS score_bbox_rle, round(any_value(b) * coalesce(avg(CASE WHEN s > 0.2 THEN s END), 0.0), 6) AS score_bbox_keypoint
FROM j GROUP BY sample_id""")
def pose_scores(spark, sf_dir):
    """All four modes; every 11th sample has no joint above the threshold."""
    lm = T.landmarks_long(spark, sf_dir)
    s = F.when(F.col("sample_id") % 11 != 0, (F.col("sample_id") * 7 + F.col("pt") * 13) % 10 / 10.0).otherwise(F.lit(0.0))
    j = lm.select("sample_id", (F.col("sample_id") % 100 / 100.0).alias("b"), s.alias("s"))
    return _round(I.pose_scores(j, ["sample_id"], "b", "s"), "score_bbox", "score_keypoint", "score_bbox_rle", "score_bbox_keypoint")


@register("largest_detection", with_views("det_boxes") + """,
r AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY (x2-x1)*(y2-y1) DESC, det_id) AS rn FROM det_boxes WHERE score > 0.3 AND class_id = 'A')
SELECT image_id, det_id, x1, y1, x2, y2, score FROM r WHERE rn = 1""")
def largest_detection(spark, sf_dir):
    """Largest box of class A with a score above 0.3, per image."""
    return I.largest_box(T.det_boxes(spark, sf_dir).where(F.col("class_id") == "A"), ["image_id"], "det_id")


@register("extraction_summary", with_views("det_boxes", "gt_boxes") + """,
l AS (SELECT class_id, score, CASE WHEN det_id IN (SELECT gt_id FROM gt_boxes) THEN 'exists' WHEN score < 0.1 THEN 'failed' ELSE 'saved' END AS status FROM det_boxes)
SELECT class_id AS directory, CAST(sum((status = 'saved')::INT) AS BIGINT) AS saved, CAST(sum((status = 'exists')::INT) AS BIGINT) AS "exists", CAST(sum((status = 'failed')::INT) AS BIGINT) AS failed,
  round(coalesce(avg(CASE WHEN status = 'saved' THEN score END), 0.0), 6) AS mean_seconds,
  round(coalesce(count(CASE WHEN status = 'saved' THEN 1 END) / nullif(sum(CASE WHEN status = 'saved' THEN score END), 0), 0.0), 6) AS per_second
FROM l GROUP BY ROLLUP (class_id)""")
def extraction_summary(spark, sf_dir):
    """Boxes with a ground truth of their id count as done, the others are saved or fail."""
    d = T.det_boxes(spark, sf_dir).select(F.col("class_id").alias("directory"), "det_id", F.col("score").alias("seconds"))
    todo, have = I.split_done(d, T.gt_boxes(spark, sf_dir).select(F.col("gt_id").alias("det_id")), "det_id")
    log = todo.withColumn("status", F.when(F.col("seconds") < 0.1, "failed").otherwise("saved")).unionByName(have.withColumn("status", F.lit("exists")))
    return _round(I.extraction_summary(log, "directory"), "mean_seconds", "per_second")


@register("dedupe_in_image", with_views("det_boxes") + """,
r AS (SELECT image_id, det_id % 3 AS obj_id, det_id, score, row_number() OVER (PARTITION BY image_id, det_id % 3 ORDER BY det_id) AS rn FROM det_boxes)
SELECT image_id, obj_id, det_id, score FROM r WHERE rn = 1""")
def dedupe_in_image(spark, sf_dir):
    """The first of the rows with equal id in an image."""
    d = T.det_boxes(spark, sf_dir).select("image_id", (F.col("det_id") % 3).alias("obj_id"), "det_id", "score")
    return I.first_per_id(d, ["image_id", "obj_id"], [F.col("det_id")])


@register("prediction_scores", with_views("predictions") + """,
p AS (SELECT confidence AS c, label = pred AS ok, least(greatest(confidence, 1e-15), 1 - 1e-15) AS q, label, pred FROM predictions),
k AS (SELECT c, sum(ok::INT) AS pos, sum((NOT ok)::INT) AS neg FROM p GROUP BY c),
u AS (SELECT pos, neg, sum(neg) OVER (ORDER BY c) - neg / 2.0 AS below FROM k),
a AS (SELECT sum(pos * below) / (sum(pos) * sum(neg)) AS auc FROM u),
v AS (SELECT avg(label) AS m FROM p)
SELECT round((SELECT auc FROM a), 6) AS auc, round(-avg(CASE WHEN ok THEN ln(q) ELSE ln(1 - q) END), 6) AS log_loss,
  round(sqrt(avg((label-pred)*(label-pred))), 6) AS rmse, round(avg(abs(label-pred)), 6) AS mae,
  round(1 - sum((label-pred)*(label-pred)) / sum((label - m)*(label - m)), 6) AS r2 FROM p, v""")
def prediction_scores(spark, sf_dir):
    """AUC and log loss of the confidence, RMSE, MAE and R2 of the predicted label."""
    p = T.predictions(spark, sf_dir).withColumn("ok", F.col("label") == F.col("pred"))
    both = I.binary_scores(p, "ok", "confidence").crossJoin(I.regression_errors(p, "label", "pred"))  # one row each
    return _round(both, "auc", "log_loss", "rmse", "mae", "r2")


@register("multilabel_accuracy", with_views("landmarks", "kp") + """,
i AS (SELECT sample_id, min((visible OR sample_id % 2 = 0)::INT) AS known, min((((px - 0.0) * (gx - 0.0)) > 0)::INT) AS ok FROM kp WHERE pt < 3 GROUP BY sample_id)
SELECT round(coalesce(avg(ok), 0.0), 6) AS accuracy, count(*) AS n_valid FROM i WHERE known = 1""")
def multilabel_accuracy(spark, sf_dir):
    """Three labels for each sample, threshold 0."""
    kp = T.keypoint_pairs(spark, sf_dir).where(F.col("pt") < 3).withColumn("known", F.col("visible") | (F.col("sample_id") % 2 == 0))
    return _round(I.multilabel_accuracy(kp, "sample_id", "gx", "px", "known", 0.0), "accuracy")


@register("partition_pck", with_views("landmarks", "kp") + """,
per AS (SELECT class_id, pt, count(CASE WHEN visible THEN 1 END) AS n, sum(CASE WHEN visible AND sqrt((px-gx)*(px-gx) + (py-gy)*(py-gy)) / 0.1 < 0.15 THEN 1 ELSE 0 END) AS hit FROM kp GROUP BY class_id, pt),
parts AS (SELECT 'all' AS part, p AS pt FROM (SELECT unnest(range(0, 32)) AS p) UNION ALL SELECT 'face', p FROM (SELECT unnest(range(0, 10)) AS p) UNION ALL SELECT 'hand', p FROM (SELECT unnest(range(8, 20)) AS p))
SELECT part, class_id, round(coalesce(avg(CASE WHEN n > 0 THEN hit / n END), 0.0), 6) AS pck, CAST(sum(n) AS BIGINT) AS n_valid FROM per JOIN parts USING (pt) GROUP BY part, class_id""")
def partition_pck(spark, sf_dir):
    """PCK of overlapping joint subsets, for each class as its own data set."""
    kp = T.keypoint_pairs(spark, sf_dir)
    dist = K.normalized_distances(kp, K.const_norm(kp, 0.1))
    names = {"all": (0, 32), "face": (0, 10), "hand": (8, 20)}
    parts = spark.createDataFrame([(n, p) for n, (a, b) in names.items() for p in range(a, b)], "part string, pt int")
    return _round(I.partition_pck(dist, parts, 0.15, ["class_id"]), "pck")


@register("aspect_batches", with_views("det_boxes") + """,
s AS (SELECT det_id, CASE WHEN x2 - x1 < y2 - y1 + 12 THEN 0 ELSE 1 END AS b FROM det_boxes),
r AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY det_id) - 1 AS rn, count(*) OVER (PARTITION BY b) AS n FROM s),
f AS (SELECT det_id, b, rn, rn >= n - n % 64 AS rest FROM r),
g AS (SELECT det_id, CASE WHEN rest THEN 2 ELSE b END AS bucket, CASE WHEN rest THEN row_number() OVER (PARTITION BY rest ORDER BY b, rn) - 1 ELSE rn END AS place FROM f)
SELECT det_id, CAST(bucket AS INT) AS bucket, CAST(place // 64 AS BIGINT) AS batch, CAST(place % 64 AS BIGINT) AS slot FROM g""")
def aspect_batches(spark, sf_dir):
    """K5: batches of 64 boxes of like aspect."""
    d = T.det_boxes(spark, sf_dir).select("det_id", (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1") + 12).alias("h"))
    b = I.aspect_batches(d, "w", "h", [F.col("det_id")], 64)
    return b.select("det_id", "bucket", F.col("batch").cast("long"), F.col("slot").cast("long"))
