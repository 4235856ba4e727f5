"""Queries for splits and classification evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import classification as C
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_views
from kestrel.sources import tables as T

TEST, VAL = 0.2, 0.3
VAL_RATIO = VAL / (1.0 - TEST)

_SPLIT_SQL = with_views("predictions") + f""",
r AS (SELECT sample_id, label, pred, confidence, row_number() OVER (PARTITION BY label
        ORDER BY md5(concat('42','-',CAST(sample_id AS VARCHAR))), sample_id) AS rk,
        count(*) OVER (PARTITION BY label) AS n FROM predictions),
s AS (SELECT *, ceil(n*{TEST!r}) AS nt FROM r),
split AS (SELECT sample_id, label, pred, confidence,
  CASE WHEN rk <= nt THEN 'test' WHEN rk <= nt + ceil((n-nt)*{VAL_RATIO!r}) THEN 'val' ELSE 'train' END AS split FROM s)
"""


def _split(spark, sf_dir):
    return C.stratified_split(T.predictions(spark, sf_dir), "label", "sample_id", TEST, VAL)


@register("label_distribution", with_views("predictions")
          + "SELECT label, count(*) AS n FROM predictions GROUP BY label")
def label_distribution(spark, sf_dir):
    return C.label_distribution(T.predictions(spark, sf_dir), "label")


@register("stratified_split", _SPLIT_SQL + "SELECT sample_id, label, split FROM split")
def stratified_split(spark, sf_dir):
    return _split(spark, sf_dir).select("sample_id", "label", "split")


@register("split_sizes", _SPLIT_SQL + "SELECT label, split, count(*) AS n FROM split GROUP BY label, split")
def split_sizes(spark, sf_dir):
    return _split(spark, sf_dir).groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


@register("accuracy_by_split_class", _SPLIT_SQL + """
SELECT split, label, round(avg(CASE WHEN pred=label THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n
FROM split GROUP BY split, label""")
def accuracy_by_split_class(spark, sf_dir):
    a = C.accuracy_by(_split(spark, sf_dir), ["split", "label"])
    return a.select("split", "label", F.round("accuracy", 6).alias("accuracy"), "n")


@register("accuracy_by_split", _SPLIT_SQL + """
SELECT split, round(avg(CASE WHEN pred=label THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n
FROM split GROUP BY split""")
def accuracy_by_split(spark, sf_dir):
    a = C.accuracy_by(_split(spark, sf_dir), ["split"])
    return a.select("split", F.round("accuracy", 6).alias("accuracy"), "n")


@register("confusion_matrix", with_views("predictions") + """,
cls AS (SELECT DISTINCT c FROM (SELECT label AS c FROM predictions UNION ALL SELECT pred FROM predictions)),
cnt AS (SELECT label AS true_label, pred AS pred_label, count(*) AS n FROM predictions GROUP BY 1, 2)
SELECT a.c AS true_label, b.c AS pred_label, coalesce(cnt.n, 0) AS n
FROM cls a JOIN cls b ON TRUE LEFT JOIN cnt ON cnt.true_label=a.c AND cnt.pred_label=b.c""")
def confusion_matrix(spark, sf_dir):
    return C.confusion_matrix(T.predictions(spark, sf_dir))


@register("classification_report", with_views("predictions") + """,
cnt AS (SELECT label AS t, pred AS p, count(*) AS n FROM predictions GROUP BY 1, 2),
sup AS (SELECT t AS cls, sum(n) AS support FROM cnt GROUP BY t),
pc AS (SELECT p AS cls, sum(n) AS predicted FROM cnt GROUP BY p),
tp AS (SELECT t AS cls, n AS tp FROM cnt WHERE t = p),
per0 AS (SELECT coalesce(sup.cls, pc.cls) AS cls, coalesce(support, 0) AS support,
                coalesce(predicted, 0) AS predicted FROM sup FULL JOIN pc ON sup.cls = pc.cls),
per1 AS (SELECT per0.*, coalesce(tp.tp, 0) AS tp FROM per0 LEFT JOIN tp ON per0.cls = tp.cls),
per2 AS (SELECT cls, support, CASE WHEN predicted>0 THEN tp/predicted ELSE 0.0 END AS precision,
                CASE WHEN support>0 THEN tp/support ELSE 0.0 END AS recall FROM per1),
per AS (SELECT CAST(cls AS VARCHAR) AS cls, precision, recall,
               CASE WHEN precision+recall>0 THEN 2*precision*recall/(precision+recall) ELSE 0.0 END AS f1,
               CAST(support AS BIGINT) AS support FROM per2),
allr AS (SELECT * FROM per UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per UNION ALL
  SELECT 'weighted avg', sum(precision*support)/sum(support), sum(recall*support)/sum(support),
         sum(f1*support)/sum(support), CAST(sum(support) AS BIGINT) FROM per)
SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM allr""")
def classification_report(spark, sf_dir):
    r = C.classification_report(T.predictions(spark, sf_dir))
    return r.select("cls", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                    F.col("support").cast("long"))


@register("confidence_gate", with_views("predictions") + """
SELECT sample_id, confidence < 0.3 AS is_none,
  CASE WHEN confidence < 0.3 THEN 'none' ELSE CAST(pred AS VARCHAR) END AS gated_pred,
  round(confidence, 6) AS gated_confidence FROM predictions""")
def confidence_gate(spark, sf_dir):
    g = C.confidence_gate(T.predictions(spark, sf_dir), threshold=0.3)
    return g.select("sample_id", "is_none", "gated_pred", F.round("gated_confidence", 6).alias("gated_confidence"))


@register("batch_summary", with_views("predictions") + """,
img AS (SELECT sample_id % 100 AS image_id, max(CASE WHEN confidence < 0.3 THEN 1 ELSE 0 END) AS none_flag,
        avg(confidence) AS conf FROM predictions GROUP BY 1)
SELECT count(*) AS images, CAST(sum(none_flag) AS BIGINT) AS none_images,
       CAST(count(*) - sum(none_flag) AS BIGINT) AS valid_images, round(avg(conf), 6) AS mean_conf FROM img""")
def batch_summary(spark, sf_dir):
    """A9 with every 100th sample id grouped as one image holding several faces."""
    g = C.confidence_gate(T.predictions(spark, sf_dir), threshold=0.3) \
         .withColumn("image_id", F.col("sample_id") % 100).withColumn("conf", F.col("confidence"))
    s = C.batch_summary(g, "image_id", times=("conf",))
    return s.select("images", F.col("none_images").cast("long"), F.col("valid_images").cast("long"),
                    F.round("mean_conf", 6).alias("mean_conf"))


@register("model_leaderboard", _SPLIT_SQL + """,
m AS (SELECT 'quarter' AS model, split, label, pred FROM split UNION ALL SELECT 'constant', split, label, 3 FROM split
  UNION ALL SELECT 'tenth', split, label, CASE WHEN sample_id % 10 = 0 THEN (label + 1) % 10 ELSE label END FROM split),
a AS (SELECT model, coalesce(avg(CAST(pred = label AS INT)) FILTER (split = 'train'), 0) AS t, coalesce(avg(CAST(pred = label AS INT)) FILTER (split = 'val'), 0) AS v,
  coalesce(avg(CAST(pred = label AS INT)) FILTER (split = 'test'), 0) AS e FROM m GROUP BY model)
SELECT model, round(t, 6) AS train_acc, round(v, 6) AS val_acc, round(e, 6) AS test_acc, row_number() OVER (ORDER BY v DESC, e DESC, model) AS position FROM a""")
def model_leaderboard(spark, sf_dir):
    """Three prediction sets ranked by validation, then test accuracy."""
    s, wrong = _split(spark, sf_dir), (F.col("label") + 1) % 10
    models = {"quarter": F.col("pred"), "constant": F.lit(3), "tenth": F.when(F.col("sample_id") % 10 == 0, wrong).otherwise(F.col("label"))}
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), p.cast("long").alias("pred")) for n, p in models.items()]))
    board = C.leaderboard(s.select("split", "label", named.alias("m")).select("split", "label", "m.*"))
    return board.select("model", *[F.round(c, 6).alias(c) for c in ("train_acc", "val_acc", "test_acc")], "position")
