"""Queries for landmark features and feature selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import features as feat
from kestrel.operators import selection as sel
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_views
from kestrel.sources import tables as T

_ANGLE_SQL = """SELECT a.sample_id, a.class_id, a.pt AS i, b.pt AS j, c.pt AS k,
  acos(least(greatest(((a.x-b.x)*(c.x-b.x) + (a.y-b.y)*(c.y-b.y)) /
     (sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) * sqrt((c.x-b.x)*(c.x-b.x)+(c.y-b.y)*(c.y-b.y)) + 1e-8),
     -1.0), 1.0)) AS value
  FROM landmarks a JOIN landmarks b ON b.sample_id=a.sample_id AND b.pt>a.pt
  JOIN landmarks c ON c.sample_id=a.sample_id AND c.pt>b.pt"""

_D = "sqrt(({p}.x-{q}.x)*({p}.x-{q}.x)+({p}.y-{q}.y)*({p}.y-{q}.y))"
_RATIO_SQL = f"""SELECT a.sample_id, a.class_id, a.pt AS i, b.pt AS j, c.pt AS k, d.pt AS m,
  {_D.format(p='a', q='b')} / ({_D.format(p='c', q='d')} + 1e-8) AS value
  FROM landmarks a JOIN landmarks b ON b.sample_id=a.sample_id AND b.pt>a.pt
  JOIN landmarks c ON c.sample_id=a.sample_id AND c.pt>b.pt
  JOIN landmarks d ON d.sample_id=a.sample_id AND d.pt>c.pt"""


def _anova_sql(keys: str) -> str:
    return f""",
g AS (SELECT {keys}, class_id, count(value) AS n_, avg(value) AS mu_, var_pop(value) AS v_ FROM vals GROUP BY {keys}, class_id),
g2 AS (SELECT *, sum(n_*mu_) OVER (PARTITION BY {keys}) / sum(n_) OVER (PARTITION BY {keys}) AS grand FROM g),
s AS (SELECT {keys}, sum(n_) AS nn, count(*) AS kk, sum(n_*(mu_-grand)*(mu_-grand)) AS ssb, sum(n_*v_) AS ssw
      FROM g2 GROUP BY {keys}),
f AS (SELECT {keys}, CASE WHEN kk<2 OR nn<=kk THEN 0.0 WHEN ssw=0 THEN
        (CASE WHEN ssb>0 THEN 1.7976931348623157e308 ELSE 0.0 END)
        ELSE (ssb/(kk-1))/(ssw/(nn-kk)) END AS f_score FROM s)
"""


def _top_sql(keys: list[str], n: int) -> str:
    k = ", ".join(keys)
    cast = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in keys)
    return f"""SELECT CAST(row_number() OVER (ORDER BY f_score DESC, {k}) AS BIGINT) AS rank, {cast},
  round(f_score, 6) AS f_score FROM f ORDER BY f_score DESC, {k} LIMIT {n}"""


def _top(f, keys, n):
    best = sel.top_n(f, n, [F.col("f_score").desc()] + [F.col(c) for c in keys])
    return best.select(F.col("rank").cast("long"), *[F.col(c).cast("long") for c in keys],
                       F.round("f_score", 6).alias("f_score"))


def anova_angles_top(spark, sf_dir, n=20):
    lm = T.landmarks(spark, sf_dir)
    f = sel.anova_f(feat.all_angles_long(lm), ["i", "j", "k"])
    return _top(f, ["i", "j", "k"], n)


register("anova_angle_top20", with_views("landmarks") + f", vals AS ({_ANGLE_SQL})"
         + _anova_sql("i, j, k") + _top_sql(["i", "j", "k"], 20))(anova_angles_top)


@register("anova_ratio_top20", with_views("landmarks") + f", vals AS ({_RATIO_SQL})"
          + _anova_sql("i, j, k, m") + _top_sql(["i", "j", "k", "m"], 20))
def anova_ratios_top(spark, sf_dir, n=20):
    lm = T.landmarks(spark, sf_dir)
    f = sel.anova_f(feat.all_ratios_long(lm, moments="class_id"), ["i", "j", "k", "m"], moments=True)
    return _top(f, ["i", "j", "k", "m"], n)


@register("center_distances", with_views("landmarks") + """,
c AS (SELECT sample_id, avg(x) AS cx, avg(y) AS cy FROM landmarks GROUP BY sample_id)
SELECT l.sample_id, CAST(l.pt AS BIGINT) AS pt,
  round(sqrt((l.x-c.cx)*(l.x-c.cx)+(l.y-c.cy)*(l.y-c.cy)), 6) AS center_dist
FROM landmarks l JOIN c USING (sample_id)""")
def center_distances(spark, sf_dir):
    lm = T.landmarks(spark, sf_dir)
    return lm.select("sample_id", F.posexplode(feat.center_distances()).alias("pt", "d")) \
             .select("sample_id", F.col("pt").cast("long"), F.round("d", 6).alias("center_dist"))


@register("pairwise_distance_stats", with_views("landmarks") + """
SELECT CAST(a.pt AS BIGINT) AS i, CAST(b.pt AS BIGINT) AS j,
  round(avg(sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y))), 6) AS mean_dist,
  round(max(sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y))), 6) AS max_dist
FROM landmarks a JOIN landmarks b ON a.sample_id=b.sample_id AND b.pt>a.pt GROUP BY a.pt, b.pt""")
def pairwise_distance_stats(spark, sf_dir):
    """P24 per sample, then per-pair mean and max over all samples."""
    long = feat.all_pairs_long(T.landmarks(spark, sf_dir))
    return long.groupBy("i", "j").agg(F.round(F.avg("value"), 6).alias("mean_dist"),
                                      F.round(F.max("value"), 6).alias("max_dist")) \
               .select(F.col("i").cast("long"), F.col("j").cast("long"), "mean_dist", "max_dist")


@register("sample_per_class", with_views("landmarks") + """,
s AS (SELECT DISTINCT sample_id, class_id FROM landmarks),
r AS (SELECT sample_id, class_id, row_number() OVER (PARTITION BY class_id
        ORDER BY md5(concat('42','-',CAST(sample_id AS VARCHAR))), sample_id) AS draw FROM s)
SELECT sample_id, CAST(class_id AS BIGINT) AS class_id, CAST(draw AS BIGINT) AS draw FROM r WHERE draw <= 20""")
def sample_per_class(spark, sf_dir, n=20):
    lm = T.landmarks(spark, sf_dir).select("sample_id", "class_id")
    out = sel.sample_per_class(lm, n)
    return out.select("sample_id", F.col("class_id").cast("long"), F.col("draw").cast("long"))


@register("feature_vectors_selected")
def feature_vectors_selected(spark, sf_dir, n_angles=20, n_ratios=20):
    """P27 end to end: A2 selects triplets/quadruplets, then every sample is
    assembled into [center distances, angles, ratios].  The selected lists are
    bounded by the requested sizes, so they travel as literal parameters."""
    ang = [(r.i, r.j, r.k) for r in anova_angles_top(spark, sf_dir, n_angles).collect()]
    rat = [(r.i, r.j, r.k, r.m) for r in anova_ratios_top(spark, sf_dir, n_ratios).collect()]
    lm = T.landmarks(spark, sf_dir)
    out = feat.feature_vector(lm, ang, rat)
    return out.select("sample_id", "class_id", F.size("features").alias("n_features"),
                      F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("feature_sum"))


_CFG_SQL = (with_views("landmarks") + f", vals AS ({_ANGLE_SQL})" + _anova_sql("i, j, k")
            + ", ta AS (" + _top_sql(["i", "j", "k"], 20) + ")"
            + f", vals2 AS ({_RATIO_SQL})" + _anova_sql("i, j, k, m").replace("g AS (", "g_r AS (", 1)
            .replace("FROM g)", "FROM g_r)").replace("g2 AS", "g2_r AS").replace("FROM g2 ", "FROM g2_r ")
            .replace("s AS (", "s_r AS (", 1).replace("FROM s)", "FROM s_r)").replace("f AS (", "f_r AS (", 1)
            .replace("FROM vals ", "FROM vals2 ")
            + ", tr AS (" + _top_sql(["i", "j", "k", "m"], 20).replace("FROM f ", "FROM f_r ") + ")\n"
            + """SELECT 'angle_triplets' AS kind, CAST(rank AS INTEGER) AS rank, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,
  CAST(k AS INTEGER) AS k, CAST(NULL AS INTEGER) AS m, f_score FROM ta
UNION ALL SELECT 'ratio_quadruplets', CAST(rank AS INTEGER), CAST(i AS INTEGER), CAST(j AS INTEGER), CAST(k AS INTEGER),
  CAST(m AS INTEGER), f_score FROM tr""")


@register("feature_config_roundtrip", _CFG_SQL)
def feature_config_roundtrip(spark, sf_dir):
    """The selected triplets and quadruplets written as the sectioned text
    config and parsed back (ranks, indices, F scores)."""
    import uuid

    from kestrel.session import checkpoint_dir
    from kestrel.sources.config_text import read_feature_config, write_feature_config
    ang = anova_angles_top(spark, sf_dir).select("rank", F.array("i", "j", "k").cast("array<int>").alias("idx"),
                                                 "f_score")
    rat = anova_ratios_top(spark, sf_dir).select("rank", F.array("i", "j", "k", "m").cast("array<int>").alias("idx"),
                                                 "f_score")
    path = f"{checkpoint_dir(spark).rstrip('/')}/feature-config-{uuid.uuid4().hex}"
    write_feature_config({"angle_triplets": ang, "ratio_quadruplets": rat}, path)
    c = read_feature_config(spark, path)
    return c.select("kind", "rank", *[F.get("idx", n).alias(c) for n, c in enumerate("ijkm")],
                    F.round("f_score", 6).alias("f_score"))
