"""Queries for fitting, stacking, scoring and explaining classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.learning import importance as imp
from kestrel.learning import stacking as st
from kestrel.learning.models import Encoding, Learner, learners
from kestrel.operators import classification as C
from kestrel.operators import features as feat
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_views
from kestrel.sources import tables as T

FOLDS = 8


def _samples(spark, sf_dir):
    """One row per sample: sample_id, label, features (distances of the landmarks to their centre), split."""
    rows = T.landmarks(spark, sf_dir).select("sample_id", F.col("class_id").alias("label"), feat.center_distances().alias("features"))
    return C.stratified_split(rows, "label", "sample_id")


_DIST = with_views("landmarks") + """,
c AS (SELECT sample_id, avg(x) AS cx, avg(y) AS cy FROM landmarks GROUP BY sample_id),
d AS (SELECT l.sample_id, l.class_id AS label, l.pt, sqrt((l.x-c.cx)*(l.x-c.cx)+(l.y-c.cy)*(l.y-c.cy)) AS v FROM landmarks l JOIN c USING (sample_id)),
ids AS (SELECT DISTINCT sample_id, label FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat('42-', sample_id)), sample_id) AS rk, count(*) OVER (PARTITION BY label) AS n FROM ids),
split AS (SELECT sample_id, label, CASE WHEN rk <= ceil(n*0.2) THEN 'test' WHEN rk <= ceil(n*0.2) + ceil((n-ceil(n*0.2))*(0.3/(1.0-0.2))) THEN 'val' ELSE 'train' END AS split FROM r),
fold AS (SELECT *, CAST(concat('0x', substr(md5(concat('42-', sample_id)), 1, 7)) AS BIGINT) % 8 AS fold FROM split),
classes AS (SELECT label, row_number() OVER (ORDER BY CAST(label AS VARCHAR)) - 1 AS idx FROM (SELECT DISTINCT label FROM split WHERE split = 'train')),
moments AS (SELECT pt, avg(v) AS m, stddev_samp(v) AS s FROM d JOIN fold USING (sample_id) WHERE split = 'train' GROUP BY pt),
scaled AS (SELECT sample_id, pt, CASE WHEN s = 0 THEN 0 ELSE (v - m) / s END AS z FROM d JOIN moments USING (pt))
"""


@register("encoded_features", _DIST + """
SELECT sample_id, CAST(idx AS DOUBLE) AS label, round(sum(z), 6) AS z_sum, round(max(z), 6) AS z_max, round(min(z), 6) AS z_min
FROM scaled JOIN fold USING (sample_id) JOIN classes ON classes.label = fold.label GROUP BY sample_id, idx""")
def encoded_features(spark, sf_dir):
    """M4: classes as numbers, features scaled by the train split's moments."""
    from pyspark.ml.functions import vector_to_array

    rows = _samples(spark, sf_dir)
    z = vector_to_array("features")
    return Encoding(rows.where("split = 'train'")).encoded(rows).select(
        "sample_id", "label", F.round(F.aggregate(z, F.lit(0.0), lambda a, x: a + x), 6).alias("z_sum"), F.round(F.array_max(z), 6).alias("z_max"),
        F.round(F.array_min(z), 6).alias("z_min"))


@register("out_of_fold_bayes", _DIST + """,
t AS (SELECT f.sample_id, f.fold, c.idx, s.pt, s.z FROM scaled s JOIN fold f USING (sample_id) JOIN classes c ON c.label = f.label WHERE split = 'train'),
folds AS (SELECT unnest(range(8)) AS k),
spread AS (SELECT k, max(v) * 1e-9 AS eps FROM (SELECT k, pt, var_pop(z) AS v FROM t JOIN folds ON t.fold != k GROUP BY k, pt) GROUP BY k),
g AS (SELECT k, idx, pt, avg(z) AS m, var_pop(z) + min(eps) AS v FROM t JOIN folds ON t.fold != k JOIN spread USING (k) GROUP BY k, idx, pt),
prior AS (SELECT k, idx, ln(count(*)) - ln(sum(count(*)) OVER (PARTITION BY k)) AS p FROM t JOIN folds ON t.fold != k WHERE pt = 0 GROUP BY k, idx),
lik AS (SELECT t.sample_id, t.fold, t.idx AS truth, g.idx, sum(-0.5 * (ln(2 * pi() * g.v) + (t.z - g.m) * (t.z - g.m) / g.v)) AS l
        FROM t JOIN g ON g.k = t.fold AND g.pt = t.pt GROUP BY ALL),
post AS (SELECT sample_id, fold, truth, lik.idx, l + p AS s, max(l + p) OVER (PARTITION BY sample_id) AS top FROM lik JOIN prior ON prior.k = lik.fold AND prior.idx = lik.idx),
probs AS (SELECT sample_id, fold, truth, idx, exp(s - top) / sum(exp(s - top)) OVER (PARTITION BY sample_id) AS p FROM post)
SELECT sample_id, CAST(fold AS INTEGER) AS fold, CAST(truth AS DOUBLE) AS label, round(max(p), 5) AS confidence, CAST(arg_max(idx, p) AS INTEGER) AS pred
FROM probs GROUP BY sample_id, fold, truth""")
def out_of_fold_bayes(spark, sf_dir):
    """M2's out-of-fold probabilities, by the one learner that SQL can follow: no row is scored by a model that saw it."""
    rows = _samples(spark, sf_dir).where("split = 'train'")
    encoded = Encoding(rows).encoded(rows).select("sample_id", "label", "features").persist()
    fold = st.fold_of("sample_id", FOLDS)
    (bayes,) = [x for x in learners() if x.name == "bayes"]
    bags = {"bayes": [bayes.estimator.fit(encoded.where(fold != k)) for k in range(FOLDS)]}
    return st.out_of_fold(encoded, bags, fold).select(
        "sample_id", fold.alias("fold"), "label", F.round(F.array_max("p_bayes"), 5).alias("confidence"), st.likeliest(F.col("p_bayes")).alias("pred"))


def _learners() -> list[Learner]:
    """Fast ones: boosted trees and a second forest are left out by name."""
    return learners(excluded=("boosted", "forest_entropy", "logistic"), trees=10, depth=4)


def _stack(spark, sf_dir):
    rows = _samples(spark, sf_dir).persist()
    stack, held_out = st.fit_stack(rows.where("split = 'train'"), rows.where("split = 'val'"), _learners(), folds=FOLDS)
    return rows, stack, held_out


@register("stacked_scores")
def stacked_scores(spark, sf_dir):
    """Every model's verdict on every sample outside the fit, gated by confidence."""
    rows, stack, _ = _stack(spark, sf_dir)
    scored = st.score_all(stack, rows.where("split != 'train'"), ("sample_id", "label", "split"))
    gated = C.confidence_gate(scored, threshold=0.3)
    return gated.select("sample_id", "split", "model", "label", "pred", F.round("confidence", 6).alias("confidence"), "gated_pred", "is_none",
                        F.size("probabilities").alias("n_classes"))


@register("stacked_leaderboard")
def stacked_leaderboard(spark, sf_dir):
    """A6 over fitted models: train accuracy is the out-of-fold one for bagged models and the meta model."""
    rows, stack, held_out = _stack(spark, sf_dir)
    classes = F.array(*[F.lit(c) for c in stack.encoding.classes])
    seen = [n for n in stack.names if f"p_{n}" in held_out.columns]
    train = held_out.select(F.lit("train").alias("split"), F.col("class").alias("label"), F.explode(F.array(*[
        F.struct(F.lit(n).alias("model"), F.get(classes, st.likeliest(F.col(f"p_{n}"))).alias("pred")) for n in seen])).alias("m")).select("split", "label", "m.*")
    rest = st.score_all(stack, rows.where("split != 'train'"), ("label", "split")).select("split", F.col("label").cast("string").alias("label"), "model", "pred")
    board = C.leaderboard(train.unionByName(rest))
    return board.select("model", *[F.round(f"{s}_acc", 6).alias(f"{s}_acc") for s in ("train", "val", "test")], "position")


@register("permuted_features", _DIST + """,
base AS (SELECT sample_id, row_number() OVER (ORDER BY md5(concat('42-', sample_id)), sample_id) AS rank FROM ids),
drawn AS (SELECT pt, v, row_number() OVER (PARTITION BY pt ORDER BY md5(concat('42-', pt, '-', sample_id)), sample_id) AS rank FROM d)
SELECT CAST(pt AS INTEGER) AS feature, sample_id, round(v, 6) AS value FROM base JOIN drawn USING (rank)""")
def permuted_features(spark, sf_dir):
    """A7's shuffled columns, all of them."""
    return imp.permuted(_samples(spark, sf_dir).select("sample_id", "features")).select("feature", "sample_id", F.round("value", 6).alias("value"))


@register("permutation_importance_top20")
def permutation_importance_top20(spark, sf_dir):
    """Accuracy that the best model loses on test rows for each feature."""
    rows, stack, _ = _stack(spark, sf_dir)
    out = imp.permutation_importance(rows.where("split = 'test'"), imp.model_accuracy(stack, stack.best))
    return out.select("rank", "feature", F.round("importance", 6).alias("importance"))
