"""Stacked models: folds, out-of-fold rows, ensemble weights, importance."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kestrel.learning import importance as imp
from kestrel.learning import stacking as st
from kestrel.learning.models import Encoding, Learner, learners, tried, with_probabilities


@pytest.fixture(scope="module")
def samples(spark):
    """Three classes that feature 0 tells apart; features 1 and 2 say nothing."""
    rng = random.Random(5)
    rows = [(i, "abc"[i % 3], [i % 3 * 4 + rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1)]) for i in range(240)]
    return spark.createDataFrame(rows, "sample_id long, label string, features array<double>").cache()


@pytest.fixture(scope="module")
def fitted(samples):
    two = [Learner("bayes", NaiveBayes(modelType="gaussian")), Learner("tree", DecisionTreeClassifier(maxDepth=3, seed=1), ({"maxDepth": 1},))]
    return st.fit_stack(samples.where("sample_id % 4 != 0"), samples.where("sample_id % 8 = 0"), two, folds=3, steps=6)


class Spy:
    """An estimator whose models are sure of class 0 for the rows that they were fitted on, and of class 1 for others."""

    def __init__(self, seen=None):
        self.seen = seen

    def fit(self, table):
        return Spy([r.sample_id for r in table.select("sample_id").collect()])

    def transform(self, table):
        known = F.col("sample_id").isin(self.seen)
        return table.withColumn("probability", array_to_vector(F.when(known, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0)))))


def test_no_row_is_scored_by_a_model_that_saw_it(samples):
    stack, held_out = st.fit_stack(samples.where("sample_id % 4 != 0"), samples.where("sample_id % 8 = 0"), [Learner("spy", Spy())], folds=4, steps=1)
    assert [list(r.p_spy) for r in held_out.select("p_spy").distinct().collect()] == [[0.0, 1.0]] and held_out.count() == 180
    seen = [set(m.seen) for m in stack.bags["spy"]]
    assert len(set.union(*seen)) == 180 and all(sum(i in s for s in seen) == 3 for i in set.union(*seen))
    # rows outside the fit have the mean over the fold models, rows of it don't come out as out-of-fold ones
    new = stack.probabilities(samples.where("sample_id % 4 = 0")).select("p_spy").distinct().collect()
    assert [list(r.p_spy) for r in new] == [[0.0, 1.0]]
    old = stack.probabilities(samples.where("sample_id % 4 != 0")).select("p_spy").distinct().collect()
    assert [list(r.p_spy) for r in old] == [[0.75, 0.25]]


def test_folds_are_those_of_the_id(spark):
    ids = spark.range(1000).select(F.col("id").alias("sample_id"))
    sizes = {r.fold: r["count"] for r in ids.groupBy(st.fold_of("sample_id", 8).alias("fold")).count().collect()}
    assert set(sizes) == set(range(8)) and min(sizes.values()) > 80
    assert ids.repartition(3).withColumn("f", st.fold_of("sample_id", 8)).agg(F.sum(F.col("f") * F.col("sample_id"))).first() == \
        ids.withColumn("f", st.fold_of("sample_id", 8)).agg(F.sum(F.col("f") * F.col("sample_id"))).first()


def test_stack(samples, fitted):
    stack, held_out = fitted
    assert stack.names == ["bayes", "tree", "stacked", "ensemble"] and [len(m) for m in stack.bags.values()] == [3, 3]
    assert [t.settings for t in stack.trials] == [{}, {"maxDepth": 1}]
    assert abs(sum(stack.weights.values()) - 1) < 1e-12
    assert held_out.count() == 180 and held_out.where(F.size("p_stacked") != 3).count() == 0
    rest = samples.where("sample_id % 4 = 0")
    scored = st.score_all(stack, rest, ("sample_id", "label")).collect()
    assert len(scored) == 4 * 60
    for name in stack.names:
        mine = {r.sample_id: r for r in scored if r.model == name}
        assert sum(r.pred == r.label for r in mine.values()) > 50
        assert all(abs(sum(r.probabilities.values()) - 1) < 1e-9 and abs(r.confidence - max(r.probabilities.values())) < 1e-12 for r in mine.values())
        one = {r.sample_id: r for r in st.score(stack, rest, name).collect()}
        assert all(one[i].pred == r.pred for i, r in mine.items())
    # the bag is the mean of its models, the ensemble the weighted mean of the models
    p = {r.sample_id: r for r in stack.probabilities(rest).collect()}
    for r in p.values():
        want = sum(w * np.array(r[f"p_{m}"]) for m, w in stack.weights.items())
        assert np.allclose(want, r["p_ensemble"])
    with pytest.raises(ValueError):
        st.score(stack, rest, "none such")


def test_reruns_agree(samples):
    two = [Learner("tree", DecisionTreeClassifier(maxDepth=3, seed=1))]
    runs = [st.fit_stack(samples.where("sample_id % 4 != 0").repartition(k), samples.where("sample_id % 8 = 0"), two, folds=2, steps=2)[0] for k in (1, 3)]
    a, b = ({r.sample_id: r.pred for r in st.score(s, samples).collect()} for s in runs)
    assert a == b


def test_rows_without_label_or_features(spark, samples, fitted):
    stack, _ = fitted
    odd = spark.createDataFrame([(900, "a", None), (901, None, [0.0, 0.0, 0.0]), (902, "never seen", [8.0, 0.0, 0.0])], samples.schema)
    got = {r.sample_id: r.pred for r in st.score(stack, odd).collect()}
    assert set(got) == {901, 902} and got[902] == "c"  # scored whatever the label; no features, no row
    assert stack.encoding.encoded(odd).count() == 0
    assert st.score(stack, samples.limit(0)).count() == 0


def test_ensemble_weights_by_hand(spark):
    rng = np.random.default_rng(1)
    label = rng.integers(0, 3, 60)
    p = {n: rng.dirichlet(np.ones(3), 60) for n in "xyz"}
    for n in "xy":
        p[n][np.arange(60), label] += rng.uniform(0, 0.6, 60)
    table = spark.createDataFrame([(float(label[i]), *[[float(v) for v in p[n][i]] for n in "xyz"]) for i in range(60)],
                                  "label double, p_x array<double>, p_y array<double>, p_z array<double>")
    chosen, best = [], (-1, [])
    for _ in range(8):
        scores = [float((sum(p[m] for m in [*chosen, n]).argmax(1) == label).mean()) for n in "xyz"]
        k = int(np.argmax(scores))
        chosen = [*chosen, "xyz"[k]]
        best = max(best, (scores[k], chosen), key=lambda b: b[0])
        if len(best[1]) + 5 <= len(chosen):
            break
    assert st.ensemble_weights(table, list("xyz"), 8) == {n: best[1].count(n) / len(best[1]) for n in "xyz" if n in best[1]}


def test_trials_choose_by_the_tuning_rows(samples):
    enc = Encoding(samples)
    rows = enc.encoded(samples).cache()
    learner = Learner("tree", DecisionTreeClassifier(maxDepth=1, seed=1), ({"maxDepth": 4}, {"maxDepth": 2}))
    estimator, trials = tried(learner, rows, rows)
    best = max(range(3), key=lambda k: (trials[k].accuracy, -k))
    assert estimator.getMaxDepth() == [1, 4, 2][best] and trials[best].accuracy > trials[0].accuracy
    assert {x.name for x in learners(excluded=("boosted",))} == {"bayes", "tree", "forest_gini", "forest_entropy", "logistic"}
    assert all(len(x.trials) <= 4 for x in learners(trials=5))


def test_margins_become_probabilities(samples):
    enc = Encoding(samples)
    rows = enc.encoded(samples).cache()
    (boosted,) = [x for x in learners(trees=2, depth=2) if x.name == "boosted"]
    scored = with_probabilities(boosted.estimator.fit(rows), rows, "p").collect()
    assert all(abs(sum(r.p) - 1) < 1e-9 for r in scored)
    assert np.mean([np.argmax(r.p) == r.label for r in scored]) > 0.8


def test_permuted_columns(samples):
    got = imp.permuted(samples.select("sample_id", "features")).collect()
    real = {r.sample_id: r.features for r in samples.collect()}
    for f in range(3):
        mine = {r.sample_id: r.value for r in got if r.feature == f}
        assert set(mine) == set(real) and sorted(mine.values()) == sorted(v[f] for v in real.values())
        assert sum(mine[i] == real[i][f] for i in real) < 20
    assert len({tuple(r.value for r in sorted((x for x in got if x.feature == 0), key=lambda x: x.sample_id))}) == 1


def test_importance_finds_the_feature_that_counts(samples, fitted):
    stack, _ = fitted
    got = imp.permutation_importance(samples, imp.model_accuracy(stack, "bayes"), sample=100, top=2).collect()
    assert [r["rank"] for r in got] == [1, 2] and got[0].feature == 0 and got[0].importance > 0.3 and abs(got[1].importance) < 0.1
    # by hand, with the same sample and the same shuffled columns
    rows = imp.seeded_sample(samples, 100)
    real = {r.sample_id: (r.label, list(r.features)) for r in rows.collect()}
    swapped = {r.sample_id: r.value for r in imp.permuted(rows).where("feature = 0").collect()}
    spark = samples.sparkSession

    def accuracy(features):
        table = spark.createDataFrame([(i, v[0], features(i, v[1])) for i, v in real.items()], samples.schema)
        return st.score(stack, table, "bayes", ("label",)).agg(F.avg((F.col("pred") == F.col("label")).cast("double"))).first()[0]

    lost = accuracy(lambda i, v: v) - accuracy(lambda i, v: [swapped[i], *v[1:]])
    assert abs(lost - got[0].importance) < 1e-12


def test_leaderboard_with_times(samples, fitted):
    stack, _ = fitted
    board = samples.sparkSession.createDataFrame([(n, i) for i, n in enumerate(stack.names)], "model string, position int")
    got = st.timed_leaderboard(stack, samples.limit(20), board).collect()
    assert {r.model for r in got} == set(stack.names) and all(r.fit_seconds > 0 and r.infer_ms > 0 for r in got)
