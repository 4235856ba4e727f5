"""Classifiers over an array<double> feature column: encoding, learners, trials (M1, M3, M4).

A *learner* names a ``pyspark.ml`` estimator over the columns ``features``
(vector) and ``label`` (double), and the settings that its trials try.  Boosters
that Spark lacks are replaced by gradient-boosted trees, one class against the
rest.  ``Probabilities`` gives every fitted model one output, an array of class
probabilities, so that models of any kind can be averaged and stacked.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression, NaiveBayes, OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import StandardScaler, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Learner:
    name: str
    estimator: Estimator
    #: Settings of the trials, as {parameter: value}; the estimator's own settings are the first trial.
    trials: tuple[dict, ...] = field(default=())


def learners(seed: int = 42, excluded: Iterable[str] = (), trees: int = 20, depth: int = 5, trials: int = 1) -> list[Learner]:
    """M1: the classifiers to fit, without the ``excluded`` names; each is tried with up to ``trials`` settings."""
    def forest(impurity: str) -> Estimator:
        return RandomForestClassifier(numTrees=trees, maxDepth=depth, impurity=impurity, seed=seed)

    more = tuple({"maxDepth": d} for d in (depth - 2, depth + 2, depth - 1, depth + 1) if 0 < d <= 30)
    every = [
        Learner("bayes", NaiveBayes(modelType="gaussian")),
        Learner("tree", DecisionTreeClassifier(maxDepth=depth, seed=seed), more),
        Learner("forest_gini", forest("gini"), more),
        Learner("forest_entropy", forest("entropy"), more),
        Learner("logistic", LogisticRegression(maxIter=50, regParam=0.01), tuple({"regParam": r} for r in (0.001, 0.1, 0.0001, 1.0))),
        Learner("boosted", OneVsRest(classifier=GBTClassifier(maxIter=trees, maxDepth=min(depth, 5), seed=seed))),
    ]
    left = set(excluded)
    return [Learner(x.name, x.estimator, x.trials[:max(0, trials - 1)]) for x in every if x.name not in left]


class Encoding:
    """M4: classes as numbers (by their text, ascending) and features scaled to mean 0 and standard deviation 1, fitted on a table.

    Rows of a null label or features, or of a class that the fit did not see, are
    left out when labels are asked for.
    """

    def __init__(self, train: DataFrame, features: str = "features", label: str = "label"):
        self.features, self.label = features, label
        stages = [StringIndexer(inputCol="_label", outputCol="_index", stringOrderType="alphabetAsc", handleInvalid="skip"),
                  StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True)]
        rows = train.where(F.col(label).isNotNull() & F.col(features).isNotNull())
        self.model: PipelineModel = Pipeline(stages=stages).fit(rows.select(F.col(label).cast("string").alias("_label"), array_to_vector(features).alias("_raw")))
        self.classes: list[str] = list(self.model.stages[0].labels)
        self.scaler = self.model.stages[1]

    def scaled(self, table: DataFrame) -> DataFrame:
        """``table`` with ``features`` as a scaled vector; rows without features go."""
        other = [c for c in table.columns if c != self.features]
        raw = table.where(F.col(self.features).isNotNull()).withColumn("_raw", array_to_vector(self.features))
        return self.scaler.transform(raw).select(*other, F.col("_scaled").alias("features"))

    def encoded(self, table: DataFrame) -> DataFrame:
        """``scaled`` with ``label`` as the class's number, the class's own value kept as ``class``."""
        named = self.scaled(table).withColumn("class", F.col(self.label).cast("string")).where(F.col("class").isin(self.classes))
        index = F.array_position(F.array(*[F.lit(c) for c in self.classes]), F.col("class")) - 1
        return named.drop(self.label).withColumn("label", index.cast("double"))


def _softmax(raw: Column) -> Column:
    e = F.transform(raw, lambda x: F.exp(x - F.array_max(raw)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def with_probabilities(model: Model, table: DataFrame, out: str) -> DataFrame:
    """``table`` with the model's class probabilities as the array<double> ``out``.

    A model without probabilities (one class against the rest) gives the softmax
    of its margins.
    """
    scored = model.transform(table)
    p = vector_to_array("probability") if "probability" in scored.columns else _softmax(vector_to_array("rawPrediction"))
    return scored.select(*[F.col(f"`{c}`") for c in table.columns], p.alias(out))


def likeliest(p: Column) -> Column:
    """Number of the class of the highest probability, the first of equal ones."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


@dataclass
class Trial:
    learner: str
    settings: dict
    accuracy: float


def tried(learner: Learner, train: DataFrame, tuning: DataFrame) -> tuple[Estimator, list[Trial]]:
    """M3: the learner's estimator with the settings whose fit on ``train`` scores best on ``tuning``; the first of equal ones."""
    estimator, settings = learner.estimator, [{}, *learner.trials]
    if len(settings) == 1:
        return estimator, []
    maps = [{estimator.getParam(k): v for k, v in s.items()} for s in settings]
    trials = []
    for k, model in sorted(estimator.fitMultiple(train, maps), key=lambda x: x[0]):
        right = with_probabilities(model, tuning, "_p").agg(F.avg((likeliest(F.col("_p")) == F.col("label")).cast("double"))).first()[0]
        trials.append(Trial(learner.name, settings[k], right or 0.0))
    best = max(range(len(trials)), key=lambda k: (trials[k].accuracy, -k))
    return estimator.copy(maps[best]), trials
