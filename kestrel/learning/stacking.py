"""Bagged models, one stack level and an ensemble weighted on a holdout.

Rows fall into ``folds`` by a hash of their id.  Every learner is fitted once per
fold on the rows of the others; a row's *out-of-fold* probabilities come from the
one model that has not seen it.  The meta model is fitted on these.  For rows
outside the fit a learner's probabilities are the mean over its fold models.

All learners score one pass over the table, as a column each: there is no join of
predictions and no shuffle but those of the fits themselves.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.learning.models import Encoding, Learner, Trial, likeliest, tried, with_probabilities
from kestrel.operators.selection import seeded_key
from kestrel.session import cut_lineage

META, ENSEMBLE = "stacked", "ensemble"


def fold_of(id_col: str, folds: int, seed: int = 42) -> Column:
    """Fold 0..folds-1 of a row by its id alone: the first 7 hex digits of its seeded key."""
    return (F.conv(F.substring(seeded_key(id_col, seed), 1, 7), 16, 10).cast("long") % folds).cast("int")


def _mean(arrays: list[Column]) -> Column:
    total = arrays[0]
    for a in arrays[1:]:
        total = F.zip_with(total, a, lambda x, y: x + y)
    return F.transform(total, lambda x: x / len(arrays))


def _weighted(arrays: list[tuple[Column, float]]) -> Column:
    def times(a: Column, w: float) -> Column:
        return F.transform(a, lambda x: x * w)

    parts = [times(a, w) for a, w in arrays]
    total = parts[0]
    for a in parts[1:]:
        total = F.zip_with(total, a, lambda x, y: x + y)
    return total


@dataclass
class Stack:
    """Fitted models: per learner one for each fold, the meta model, and the ensemble's weights."""

    encoding: Encoding
    bags: dict[str, list[Model]]
    meta: Model | None = None
    weights: dict[str, float] = field(default_factory=dict)
    trials: list[Trial] = field(default_factory=list)
    seconds: dict[str, float] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [*self.bags, *([META] if self.meta else []), *([ENSEMBLE] if self.weights else [])]

    @property
    def best(self) -> str:
        return ENSEMBLE if self.weights else META if self.meta else next(iter(self.bags))

    def _stacked(self, table: DataFrame) -> DataFrame:
        joined = table.withColumn("features", array_to_vector(F.concat(*[F.col(f"p_{m}") for m in self.bags])))
        out = with_probabilities(self.meta, joined, f"p_{META}").drop("features")
        return out

    def scaled_probabilities(self, table: DataFrame) -> DataFrame:
        """``table`` (with a scaled vector ``features``) with the array ``p_<model>`` of every model in place of the features."""
        out = table
        for name, models in self.bags.items():
            parts = [f"_{name}_{k}" for k in range(len(models))]
            for part, model in zip(parts, models, strict=True):
                out = with_probabilities(model, out, part)
            out = out.withColumn(f"p_{name}", _mean([F.col(p) for p in parts])).drop(*parts)
        out = out.drop("features")
        if self.meta:
            out = self._stacked(out)
        if self.weights:
            out = out.withColumn(f"p_{ENSEMBLE}", _weighted([(F.col(f"p_{m}"), w) for m, w in self.weights.items()]))
        return out

    def probabilities(self, table: DataFrame) -> DataFrame:
        return self.scaled_probabilities(self.encoding.scaled(table))


def out_of_fold(encoded: DataFrame, bags: dict[str, list[Model]], fold: Column) -> DataFrame:
    """``p_<learner>`` of every row from the model of its own fold, which was fitted without it."""
    parts = None
    for k in range(len(next(iter(bags.values())))):
        part = encoded.where(fold == k)
        for name, models in bags.items():
            part = with_probabilities(models[k], part, f"p_{name}")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def _in_threads(spark, jobs: list, at_once: int) -> list:
    """Fits of different models share the cluster: each thread keeps its session's properties."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(j)) for j in jobs]]


def ensemble_weights(holdout: DataFrame, names: list[str], steps: int = 25) -> dict[str, float]:
    """Greedy choice with replacement: the model that lifts the mean's accuracy most joins, ``steps`` times; the best mean's shares are returned.

    ``holdout`` has ``label`` and ``p_<name>``.  A step is one aggregate over it,
    for all candidates at once.  Ties go to the earlier name, and to fewer steps.
    """
    arrays = {n: F.col(f"p_{n}") for n in names}
    chosen: list[str] = []
    best: tuple[float, list[str]] = (-1.0, [])
    for _ in range(steps):
        tries = [[*chosen, n] for n in names]
        sums = [_weighted([(arrays[m], float(t.count(m))) for m in dict.fromkeys(t)]) for t in tries]
        row = holdout.agg(*[F.avg((likeliest(s) == F.col("label")).cast("double")).alias(f"a{i}") for i, s in enumerate(sums)]).first()
        scores = [row[f"a{i}"] or 0.0 for i in range(len(names))]
        k = max(range(len(names)), key=lambda i: (scores[i], -i))
        chosen = tries[k]
        if scores[k] > best[0]:
            best = (scores[k], chosen)
        if len(best[1]) + 5 <= len(chosen):  # five steps without a gain
            break
    return {n: best[1].count(n) / len(best[1]) for n in names if n in best[1]}


def fit_stack(train: DataFrame, holdout: DataFrame, learners: list[Learner], features: str = "features", label: str = "label", id_col: str = "sample_id",
              folds: int = 8, seed: int = 42, steps: int = 25, at_once: int = 4) -> tuple[Stack, DataFrame]:
    """(stack, out-of-fold probabilities of ``train``).

    ``holdout`` chooses the settings of trials and the ensemble's weights, never a
    model's parameters.  Rows without label or features take no part; every fold
    must leave rows of at least one class to fit on.
    """
    encoding = Encoding(train, features, label)
    fold = fold_of(id_col, folds, seed)
    rows = cut_lineage(encoding.encoded(train).select(id_col, "class", "label", "features"))
    tuning = cut_lineage(encoding.encoded(holdout).select(id_col, "class", "label", "features"))
    parts = [rows.where(fold != k) for k in range(folds)]
    bags, trials, seconds = {}, [], {}
    for learner in learners:
        began = time.monotonic()
        estimator, tries = tried(learner, rows, tuning)
        trials += tries
        bags[learner.name] = _in_threads(train.sparkSession, [lambda part=part, e=estimator: e.fit(part) for part in parts], at_once)
        seconds[learner.name] = time.monotonic() - began
    stack = Stack(encoding, bags, trials=trials, seconds=seconds)
    began = time.monotonic()
    held_out = cut_lineage(out_of_fold(rows, bags, fold).drop("features"))
    joined = held_out.withColumn("features", array_to_vector(F.concat(*[F.col(f"p_{m}") for m in bags])))
    stack.meta = LogisticRegression(maxIter=50, regParam=0.01).fit(joined.select("label", "features"))
    seconds[META] = time.monotonic() - began
    began = time.monotonic()
    scored = cut_lineage(stack.scaled_probabilities(tuning))
    stack.weights = ensemble_weights(scored, list(stack.names), steps)
    seconds[ENSEMBLE] = time.monotonic() - began
    return stack, stack._stacked(held_out)


def score(stack: Stack, table: DataFrame, model: str | None = None, keep: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """M5: ``keep``, pred (the class's text), confidence and probabilities (map class -> probability) by one model, the best unless named."""
    name = model or stack.best
    if name not in stack.names:
        raise ValueError(f"no model {name!r}: {', '.join(stack.names)}")
    return _labelled(stack, stack.probabilities(table).select(*keep, F.col(f"p_{name}").alias("p")))


def _labelled(stack: Stack, rows: DataFrame) -> DataFrame:
    classes = F.array(*[F.lit(c) for c in stack.encoding.classes])
    other = [c for c in rows.columns if c != "p"]
    return rows.select(*other, F.get(classes, likeliest(F.col("p"))).alias("pred"), F.array_max("p").alias("confidence"),
                       F.map_from_arrays(classes, F.col("p")).alias("probabilities"))


def score_all(stack: Stack, table: DataFrame, keep: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """``score`` by every model, a row for each model and sample, in one pass over the table."""
    scored = stack.probabilities(table)
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"p_{n}").alias("p")) for n in stack.names]))
    return _labelled(stack, scored.select(*keep, each.alias("m")).select(*keep, "m.model", "m.p"))


def timed_leaderboard(stack: Stack, table: DataFrame, board: DataFrame, model: str = "model") -> DataFrame:
    """``board`` with each model's fit seconds and its scoring milliseconds a row of ``table``."""
    rows = max(1, table.count())
    times = []
    for name in stack.names:
        began = time.monotonic()
        score(stack, table, name, ()).agg(F.max("confidence")).first()
        times.append((name, stack.seconds[name], (time.monotonic() - began) * 1000 / rows))
    spark = board.sparkSession
    return board.join(spark.createDataFrame(times, f"{model} string, fit_seconds double, infer_ms double"), model, "left")  # a row a model
