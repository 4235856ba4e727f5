"""Classification splits and evaluation.

Metrics are built from confusion counts, one ``groupBy`` with map-side
partial aggregation, so their cost is one pass over the predictions and
the shuffled state is at most classes x classes rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.selection import seeded_key
from kestrel.plans.ordered import running


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """A1: rows per label."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def stratified_split(df: DataFrame, label: str, id_col: str, test_size: float = 0.2,
                     val_size: float = 0.3, seed: int = 42) -> DataFrame:
    """K2: per class, test = ceil(n*test), val = ceil((n-test) * val/(1-test)), rest train.

    Rows are ranked inside their class by a seeded hash (exact, skew-safe
    ranking from ``running``); the class sizes come from one aggregation.
    """
    val_ratio = val_size / (1.0 - test_size)
    ranked = running(df, [label], [seeded_key(id_col, seed), F.col(id_col)], rank_col="_rank")
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    n_test = F.ceil(F.col("_n") * F.lit(test_size))
    n_val = F.ceil((F.col("_n") - n_test) * F.lit(val_ratio))
    split = (F.when(F.col("_rank") <= n_test, F.lit("test"))
              .when(F.col("_rank") <= n_test + n_val, F.lit("val"))
              .otherwise(F.lit("train")))
    return ranked.join(n, label).withColumn("split", split).drop("_rank", "_n")


def split_manifest(df: DataFrame, path_col: str, label: str) -> DataFrame:
    """``file_path, emotion, split`` rows; write with ``.write.csv(header=True)``."""
    return df.select(F.col(path_col).alias("file_path"), F.col(label).alias("emotion"), "split")


def accuracy_by(df: DataFrame, keys: list[str], label: str = "label", pred: str = "pred") -> DataFrame:
    """A3: mean of (pred = label) per key group."""
    return df.groupBy(*keys).agg(F.avg((F.col(pred) == F.col(label)).cast("double")).alias("accuracy"),
                                 F.count(F.lit(1)).alias("n"))


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "pred", keys=()) -> DataFrame:
    return df.groupBy(*keys, F.col(label).alias("true_label"), F.col(pred).alias("pred_label")) \
             .agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """A5: full class x class grid (rows true, columns predicted) with zeros kept.

    The class list is the distinct labels and predictions, gathered into one
    array of at most #classes values, so the grid holds #classes^2 rows.
    """
    counts = confusion_counts(df, label, pred)
    classes = df.select(F.col(label).alias("c")).union(df.select(F.col(pred).alias("c"))) \
                .agg(F.array_sort(F.collect_set("c")).alias("cs"))
    grid = classes.select(F.explode("cs").alias("true_label"), "cs") \
                  .select("true_label", F.explode("cs").alias("pred_label"))
    return grid.join(counts, ["true_label", "pred_label"], "left") \
               .select("true_label", "pred_label", F.coalesce("n", F.lit(0)).alias("n"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """A4: precision, recall, F1, support per class plus macro and weighted
    averages (zero division -> 0).  Classes = labels or predictions present."""
    cc = confusion_counts(df, label, pred)
    tp = cc.where(F.col("true_label") == F.col("pred_label")).select(F.col("true_label").alias("cls"), F.col("n").alias("tp"))
    sup = cc.groupBy(F.col("true_label").alias("cls")).agg(F.sum("n").alias("support"))
    pc = cc.groupBy(F.col("pred_label").alias("cls")).agg(F.sum("n").alias("predicted"))
    per = sup.join(pc, "cls", "full").join(tp, "cls", "left").fillna(0, ["tp", "support", "predicted"])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.withColumn("precision", prec).withColumn("recall", rec)
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                         .otherwise(F.lit(0.0)))
    per = per.select(F.col("cls").cast("string").alias("cls"), "precision", "recall", "f1",
                     F.col("support").cast("long").alias("support"))
    avg = per.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
        F.sum("support").alias("s"))
    macro = avg.select(F.lit("macro avg").alias("cls"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                       F.col("mf").alias("f1"), F.col("s").alias("support"))
    weighted = avg.select(F.lit("weighted avg").alias("cls"), F.col("wp").alias("precision"),
                          F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("s").alias("support"))
    return per.unionByName(macro).unionByName(weighted)


def confidence_gate(df: DataFrame, pred: str = "pred", confidence: str = "confidence",
                    max_prob: str | None = None, threshold: float = 0.3) -> DataFrame:
    """When confidence < thr and the best class probability < thr, the
    prediction becomes 'none' with the best probability as confidence."""
    mp = F.col(max_prob) if max_prob else F.col(confidence)
    low = (F.col(confidence) < threshold) & (mp < threshold)
    return df.withColumn("is_none", low) \
             .withColumn("gated_pred", F.when(low, F.lit("none")).otherwise(F.col(pred).cast("string"))) \
             .withColumn("gated_confidence", F.when(low, mp).otherwise(F.col(confidence)))


def batch_summary(df: DataFrame, image: str, is_none: str = "is_none", times=()) -> DataFrame:
    """Images, images with any 'none' prediction (each counted once),
    valid images and the mean of each timing column."""
    per_image = df.groupBy(image).agg(F.max(F.col(is_none).cast("int")).alias("_none"),
                                      *[F.avg(t).alias(t) for t in times])
    return per_image.agg(F.count(F.lit(1)).alias("images"), F.sum("_none").alias("none_images"),
                         (F.count(F.lit(1)) - F.sum("_none")).alias("valid_images"),
                         *[F.avg(t).alias(f"mean_{t}") for t in times])


def leaderboard(scored: DataFrame, model: str = "model", split: str = "split", label: str = "label",
                pred: str = "pred") -> DataFrame:
    """Accuracy per model and split in columns, best model first by
    validation then test accuracy (name breaks ties)."""
    acc = scored.groupBy(model).pivot(split, ["train", "val", "test"]).agg(
        F.avg((F.col(pred) == F.col(label)).cast("double")))
    acc = acc.select(model, *[F.coalesce(F.col(s), F.lit(0.0)).alias(f"{s}_acc") for s in ("train", "val", "test")])
    w = Window.orderBy(F.col("val_acc").desc(), F.col("test_acc").desc(), F.col(model))
    return acc.withColumn("position", F.row_number().over(w))
