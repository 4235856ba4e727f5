"""Instance rows and their scores (P2, P4, P17-P19, P29, P33, J3, A8, A10, A19,
A33, A35, K5).

Long layout as in ``keypoints``: one row per (instance, joint), or one row per
instance or box.  Row-local operators add no shuffle; the others are one
aggregation with map-side combine, or ``running`` where an exact order matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.plans.ordered import running


def clip_instances(df: DataFrame, width: Column, height: Column) -> DataFrame:
    """P2, first half: ``x, y, w, h`` become corners clipped to [0, width-1] x [0, height-1]."""
    def clip(c: Column, most: Column) -> Column:
        return F.least(F.greatest(c, F.lit(0.0)), most - 1)

    return df.withColumns({"x1": clip(F.col("x"), width), "y1": clip(F.col("y"), height),
                           "x2": clip(F.col("x") + F.col("w"), width), "y2": clip(F.col("y") + F.col("h"), height)})


def valid_instances(df: DataFrame, crowd: str = "iscrowd", n_keypoints: str = "num_keypoints",
                    keypoint_max: str = "kp_max") -> DataFrame:
    """P2, second half: no crowd, some keypoint, a box with extent, a positive coordinate."""
    return df.where(~F.col(crowd) & (F.col(n_keypoints) != 0) & (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1"))
                    & (F.col(keypoint_max) > 0))


def drop_low_scores(df: DataFrame, score: str, threshold: float) -> DataFrame:
    """Rows whose box score is at least the threshold; rows without a score stay."""
    return df.where(F.col(score).isNull() | (F.col(score) >= threshold))


def by_image_size(df: DataFrame, width: Column | float, height: Column | float, x: str = "x", y: str = "y") -> DataFrame:
    """Coordinates as shares of the image's width and height."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return df.withColumns({x: F.col(x) / as_col(width), y: F.col(y) / as_col(height)})


def to_common_box(kp: DataFrame, box_scale: float, box_center: tuple[float, float], x: str = "x", y: str = "y") -> DataFrame:
    """A pose moved from its box (``bx1, by1, bx2, by2`` on each row) to one of common size and centre."""
    side = F.greatest(F.col("bx2") - F.col("bx1"), F.col("by2") - F.col("by1"))
    return kp.withColumns({c: (F.col(c) - (F.col(f"b{c}1") + F.col(f"b{c}2")) / 2) / side * box_scale + at
                           for c, at in zip((x, y), box_center, strict=True)})


def center_on_root(kp: DataFrame, root_joints: list[int], inst: str = "sample_id", pt: str = "pt",
                   axes: tuple[str, ...] = ("x", "y"), drop_root: bool = False) -> DataFrame:
    """Joints relative to the mean of the root joints; an instance without any keeps its coordinates."""
    is_root = F.col(pt).isin(root_joints)
    root = kp.groupBy(inst).agg(*[F.coalesce(F.avg(F.when(is_root, F.col(a))), F.lit(0.0)).alias(f"root_{a}") for a in axes])
    out = kp.join(root, inst).withColumns({a: F.col(a) - F.col(f"root_{a}") for a in axes})
    return out.where(~is_root) if drop_root else out


def standardize(kp: DataFrame, by: list[str], axes: tuple[str, ...] = ("x", "y")) -> DataFrame:
    """(value - mean) / population standard deviation of each ``by`` group; 0 where nothing varies."""
    stats = kp.groupBy(*by).agg(*[F.avg(a).alias(f"_m_{a}") for a in axes], *[F.stddev_pop(a).alias(f"_s_{a}") for a in axes])
    z = {a: F.when(F.col(f"_s_{a}") > 0, (F.col(a) - F.col(f"_m_{a}")) / F.col(f"_s_{a}")).otherwise(F.lit(0.0)) for a in axes}
    return kp.join(stats, by).withColumns(z).drop(*[f"_{k}_{a}" for a in axes for k in "ms"])


def pose_scores(joints: DataFrame, inst: list[str], box_score: str, joint_score: str, threshold: float = 0.2) -> DataFrame:
    """The score of an instance in each of the four modes, from one aggregation.

    ``score_bbox_keypoint`` multiplies the box score with the mean of the joint
    scores above the threshold (0 when there is none).
    """
    s, b = F.col(joint_score), F.first(F.col(box_score))
    return joints.groupBy(*inst).agg(
        b.alias("score_bbox"), F.avg(s).alias("score_keypoint"), (b + F.avg(s) + F.max(s)).alias("score_bbox_rle"),
        (b * F.coalesce(F.avg(F.when(s > threshold, s)), F.lit(0.0))).alias("score_bbox_keypoint"))


def largest_box(boxes: DataFrame, group: list[str], id_col: str, score: str = "score", threshold: float = 0.3) -> DataFrame:
    """The box of largest area among those that score above the threshold; ties go to the smaller id."""
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    row = F.struct(id_col, "x1", "y1", "x2", "y2", score)
    best = boxes.where(F.col(score) > threshold).groupBy(*group).agg(F.max_by(row, F.struct(area, -F.col(id_col))).alias("_b"))
    return best.select(*group, "_b.*")


def split_done(todo: DataFrame, done: DataFrame, key: str, overwrite: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows still to do, rows whose output exists); with ``overwrite`` all are to do."""
    if overwrite:
        return todo, todo.limit(0)
    ids = done.select(key).distinct()
    return todo.join(ids, key, "left_anti"), todo.join(ids, key, "left_semi")


def extraction_summary(log: DataFrame, directory: str, status: str = "status", seconds: str = "seconds") -> DataFrame:
    """A10: per directory and overall (null directory): saved, exists, failed, mean seconds of
    the saved images and images a second (0 without time spent)."""
    saved = F.when(F.col(status) == "saved", F.col(seconds))
    n = {s: F.sum((F.col(status) == s).cast("long")).alias(s) for s in ("saved", "exists", "failed")}
    total = F.coalesce(F.sum(saved), F.lit(0.0))
    return log.rollup(directory).agg(*n.values(), F.coalesce(F.avg(saved), F.lit(0.0)).alias("mean_seconds"),
                                     F.when(total > 0, F.count(saved) / total).otherwise(F.lit(0.0)).alias("per_second"))


def first_per_id(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of those with equal keys, the first in ``order`` (an aggregation, so repeats combine early)."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return first.select(*keys, "_r.*")


def regression_errors(df: DataFrame, truth: str, estimate: str) -> DataFrame:
    """RMSE, MAE and R2 (null when the truth doesn't vary)."""
    e = F.col(truth) - F.col(estimate)
    spread = F.var_pop(truth) * F.count(truth)
    return df.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                  F.when(spread > 0, 1 - F.sum(e * e) / spread).alias("r2"))


def binary_scores(df: DataFrame, truth: str, probability: str, eps: float = 1e-15) -> DataFrame:
    """Log loss, and the area under the ROC curve with ties counted half (null for one class).

    Rows are counted by probability first; the ranks run over distinct values.
    """
    p = F.least(F.greatest(F.col(probability), F.lit(eps)), F.lit(1 - eps))
    loss = df.agg((-F.avg(F.when(F.col(truth), F.log(p)).otherwise(F.log(1 - p)))).alias("log_loss"))
    counts = df.groupBy(F.lit(0).alias("_g"), F.col(probability).alias("_p")).agg(
        F.sum(F.col(truth).cast("long")).alias("_pos"), F.sum((~F.col(truth)).cast("long")).alias("_neg"))
    ranked = running(counts, ["_g"], [F.col("_p")], sums={"_below": F.col("_neg")}, rank_col=None)
    pairs = F.sum("_pos") * F.sum("_neg")
    wins = F.sum(F.col("_pos") * (F.col("_below") - F.col("_neg") / 2))
    return ranked.agg(F.when(pairs > 0, wins / pairs).alias("auc")).crossJoin(loss)  # one row each


def multilabel_accuracy(df: DataFrame, inst: str, truth: str, estimate: str, known: str, threshold: float = 0.5) -> DataFrame:
    """Share of instances with every label on the right side, among those with all labels known (0 if none)."""
    right = ((F.col(estimate) - threshold) * (F.col(truth) - threshold)) > 0
    per = df.groupBy(inst).agg(F.min(F.col(known).cast("int")).alias("_known"), F.min(right.cast("int")).alias("_right")).where("_known = 1")
    return per.agg(F.coalesce(F.avg("_right"), F.lit(0.0)).alias("accuracy"), F.count(F.lit(1)).alias("n_valid"))


def partition_pck(dist: DataFrame, parts: DataFrame, threshold: float, by: list[str], pt: str = "pt") -> DataFrame:
    """PCK of each part of the joints (``parts``: part, pt; parts may share joints), for each ``by`` group.

    Hits are counted per joint before the join, which so meets a few rows only.
    """
    per = dist.groupBy(*by, pt).agg(F.count("dist").alias("_n"), F.sum((F.col("dist") < threshold).cast("long")).alias("_hit"))
    acc = F.when(F.col("_n") > 0, F.col("_hit") / F.col("_n"))
    return per.join(parts, pt).groupBy("part", *by).agg(F.coalesce(F.avg(acc), F.lit(0.0)).alias("pck"), F.sum("_n").alias("n_valid"))


def aspect_batches(df: DataFrame, width: str, height: str, order: list[Column], size: int, drop_last: bool = False) -> DataFrame:
    """K5: ``bucket`` (0 tall, 1 wide, 2 what is left of both), ``batch`` and ``slot`` in it, from 0.

    Full batches hold one aspect; the rest of the tall ones, then of the wide
    ones, fill the batches of bucket 2, whose last one may be short or dropped.
    ``order`` must be total.
    """
    shape = df.withColumn("bucket", (F.col(width) >= F.col(height)).cast("int"))
    ranked = running(shape, ["bucket"], order, rank_col="_rn")
    sizes = shape.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"))  # two rows
    full = F.col("_n") - F.col("_n") % size
    tall_left = sizes.agg(F.coalesce(F.sum(F.when(F.col("bucket") == 0, F.col("_n") % size)), F.lit(0)).alias("_tall"),
                          F.coalesce(F.sum(F.col("_n") % size), F.lit(0)).alias("_left"))
    r = ranked.join(sizes, "bucket").crossJoin(tall_left)  # one row
    in_full = F.col("_rn") <= full
    at = F.when(in_full, F.col("_rn") - 1).otherwise(F.col("_rn") - 1 - full + F.when(F.col("bucket") == 1, F.col("_tall")).otherwise(0))
    r = r.withColumns({"_at": at, "_b": F.when(in_full, F.col("bucket")).otherwise(2)})
    if drop_last:
        r = r.where(in_full | (F.col("_at") < F.col("_left") - F.col("_left") % size))
    return (r.withColumns({"bucket": F.col("_b").cast("int"), "batch": F.floor(F.col("_at") / size), "slot": F.col("_at") % size})
            .drop("_rn", "_n", "_tall", "_left", "_at", "_b"))
