"""Keypoint evaluation and transforms.

Long layout: one row per (instance, keypoint) with ground truth ``gx, gy``,
prediction ``px, py`` and a boolean mask ``visible``.  Per-joint and
per-instance results are ``groupBy`` aggregations (partial aggregation on
the map side), so a joint or an instance that is over-represented costs no
extra shuffle; the per-instance normalizers are one aggregation joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NP_SPACING_1 = 2.220446049250313e-16  # numpy spacing(1), the OKS area guard


def instance_bbox(kp: DataFrame, inst: str = "sample_id", x: str = "gx", y: str = "gy",
                  visible: str | None = None) -> DataFrame:
    """P20: pseudo box of the (visible) keypoints of each instance: x1, y1, x2, y2."""
    src = kp if visible is None else kp.where(F.col(visible))
    return src.groupBy(inst).agg(F.min(x).alias("bx1"), F.min(y).alias("by1"),
                                 F.max(x).alias("bx2"), F.max(y).alias("by2"))


def instance_root(kp: DataFrame, inst: str = "sample_id", x: str = "gx", y: str = "gy",
                  visible: str = "visible", root_type: str = "kpt_center") -> DataFrame:
    """P20: root = mean of visible keypoints (kpt_center) or box centre
    (bbox_center); an instance without visible keypoints gets root (0, 0)
    and ``root_visible`` false."""
    v = F.col(visible)
    if root_type == "kpt_center":
        rx, ry = F.avg(F.when(v, F.col(x))), F.avg(F.when(v, F.col(y)))
    else:
        rx = (F.min(F.when(v, F.col(x))) + F.max(F.when(v, F.col(x)))) / 2
        ry = (F.min(F.when(v, F.col(y))) + F.max(F.when(v, F.col(y)))) / 2
    return kp.groupBy(inst).agg(F.coalesce(rx, F.lit(0.0)).alias("root_x"), F.coalesce(ry, F.lit(0.0)).alias("root_y"),
                                F.max(v.cast("int")).cast("boolean").alias("root_visible"))


def normalized_distances(kp: DataFrame, norm: DataFrame, inst: str = "sample_id") -> DataFrame:
    """Distance per (instance, joint) with per-axis normalizers ``nx, ny``.

    As the reference: an instance with a zero normalizer is masked out;
    a negative one becomes 1e6.  Masked rows get NULL distance.
    """
    j = kp.join(norm, inst)
    nx = F.when(F.col("nx") <= 0, F.lit(1e6)).otherwise(F.col("nx"))
    ny = F.when(F.col("ny") <= 0, F.lit(1e6)).otherwise(F.col("ny"))
    ok = F.col("visible") & (F.col("nx") != 0) & (F.col("ny") != 0)
    dx = (F.col("px") - F.col("gx")) / nx
    dy = (F.col("py") - F.col("gy")) / ny
    return j.withColumn("dist", F.when(ok, F.sqrt(dx * dx + dy * dy)))


def bbox_norm(kp: DataFrame, inst: str = "sample_id") -> DataFrame:
    """Normalizer = max(box w, box h) of the ground-truth keypoint box, both axes."""
    b = instance_bbox(kp, inst)
    m = F.greatest(F.col("bx2") - F.col("bx1"), F.col("by2") - F.col("by1"))
    return b.select(inst, m.alias("nx"), m.alias("ny"))


def pair_norm(kp: DataFrame, i: int, j: int, inst: str = "sample_id", pt: str = "pt") -> DataFrame:
    """Normalizer = distance between ground-truth keypoints i and j (e.g. the eye corners)."""
    a = kp.where(F.col(pt) == i).select(inst, F.col("gx").alias("ax"), F.col("gy").alias("ay"))
    b = kp.where(F.col(pt) == j).select(inst, F.col("gx").alias("bx"), F.col("gy").alias("by"))
    dx, dy = F.col("ax") - F.col("bx"), F.col("ay") - F.col("by")
    d = F.sqrt(dx * dx + dy * dy)
    return a.join(b, inst).select(inst, d.alias("nx"), d.alias("ny"))


def const_norm(kp: DataFrame, value: float, inst: str = "sample_id") -> DataFrame:
    return kp.select(inst).distinct().select(inst, F.lit(float(value)).alias("nx"), F.lit(float(value)).alias("ny"))


def pck(dist: DataFrame, thr: float, pt: str = "pt") -> tuple[DataFrame, DataFrame]:
    """Per-joint accuracy (share of valid distances < thr) and the mean
    over joints that have any valid distance (0 when none)."""
    per = dist.groupBy(pt).agg(F.count("dist").alias("n_valid"),
                               F.sum((F.col("dist") < thr).cast("long")).alias("n_hit"))
    per = per.withColumn("acc", F.when(F.col("n_valid") > 0, F.col("n_hit") / F.col("n_valid")))
    summary = per.agg(F.coalesce(F.avg("acc"), F.lit(0.0)).alias("pck"), F.count("acc").alias("n_joints"))
    return per, summary


def grouped_pck(dist: DataFrame, groups: dict[str, list[int]], thr: float, pt: str = "pt", inclusive: bool = False) -> DataFrame:
    """(name, pck): the mean of the joint accuracies of each group of joints, and ``PCK``, weighted by how often a joint is valid.

    ``inclusive`` counts distances up to and with ``thr``.  A joint in no group
    counts for nothing; a group without a valid joint has 0.
    """
    hit = F.col("dist") <= thr if inclusive else F.col("dist") < thr
    per = dist.groupBy(pt).agg(F.count("dist").alias("n"), F.sum(hit.cast("long")).alias("h")).where("n > 0")
    names = F.array(*[F.struct(F.lit(k).alias("name"), F.array(*[F.lit(j) for j in v]).alias("joints")) for k, v in groups.items()])
    of = per.withColumn("g", F.explode(F.filter(names, lambda g: F.array_contains(g["joints"], F.col(pt).cast("int")))))  # joints x groups rows
    by_group = of.groupBy(F.col("g.name").alias("name")).agg(F.avg(F.col("h") / F.col("n")).alias("pck"))
    known = dist.sparkSession.createDataFrame([(k,) for k in groups], "name string")
    whole = of.select(pt, "h", "n").distinct().agg(F.lit("PCK").alias("name"), (F.sum("h") / F.sum("n")).alias("pck"))
    return known.join(by_group, "name", "left").unionByName(whole.select("name", "pck")).select("name", F.coalesce("pck", F.lit(0.0)).alias("pck"))


def auc(dist: DataFrame, num_thrs: int = 20, pt: str = "pt") -> DataFrame:
    """Mean over thresholds i/num_thrs of the joint-averaged PCK (strict <).

    One aggregation computes every threshold's hit count per joint.
    """
    thrs = [i / num_thrs for i in range(num_thrs)]
    per = dist.groupBy(pt).agg(F.count("dist").alias("n_valid"),
                               *[F.sum((F.col("dist") < t).cast("long")).alias(f"h{i}") for i, t in enumerate(thrs)])
    valid = per.where(F.col("n_valid") > 0)
    accs = [F.coalesce(F.avg(F.col(f"h{i}") / F.col("n_valid")), F.lit(0.0)) for i in range(num_thrs)]
    total = accs[0]
    for a in accs[1:]:
        total = total + a
    return valid.agg((total / num_thrs).alias("auc"))


def mean_error(dist: DataFrame) -> DataFrame:
    """Sum of valid distances / max(1, count) (NME with a normalizer, EPE without)."""
    return dist.agg((F.coalesce(F.sum("dist"), F.lit(0.0)) / F.greatest(F.count("dist"), F.lit(1))).alias("error"))


def mpjpe(kp: DataFrame, inst: str = "sample_id", alignment: str = "none", by=()) -> DataFrame:
    """A31 for 2-D or 3-D joints (``gz``/``pz`` used when present).

    alignment none: mean visible-joint error; scale: each prediction scaled
    by sum(p.g)/sum(p.p) over all its joints first (N-MPJPE).
    """
    dims = [d for d in ("x", "y", "z") if f"g{d}" in kp.columns]
    k = kp
    if alignment == "scale":
        pg = sum(F.col(f"p{d}") * F.col(f"g{d}") for d in dims)
        pp = sum(F.col(f"p{d}") * F.col(f"p{d}") for d in dims)
        s = kp.groupBy(inst).agg((F.sum(pg) / F.sum(pp)).alias("_s"))
        k = kp.join(s, inst)
        for d in dims:
            k = k.withColumn(f"p{d}", F.col(f"p{d}") * F.col("_s"))
    elif alignment != "none":
        raise ValueError("alignment must be none or scale (procrustes: alignment.procrustes_mpjpe)")
    err = F.sqrt(sum((F.col(f"p{d}") - F.col(f"g{d}")) * (F.col(f"p{d}") - F.col(f"g{d}")) for d in dims))
    return k.where(F.col("visible")).groupBy(*by).agg(F.avg(err).alias("mpjpe"))


def oks(kp: DataFrame, inst: str = "sample_id", sigma: Column | float = 0.05,
        vis_thr: bool = False) -> DataFrame:
    """J10 for aligned pairs (ground truth vs prediction of the same instance):
    mean over joints of exp(-d^2 / (2 sigma)^2 / ((a_g + a_p)/2 + eps) / 2),
    areas = keypoint-box areas.  ``vis_thr`` averages over visible joints only;
    an instance without one has similarity 0."""
    g = instance_bbox(kp, inst, "gx", "gy").select(inst, ((F.col("bx2") - F.col("bx1")) * (F.col("by2") - F.col("by1"))).alias("ag"))
    p = instance_bbox(kp, inst, "px", "py").select(inst, ((F.col("bx2") - F.col("bx1")) * (F.col("by2") - F.col("by1"))).alias("ap"))
    s = sigma if isinstance(sigma, Column) else F.lit(float(sigma))
    var = (s * 2) * (s * 2)
    dx, dy = F.col("px") - F.col("gx"), F.col("py") - F.col("gy")
    d2 = dx * dx + dy * dy
    e = d2 / var / ((F.col("ag") + F.col("ap")) / 2 + NP_SPACING_1) / 2
    j = kp.join(g, inst).join(p, inst)
    term = F.when(F.col("visible"), F.exp(-e)) if vis_thr else F.exp(-e)
    return j.groupBy(inst).agg(F.coalesce(F.avg(term), F.lit(0.0)).alias("oks"))


def clip_border(kp: DataFrame, width: float, height: float, x: str = "gx", y: str = "gy",
                visible: str = "visible") -> DataFrame:
    """Keypoints outside [0, w] x [0, h] become invisible."""
    outside = (F.col(x) < 0) | (F.col(x) > width) | (F.col(y) < 0) | (F.col(y) > height)
    return kp.withColumn(visible, F.col(visible) & ~outside)


def face_box(kp: DataFrame, width: Column, height: Column, margin: float = 20.0,
             inst: str = "sample_id", x: str = "gx", y: str = "gy") -> DataFrame:
    """min/max of the landmarks with a margin, clamped to the image."""
    b = instance_bbox(kp, inst, x, y)
    return b.select(inst, F.greatest(F.col("bx1") - margin, F.lit(0.0)).alias("fx1"),
                    F.greatest(F.col("by1") - margin, F.lit(0.0)).alias("fy1"),
                    F.least(F.col("bx2") + margin, width).alias("fx2"),
                    F.least(F.col("by2") + margin, height).alias("fy2"))
