"""Pose error after the best similarity transform of each sample (A31, Procrustes)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMS = ("x", "y", "z")


def similarity_aligned(p: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Points p (n, joints, d) turned, scaled and moved to lie closest to g, sample by sample; never mirrored.

    Of a sample whose points are all one, that point goes to the middle of g.
    """
    mp, mg = p.mean(1, keepdims=True), g.mean(1, keepdims=True)
    a, b = p - mp, g - mg
    u, s, vt = np.linalg.svd(np.swapaxes(a, 1, 2) @ b)
    flip = np.ones_like(s)
    flip[:, -1] = np.where(np.linalg.det(u @ vt) < 0, -1.0, 1.0)
    size = (a * a).sum((1, 2))
    scale = np.divide((s * flip).sum(1), size, out=np.zeros_like(size), where=size > 0)
    return scale[:, None, None] * (a @ ((u * flip[:, None, :]) @ vt)) + mg


def procrustes_errors(kp: DataFrame, inst: str = "sample_id", joint: str = "pt", keep: tuple[str, ...] = ()) -> DataFrame:
    """inst, ``keep``, joint, error: distance of each visible joint after its sample is aligned over all its joints.

    Long rows gx, gy (gz), px, py (pz), visible; a sample's joints, a bounded
    number, meet in one row.  A sample with a null coordinate takes no part.
    """
    dims = [d for d in DIMS if f"g{d}" in kp.columns]
    cells = F.sort_array(F.collect_list(F.struct(joint, *[f"g{d}" for d in dims], *[f"p{d}" for d in dims], "visible")))
    rows = kp.groupBy(inst, *keep).agg(cells.alias("j"))
    whole = ~F.exists("j", lambda j: sum((j[f"{s}{d}"].isNull().cast("int") for s in "gp" for d in dims), F.lit(0)) > 0)

    @F.pandas_udf("array<double>")
    def errors(g: pd.Series, p: pd.Series) -> pd.Series:
        out: list = [None] * len(g)
        sizes = np.array([len(x) for x in g])
        for n in np.unique(sizes):  # samples of as many joints in one call
            at = np.flatnonzero(sizes == n)
            a, b = (np.stack(s.iloc[at].to_list()).reshape(len(at), -1, len(dims)) for s in (p, g))
            for i, e in zip(at, np.linalg.norm(similarity_aligned(a, b) - b, axis=2), strict=True):
                out[i] = e
        return pd.Series(out)

    made = rows.where(whole).select(inst, *keep, "j", errors(_flat("g", dims), _flat("p", dims)).alias("e"))
    each = made.select(inst, *keep, F.explode(F.arrays_zip(F.col(f"j.{joint}").alias("joint"), F.col("j.visible").alias("visible"), "e")).alias("r"))
    return each.where("r.visible").select(inst, *keep, F.col("r.joint").alias(joint), F.col("r.e").alias("error"))


def _flat(side: str, dims: list[str]):
    return F.flatten(F.transform("j", lambda j: F.array(*[j[f"{side}{d}"] for d in dims])))


def procrustes_mpjpe(kp: DataFrame, inst: str = "sample_id", joint: str = "pt", by: tuple[str, ...] = ()) -> DataFrame:
    """P-MPJPE, overall or per group of ``by``: mean error of the visible joints after alignment."""
    return procrustes_errors(kp, inst, joint, by).groupBy(*by).agg(F.avg("error").alias("mpjpe"))
