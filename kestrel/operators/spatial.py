"""Point-cloud operators: voxels, scatter, kNN, ball query, three-NN
interpolation, Chamfer distance, furthest point sampling
(A37, A38, J11-J13, J16, K8).

Points: ``cloud_id, pt_id, x, y, z`` (+ features).  "Index order" of the
reference is ``pt_id`` order inside a cloud.  Neighbour searches never pair
every point with every point of its cloud: points are bucketed into grid
cells and a query meets only the cells around it.  kNN widens the ring of
cells until the k-th distance is certified (no unseen point can be closer),
so the answer is exact while the work stays proportional to local density.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from kestrel.operators.blocks import BLOCK, codes, crowded, first_of, meet, nearest, numbers, within
from kestrel.operators.features import spread
from kestrel.operators.selection import top_n_per_group
from kestrel.plans.ordered import running
from kestrel.session import cut_lineage

XYZ = ("x", "y", "z")


# ---- voxels (A37, A38) -------------------------------------------------------

def voxel_coords(points: DataFrame, size: tuple[float, float, float],
                 lo: tuple[float, float, float], hi: tuple[float, float, float]) -> DataFrame:
    """A37 dynamic mode: ``vz, vy, vx`` (reversed, as stored by the reference) =
    floor((p - lo) / size); points outside the grid get -1 in all three."""
    grid = [int(round((h - l) / s)) for l, h, s in zip(lo, hi, size)]
    c = [F.floor((F.col(a) - lo[i]) / size[i]) for i, a in enumerate(XYZ)]
    inside = None
    for i in range(3):
        t = (c[i] >= 0) & (c[i] < grid[i])
        inside = t if inside is None else inside & t
    out = points
    for i, name in ((2, "vz"), (1, "vy"), (0, "vx")):
        out = out.withColumn(name, F.when(inside, c[i]).otherwise(F.lit(-1)).cast("long"))
    return out


def hard_voxels(points: DataFrame, size, lo, hi, max_points: int = 35, max_voxels: int = 20000,
                cloud: str = "cloud_id", pid: str = "pt_id") -> DataFrame:
    """A37 hard mode: per cloud, voxels numbered by their first point (index
    order); only the first ``max_voxels`` voxels and the first ``max_points``
    points of each voxel are kept.  Output: points with ``voxel_no`` and ``slot``."""
    v = voxel_coords(points, size, lo, hi).where(F.col("vx") >= 0)
    first = v.groupBy(cloud, "vz", "vy", "vx").agg(F.min(pid).alias("_first"))
    first = running(first, [cloud], [F.col("_first")], rank_col="voxel_no")
    first = first.where(F.col("voxel_no") <= max_voxels).drop("_first")
    v = v.join(first, [cloud, "vz", "vy", "vx"])
    v = running(v, [cloud, "voxel_no"], [F.col(pid)], rank_col="slot")
    return v.where(F.col("slot") <= max_points)


def dynamic_scatter(vox: DataFrame, feats: list[str], reduce: str = "max",
                    cloud: str = "cloud_id") -> DataFrame:
    """Reduce features per voxel (max / sum / mean); out-of-grid points dropped."""
    fn = {"max": F.max, "sum": F.sum, "mean": F.avg}[reduce]
    return vox.where(F.col("vx") >= 0).groupBy(cloud, "vz", "vy", "vx").agg(
        *[fn(f).alias(f"{reduce}_{f}") for f in feats], F.count(F.lit(1)).alias("n_points"))


# ---- neighbour search --------------------------------------------------------

def _cell(col: str, cell: float):
    return F.floor(F.col(col) / cell).cast("long")


def _ring_candidates(q: DataFrame, p: DataFrame, key: str, cell: float, ring: int) -> DataFrame:
    offs = F.sequence(F.lit(-ring), F.lit(ring))
    q = spread(q)  # the (2r+1)^3 expansion must not run in the few tasks of a small input
    qc = (q.withColumn("_ox", F.explode(offs)).withColumn("_oy", F.explode(offs)).withColumn("_oz", F.explode(offs))
           .withColumn("_cx", _cell("qx", cell) + F.col("_ox")).withColumn("_cy", _cell("qy", cell) + F.col("_oy"))
           .withColumn("_cz", _cell("qz", cell) + F.col("_oz")).drop("_ox", "_oy", "_oz"))
    pc = p.withColumn("_cx", _cell("x", cell)).withColumn("_cy", _cell("y", cell)).withColumn("_cz", _cell("z", cell))
    j = qc.join(pc, [key, "_cx", "_cy", "_cz"]).drop("_cx", "_cy", "_cz")
    d2 = sum((F.col(f"q{a}") - F.col(a)) * (F.col(f"q{a}") - F.col(a)) for a in XYZ)
    return j.withColumn("d2", d2)


def _margin2(cell: float, ring: int):
    """Squared distance from the query to the faces of the searched cube."""
    m = None
    for a in XYZ:
        c = F.floor(F.col(f"q{a}") / cell)
        lo = F.col(f"q{a}") - (c - ring) * cell
        hi = (c + ring + 1) * cell - F.col(f"q{a}")
        t = F.least(lo, hi)
        m = t if m is None else F.least(m, t)
    return m * m


def _crowded(points: DataFrame, key: str) -> DataFrame | None:
    """Keys of the groups of more points than a task takes whole, if there are any."""
    big = _crowded_keys(points, key)
    return None if big.isEmpty() else big


def _crowded_keys(points: DataFrame, key: str) -> DataFrame:
    return cut_lineage(points.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > BLOCK).select(key))


def _met(points: DataFrame, queries: DataFrame, key: str, pid: str, qid: str, find, n: int, feat: str | None = None, mean: bool = False) -> DataFrame:
    """key, qid, rank, pid, d2 (and ``feat`` of every point of that id) of the n first points that ``find`` gives for each query, by group.

    With ``mean`` one row for each query that has any instead: key, qid, w (sum of
    1 / (distance + 1e-8)), wf (the same times ``feat``, null where no point has it) and n_nn.
    """
    p = points.dropna(subset=[*XYZ]).select(key, F.col(pid).alias("_p"), *[F.col(a).cast("double").alias(a) for a in XYZ], *([F.col(feat).alias("_feat")] if feat else []))
    q = queries.dropna(subset=[*XYZ]).select(key, F.col(qid).alias("_q"), *[F.col(a).cast("double").alias(a) for a in XYZ])
    sums = [q.schema[key], q.schema["_q"], StructField("w", DoubleType()), StructField("wf", DoubleType()), StructField("n_nn", LongType())]
    fields = sums if mean else [q.schema[key], q.schema["_q"], StructField("rank", IntegerType()), p.schema["_p"], StructField("d2", DoubleType()), *([p.schema["_feat"]] if feat else [])]

    def fn(x: pa.Table, y: pa.Table) -> pa.Table:
        y = y.take(pc.sort_indices(y, [("_p", "ascending")], null_placement="at_start"))
        i, j, d2 = find(numbers(x, XYZ), numbers(y, XYZ))
        same = codes(x["_q"]) if x.num_rows else np.empty(0, np.int64)
        at, rank = first_of(same[i], n, d2, j)  # the candidates of queries of one id are one list
        i, j, d2 = i[at], j[at], d2[at]
        if feat:  # every point of that id, as a join by id finds them
            c = codes(y["_p"]) if y.num_rows else np.empty(0, np.int64)
            start, end = (np.searchsorted(c, c, side=s) for s in ("left", "right"))
            times = np.where(y["_p"].is_valid().to_numpy(), end - start, 0)[j]
            i, rank, d2, first = (np.repeat(v, times) for v in (i, rank, d2, start[j]))
            j = first + np.arange(len(first)) - np.repeat(np.cumsum(times) - times, times)
        if mean:
            of, at, back = np.unique(same[i], return_index=True, return_inverse=True)
            w = 1.0 / (np.sqrt(d2) + 1e-8)
            f = y["_feat"].take(pa.array(j, pa.int64()))
            known = f.is_valid().to_numpy() if len(j) else np.empty(0, bool)
            wf = np.bincount(back[known], (w * f.to_numpy().astype(float))[known], len(of)) if len(j) else np.empty(0)
            some = np.bincount(back[known], minlength=len(of)) > 0
            one = x.take(pa.array(i[at], pa.int64()))
            return pa.table({key: one[key], "_q": one["_q"], "w": pa.array(np.bincount(back, w, len(of)), pa.float64()), "wf": pa.array(wf, pa.float64(), mask=~some),
                             "n_nn": pa.array(np.bincount(back, minlength=len(of)), pa.int64())})
        left, right = x.take(pa.array(i, pa.int64())), y.take(pa.array(j, pa.int64()))
        more = {"_feat": right["_feat"]} if feat else {}
        return pa.table({key: left[key], "_q": left["_q"], "rank": pa.array(rank, pa.int32()), "_p": right["_p"], "d2": pa.array(d2, pa.float64()), **more})

    q, p = (df.dropna(subset=[key]) for df in (q, p))
    big = _crowded_keys(queries, key)
    # groups that aren't listed are whole on both sides, and both are dealt alike, so a table that meets itself is shuffled once
    x, y = (df.join(F.broadcast(big), key, "left_anti").select(*[F.col(c).alias(c) for c in df.columns]) for df in (q, p))
    out = x.groupBy(key).cogroup(y.groupBy(key)).applyInArrow(lambda x, y: fn(x, y), StructType(fields))
    if not big.isEmpty():
        out = out.unionByName(meet(q.join(big, key, "left_semi"), p.join(big, key, "left_semi"), [key], fn, StructType(fields), by_left=["_q"]))
    if mean:
        return out.withColumnRenamed("_q", qid)
    return out.select(key, F.col("_q").alias(qid), "rank", F.col("_p").alias(pid), "d2", *([F.col("_feat").alias(feat)] if feat else []))


def knn(points: DataFrame, queries: DataFrame, k: int, key: str = "cloud_id", pid: str = "pt_id",
        qid: str = "q_id", cell: float = 2.0) -> DataFrame:
    """The k nearest points (squared L2; ties -> lower ``pid``) of every
    query in the same ``key`` group.  Output: key, qid, rank, pid, d2.

    A cloud is one task's, where a query looks as far around it as certifies its
    answer (``blocks.nearest``).  In a cloud of more than ``BLOCK`` points a query
    looks at the 27 cells around it; one whose k-th candidate the searched
    cube doesn't certify looks again at cells twice as wide, until it is certified
    or has all points of its group.  So the cells follow the density around each
    query, every answer is exact, and no query is spread to more than 27 cells.  A
    group with fewer than k points returns all its points (the reference pads with
    index 0 instead); a query of a group without points returns nothing.
    """
    big = _crowded(points, key)
    if big is None:
        return _knn_met(points, queries, k, key, pid, qid)
    small = _knn_met(points.join(big, key, "left_anti"), queries.join(big, key, "left_anti"), k, key, pid, qid)
    return small.unionByName(_knn_cells(points.join(big, key, "left_semi"), queries.join(big, key, "left_semi"), k, key, pid, qid, cell))


def _knn_met(points: DataFrame, queries: DataFrame, k: int, key: str, pid: str, qid: str, feat: str | None = None) -> DataFrame:
    return _met(points, queries, key, pid, qid, lambda q, p: nearest(q, p, k), k, feat)


def _knn_cells(points: DataFrame, queries: DataFrame, k: int, key: str, pid: str, qid: str, cell: float) -> DataFrame:
    p = points.select(key, pid, *XYZ)
    pending = cut_lineage(queries.select(key, qid, *[F.col(a).alias(f"q{a}") for a in XYZ]))
    sizes = cut_lineage(points.groupBy(key).agg(F.count(F.lit(1)).alias("_gsize")))
    pending = cut_lineage(pending.join(sizes, key, "left_semi"))
    out = None
    while True:
        # keep the shuffled rows narrow: ids, distance and the query's certificate
        cand = _ring_candidates(pending, p, key, cell, 1).select(
            key, qid, pid, "d2", _margin2(cell, 1).alias("_m2"))
        wq = Window.partitionBy(key, qid)  # one query's candidates
        top = (cand.withColumn("rank", F.row_number().over(wq.orderBy(F.col("d2"), F.col(pid))))
                   .where(F.col("rank") <= k)
                   .withColumn("_kd2", F.max("d2").over(wq)).withColumn("_found", F.count(F.lit(1)).over(wq))
                   .join(sizes, key))
        ok = ((F.col("_found") >= F.least(F.col("_gsize"), F.lit(k)))
              & ((F.col("_kd2") < F.col("_m2")) | (F.col("_gsize") <= F.col("_found"))))
        top = cut_lineage(top.withColumn("_ok", ok))
        done = top.where("_ok").select(key, qid, "rank", pid, "d2")
        out = done if out is None else out.unionByName(done)
        pending = cut_lineage(pending.join(done.select(key, qid).distinct(), [key, qid], "left_anti"))
        if pending.isEmpty():
            return out
        cell *= 2


def ball_query(points: DataFrame, centers: DataFrame, min_radius: float, max_radius: float,
               sample_num: int, key: str = "cloud_id", pid: str = "pt_id", qid: str = "q_id") -> DataFrame:
    """Per centre, the first ``sample_num`` points (index order) with
    d2 == 0 or min^2 <= d2 < max^2, padded to ``sample_num`` slots with the
    first hit.  Centres without any hit produce no rows.
    Output: key, qid, slot (0-based), pid."""
    big = _crowded(points, key)

    def find(q: np.ndarray, p: np.ndarray):
        i, j = within(q, p, min_radius, max_radius, sample_num)
        return i, j, np.zeros(len(i))  # by id alone

    few, of = (points, centers) if big is None else (df.join(big, key, "left_anti") for df in (points, centers))
    first = _met(few, of, key, pid, qid, find, sample_num).drop("d2")
    if big is not None:
        first = first.unionByName(_ball_cells(points.join(big, key, "left_semi"), centers.join(big, key, "left_semi"), min_radius, max_radius, sample_num, key, pid, qid))
    cnt = first.groupBy(key, qid).agg(F.count(F.lit(1)).alias("_cnt"), F.min(pid).alias("_first"))
    pad = cnt.where(F.col("_cnt") < sample_num).select(
        key, qid, F.explode(F.sequence(F.col("_cnt"), F.lit(sample_num - 1))).alias("slot"),
        F.col("_first").alias(pid))
    return first.select(key, qid, (F.col("rank") - 1).alias("slot"), pid).unionByName(pad)


def _ball_cells(points: DataFrame, centers: DataFrame, min_radius: float, max_radius: float, sample_num: int, key: str, pid: str, qid: str) -> DataFrame:
    q = centers.select(key, qid, *[F.col(a).alias(f"q{a}") for a in XYZ])
    cand = _ring_candidates(q, points.select(key, pid, *XYZ), key, max_radius, 1)
    hit = cand.where((F.col("d2") == 0) | ((F.col("d2") >= min_radius * min_radius)
                                            & (F.col("d2") < max_radius * max_radius)))
    return top_n_per_group(hit, [key, qid], [F.col(pid)], sample_num, salts=1).select(key, qid, "rank", pid)


def query_and_group(points: DataFrame, centers: DataFrame, sample_num: int, max_radius: float | None = None, min_radius: float = 0.0, feats=(),
                    normalize: bool = False, uniform: bool = False, seed: int = 42, key: str = "cloud_id", pid: str = "pt_id", qid: str = "q_id",
                    cell: float = 2.0) -> DataFrame:
    """Key, qid, slot, pid, dx, dy, dz, ``feats`` and unique_cnt of the ``sample_num`` points grouped with each centre.

    With ``max_radius`` by ``ball_query``, else the nearest ones by ``knn`` (slots
    by distance).  Offsets are the point minus the centre, over ``max_radius`` if
    ``normalize``.  With ``uniform`` the distinct hits come first, by id, and the
    slots left are filled with hits drawn by a hash of seed, centre and slot,
    instead of the first hit.  A centre without a hit has no rows.
    """
    if max_radius is None:
        if normalize:
            raise ValueError("offsets are normalized by max_radius")
        hits = knn(points, centers, sample_num, key, pid, qid, cell).select(key, qid, (F.col("rank") - 1).alias("slot"), pid)
    else:
        hits = ball_query(points, centers, min_radius, max_radius, sample_num, key, pid, qid)
    lists = hits.groupBy(key, qid).agg(F.array_sort(F.collect_set(pid)).alias("_u"), F.array_sort(F.collect_list(F.struct("slot", pid))).alias("_s"))  # at most sample_num
    n = F.size("_u")
    drawn = F.get("_u", F.pmod(F.xxhash64(F.lit(seed), F.col(qid), F.col("slot")), n).cast("int"))
    slots = lists.select(key, qid, "_u", "_s", n.cast("long").alias("unique_cnt"), F.explode(F.sequence(F.lit(0), F.lit(sample_num - 1))).alias("slot"))
    chosen = F.when(F.col("slot") < n, F.get("_u", F.col("slot"))).otherwise(drawn) if uniform else F.get("_s", F.col("slot"))[pid]
    rows = slots.select(key, qid, "slot", "unique_cnt", chosen.alias(pid)).where(F.col(pid).isNotNull())
    c = centers.select(key, qid, *[F.col(a).alias(f"q{a}") for a in XYZ])
    by = max_radius if normalize else 1.0
    return (rows.join(points.select(key, pid, *XYZ, *feats), [key, pid]).join(c, [key, qid])
            .select(key, qid, "slot", pid, *[((F.col(a) - F.col(f"q{a}")) / by).alias(f"d{a}") for a in XYZ], *feats, "unique_cnt"))


def group_all(points: DataFrame, feats=(), key: str = "cloud_id", pid: str = "pt_id") -> DataFrame:
    """Every point of a cloud as one group: key, slot (points by id), pid, x, y, z and ``feats``."""
    return running(points.select(key, pid, *XYZ, *feats), [key], [F.col(pid)], rank_col="_r").select(key, (F.col("_r") - 1).alias("slot"), pid, *XYZ, *feats)


def three_interpolate(points: DataFrame, queries: DataFrame, feat: str, key: str = "cloud_id",
                      pid: str = "pt_id", qid: str = "q_id", cell: float = 2.0) -> DataFrame:
    """Three nearest neighbours (sqrt distances) and the inverse-distance
    weighted feature sum (weights 1/(d+1e-8) normalized, as callers supply)."""
    big = _crowded(points, key)
    few, of = (points, queries) if big is None else (df.join(big, key, "left_anti") for df in (points, queries))
    # summed up where they are found; a group of no more than BLOCK points is one block, so a query's points are together
    sums = _met(few, of, key, pid, qid, lambda q, p: nearest(q, p, 3), 3, feat, mean=True)
    if big is not None:
        many = points.join(big, key, "left_semi")
        nn = _knn_cells(many, queries.join(big, key, "left_semi"), 3, key, pid, qid, cell).join(many.select(key, pid, feat), [key, pid])
        w = 1.0 / (F.sqrt("d2") + 1e-8)
        sums = sums.unionByName(nn.groupBy(key, qid).agg(F.sum(w).alias("w"), F.sum(w * F.col(feat)).alias("wf"), F.count(F.lit(1)).alias("n_nn")))
    return sums.select(key, qid, (F.col("wf") / F.col("w")).alias(f"interp_{feat}"), "n_nn")


def chamfer(a: DataFrame, b: DataFrame, key: str = "cloud_id", pid: str = "pt_id", cell: float = 2.0) -> DataFrame:
    """For every point of a its nearest point of b and vice versa.
    Output: side ('a->b' / 'b->a'), key, pt, nn_pt, d2."""
    big = None
    many = cut_lineage(crowded(a, [key], BLOCK).select(key).union(crowded(b, [key], BLOCK).select(key)).distinct())
    if not many.isEmpty():
        big = many
    few = [(df if big is None else df.join(big, key, "left_anti")).dropna(subset=[*XYZ, key]).select(key, F.col(pid).alias("_q"), *[F.col(c).cast("double").alias(c) for c in XYZ]) for df in (a, b)]
    fields = [StructField("side", StringType()), few[0].schema[key], StructField("pt", few[0].schema["_q"].dataType), StructField("nn_pt", few[1].schema["_q"].dataType), StructField("d2", DoubleType())]

    def both(x: pa.Table, y: pa.Table) -> pa.Table:
        """Either way in one meeting of the two clouds, which are shuffled once."""
        x, y = (t.take(pc.sort_indices(t, [("_q", "ascending")], null_placement="at_start")) for t in (x, y))
        out = []
        for side, s, t in (("a->b", x, y), ("b->a", y, x)):
            i, j, d2 = nearest(numbers(s, XYZ), numbers(t, XYZ), 1)
            same = codes(s["_q"]) if s.num_rows else np.empty(0, np.int64)
            at, _ = first_of(same[i], 1, d2, j)
            i, j = pa.array(i[at], pa.int64()), pa.array(j[at], pa.int64())
            out.append(pa.table({"side": pa.array([side] * len(at), pa.string()), key: s[key].take(i), "pt": s["_q"].take(i), "nn_pt": t["_q"].take(j), "d2": pa.array(d2[at], pa.float64())}))
        return pa.concat_tables(out)

    near = few[0].groupBy(key).cogroup(few[1].groupBy(key)).applyInArrow(lambda x, y: both(x, y), StructType(fields))
    if big is None:
        return near
    a, b = (df.join(big, key, "left_semi") for df in (a, b))
    ab = knn(b, a.withColumnRenamed(pid, "q_id"), 1, key, pid, "q_id", cell)
    ba = knn(a, b.withColumnRenamed(pid, "q_id"), 1, key, pid, "q_id", cell)
    far = (ab.select(F.lit("a->b").alias("side"), key, F.col("q_id").alias("pt"), F.col(pid).alias("nn_pt"), "d2")
              .unionByName(ba.select(F.lit("b->a").alias("side"), key, F.col("q_id").alias("pt"),
                                     F.col(pid).alias("nn_pt"), "d2")))
    return near.unionByName(far)


def furthest_point_sample(points: DataFrame, npoint: int, key: str = "cloud_id", pid: str = "pt_id",
                          checkpoint_every: int = 1) -> DataFrame:
    """K8: iterative farthest point sampling by xyz, all clouds in parallel.

    Start = first point (index order); each step picks the point with the
    largest distance to the picked set (ties -> lower index).  One step is an
    equi-join with the last pick per cloud and a ``max_by`` aggregation.
    Output: key, step (0-based), pid."""
    st = points.select(key, pid, *XYZ).withColumn("_md", F.lit(float("inf")))
    st = cut_lineage(st)
    pick = st.groupBy(key).agg(F.min(pid).alias(pid)).withColumn("step", F.lit(0))
    picks = cut_lineage(pick)
    last = picks
    for step in range(1, npoint):
        lp = last.join(st.select(key, pid, *[F.col(a).alias(f"l{a}") for a in XYZ]), [key, pid]) \
                 .select(key, *[f"l{a}" for a in XYZ])
        d = sum((F.col(a) - F.col(f"l{a}")) * (F.col(a) - F.col(f"l{a}")) for a in XYZ)
        st = st.join(lp, key).withColumn("_md", F.least("_md", d)).drop("lx", "ly", "lz")
        st = cut_lineage(st)
        last = st.groupBy(key).agg(F.max_by(F.col(pid), F.struct(F.col("_md"), -F.col(pid))).alias(pid)) \
                 .withColumn("step", F.lit(step))
        last = cut_lineage(last)
        picks = picks.unionByName(last)
    return picks
