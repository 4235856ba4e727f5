"""Groups of two tables met block by block in numpy, for joins whose pairs are many and whose results are few.

Where most boxes of an image overlap, a join makes a row of every pair only for an
aggregation to drop nearly all of them, and sorting those rows fills the disk.
Here the rows of a group (or, of a large one, blocks of at most ``BLOCK`` rows of
either side, every block against every other) are brought together once, and a
function of two Arrow tables gives what is wanted of their pairs.  A task holds
two blocks and a slab of at most ``SLAB`` pairs.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

BOX = ("x1", "y1", "x2", "y2")
#: Most rows of a side that a task holds.
BLOCK = 50_000
#: Most pairs looked at together.
SLAB = 1 << 15
#: Most rows of a group that is thinned together with the others of its Arrow batch.
TOGETHER = 1024

#: Makes of a group's left and right rows a table of the result's columns.
Meet = Callable[[pa.Table, pa.Table], pa.Table]


def meet(left: DataFrame, right: DataFrame, keys: list[str], fn: Meet, schema: StructType, block: int = BLOCK, by_left: list[str] | None = None) -> DataFrame:
    """What ``fn`` makes of every pair of blocks of each group; both sides have ``keys`` (rows of null keys take no part).

    ``fn`` sees each pair of a left and a right row in exactly one call, and all
    left rows that are equal in ``by_left`` in the same calls.
    """
    left, right = left.dropna(subset=keys), right.dropna(subset=keys)
    # only groups of more than a block are listed (at most a row for each block), so ordinary ones are shuffled once and narrow
    many = [crowded(df, keys, block, n) for df, n in ((left, "_nl"), (right, "_nr"))]
    sizes = F.broadcast(many[0].join(many[1], keys, "full"))

    def dealt(df: DataFrame, own: str, others: str, spread: list[str]) -> DataFrame:
        columns = df.columns
        d = df.join(sizes, keys, "left")
        mine = F.pmod(F.xxhash64(*spread), F.coalesce(f"_n{own}", F.lit(1))).cast("int")
        return d.select(*[F.col(c).alias(c) for c in columns], mine.alias(f"_{own}"), F.explode(F.sequence(F.lit(0), F.coalesce(f"_n{others}", F.lit(1)) - 1)).alias(f"_{others}"))

    a, b = dealt(left, "l", "r", by_left or left.columns), dealt(right, "r", "l", right.columns)
    by = [*keys, "_l", "_r"]
    return a.groupBy(*by).cogroup(b.groupBy(*by)).applyInArrow(lambda x, y: fn(x, y), schema)


def crowded(df: DataFrame, keys: list[str], most: int, out: str = "_blocks") -> DataFrame:
    """Groups of more than ``most`` rows, with the number of blocks of ``most`` rows that they fill."""
    return df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(out)).where(F.col(out) > 1)


def numbers(t: pa.Table, names) -> np.ndarray:
    """Columns of a table as rows of a float array."""
    return np.stack([t[n].to_numpy().astype(float) for n in names]) if t.num_rows else np.empty((len(names), 0))


def near_boxes(a: np.ndarray, b: np.ndarray, offset: float = 0.0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slabs (places in ``a``, places in ``b``, ascending) that hold every pair of boxes that meet; boxes are arrays (4, n)."""
    order = np.lexsort((a[1], a[0]))
    at = 0
    while at < len(order):
        some = order[at:at + max(1, min(512, SLAB // max(b.shape[1], 1)))]
        at += len(some)
        x1, y1, x2, y2 = a[:, some]
        hit = np.flatnonzero((b[0] < x2.max() + offset) & (b[2] + offset > x1.min()) & (b[1] < y2.max() + offset) & (b[3] + offset > y1.min()))
        if len(hit):
            yield some, hit


def inter_of(a: np.ndarray, b: np.ndarray, offset: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Shared areas (n, m) of boxes (4, n) and (4, m), and whether they meet."""
    w = np.minimum(a[2][:, None], b[2]) - np.maximum(a[0][:, None], b[0]) + offset
    h = np.minimum(a[3][:, None], b[3]) - np.maximum(a[1][:, None], b[1]) + offset
    both = (w > 0) & (h > 0)
    return np.where(both, w * h, 0.0), both


def open_ended(a: np.ndarray) -> np.ndarray:
    """Boxes with far corners that aren't known moved to infinity, for ``near_boxes``."""
    return np.concatenate([a[:2], np.where(np.isnan(a[2:]), np.inf, a[2:])])


def inter_as_joined(a: np.ndarray, b: np.ndarray, offset: float, cell: float) -> tuple[np.ndarray, np.ndarray]:
    """``inter_of`` as ``overlap_pairs`` takes far corners that aren't known: the other box's counts, from the cell of the near corner on."""
    w = np.fmin(a[2][:, None], b[2]) - np.maximum(a[0][:, None], b[0]) + offset
    h = np.fmin(a[3][:, None], b[3]) - np.maximum(a[1][:, None], b[1]) + offset
    both = (w > 0) & (h > 0)
    for k in (0, 1):
        for lone, near in ((np.isnan(a[k + 2])[:, None], a[k][:, None]), (np.isnan(b[k + 2])[None], b[k][None])):
            if lone.any():
                both &= ~lone | (np.floor(np.maximum(a[k][:, None], b[k]) / cell) == np.floor(near / cell))
    return np.where(both, w * h, 0.0), both


def area_of(a: np.ndarray, offset: float = 0.0) -> np.ndarray:
    return (a[2] - a[0] + offset) * (a[3] - a[1] + offset)


def boxed(df: DataFrame, columns: list[Column | str]) -> DataFrame:
    """``columns`` and the corners, as doubles, of the rows whose corners are known."""
    return df.dropna(subset=list(BOX)).select(*columns, *[F.col(c).cast("double").alias(c) for c in BOX])


def best_overlaps(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str, mode: str = "iou", eps: float = 1e-6, offset: float = 0.0,
                  right_cols: tuple[str, ...] = (), prefer: tuple[str, ...] = (), out: str = "overlap", block: int = BLOCK) -> DataFrame:
    """Of ``overlap_pairs``, for each left row and block of right rows the pair of the largest overlap: keys, l_<left_id>, r_<right_id>, r_<right_cols>, ``out``.

    Of equal ones the first by ``prefer`` (ascending, nulls last) comes.
    """
    l = boxed(left, [*keys, F.col(left_id).alias(f"l_{left_id}")])
    r = boxed(right, [*keys, *[F.col(c).alias(f"r_{c}") for c in (right_id, *right_cols)]])
    schema = StructType([*l.select(*keys, f"l_{left_id}").schema.fields, *r.select(f"r_{right_id}", *[f"r_{c}" for c in right_cols]).schema.fields]).add(out, "double")
    order = [(f"r_{c}", "ascending") for c in prefer]

    def best(x: pa.Table, y: pa.Table) -> pa.Table:
        if order and y.num_rows:
            y = y.sort_by(order)
        a, b = numbers(x, BOX), numbers(y, BOX)
        rows, which, values = [], [], []
        if x.num_rows and y.num_rows:
            sa, sb = area_of(a, offset), area_of(b, offset)
            for i, j in near_boxes(a, b, offset):
                inter, both = inter_of(a[:, i], b[:, j], offset)
                base = np.maximum(sa[i][:, None], eps) if mode == "iof" else np.maximum(sa[i][:, None] + sb[j] - inter, eps)
                like = np.where(both, inter / base, -np.inf)
                top = like.argmax(axis=1)
                value = like[np.arange(len(i)), top]
                some = value > -np.inf
                rows.append(i[some])
                which.append(j[top[some]])
                values.append(value[some])
        at, of = (pa.array(np.concatenate(v).astype(np.int64) if v else np.empty(0, np.int64)) for v in (rows, which))
        columns = {n: (y if n.startswith("r_") and n not in keys else x)[n].take(of if n.startswith("r_") and n not in keys else at) for n in schema.names[:-1]}
        return pa.table({**columns, out: pa.array(np.concatenate(values) if values else np.empty(0))})

    return meet(l, r, keys, best, schema, block)


def claims(dets: DataFrame, gts: DataFrame, keys: list[str], thr: float, offset: float = 0.0) -> DataFrame:
    """``dets`` with their likest ground truth and who has it first, a group in one task: _iou, _gt, _ign and _first.

    Of equal overlaps the one that isn't ignored, then the smaller id, counts.
    ``_first`` is, where a ground truth that isn't ignored is overlapped from
    ``thr`` on, the id of the first such detection (score, then id).  Rows of one
    det_id share the best that any of them has; rows without keys or id have none.
    """
    g = boxed(gts.dropna(subset=keys), [*keys, F.col("gt_id").alias("_gt"), F.col("ignore_flag").alias("_ign")])
    schema = StructType([*dets.schema.fields, StructField("_iou", DoubleType()), g.schema["_gt"], StructField("_ign", BooleanType()), StructField("_first", dets.schema["det_id"].dataType)])
    names = dets.columns

    def bind(x: pa.Table, y: pa.Table) -> pa.Table:
        c, n = pa.compute, x.num_rows
        x = x.take(c.sort_indices(pa.table({"n": x["score"].is_valid(), "s": c.negate(x["score"].cast(pa.float64())), "i": x["det_id"]}), [(k, "ascending") for k in "nsi"]))  # nulls first
        y = y.sort_by([("_ign", "ascending"), ("_gt", "ascending")])
        value, place = np.full(n, -np.inf), np.zeros(n, np.int64)
        a, b = numbers(x, BOX), numbers(y, BOX)
        named = x["det_id"].is_valid().to_numpy()
        some = np.flatnonzero(~np.isnan(a).any(axis=0) & named)
        if len(some) and y.num_rows:
            a = a[:, some]
            sa, sb = area_of(a, offset), area_of(b, offset)
            for i, j in near_boxes(a, b, offset):
                inter, both = inter_of(a[:, i], b[:, j], offset)
                like = np.where(both, inter / np.maximum(sa[i][:, None] + sb[j] - inter, 1e-6), -np.inf)
                top = like.argmax(axis=1)
                value[some[i]], place[some[i]] = like[np.arange(len(i)), top], j[top]
        code = codes(x["det_id"])
        if n and code.max() + 1 < n:
            order = np.lexsort((place, -value, code))
            best = order[np.searchsorted(code[order], code)]
            value, place = np.where(named, value[best], -np.inf), place[best]
        met = value > -np.inf
        gt = y["_gt"].take(pa.array(place, mask=~met))
        ign = y["_ign"].take(pa.array(place, mask=~met))
        who = codes(gt)
        claim = np.flatnonzero(met & (value >= thr) & ~c.fill_null(ign, True).to_numpy() & gt.is_valid().to_numpy())
        held, at = np.unique(who[claim], return_index=True)  # rows are in order, so the first of a code comes first
        first, none = np.zeros(n, np.int64), np.ones(n, bool)
        first[claim], none[claim] = claim[at][np.searchsorted(held, who[claim])], False
        return pa.table({**{k: x[k] for k in names}, "_iou": pa.array(value, mask=~met), "_gt": gt, "_ign": ign, "_first": x["det_id"].take(pa.array(first, mask=none))})

    d = dets.select(*[F.col(k).alias(k) for k in names])
    unknown = functools.reduce(Column.__or__, [F.col(k).isNull() for k in keys])  # no group, so not together
    alone = d.where(unknown).select(*names, *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[len(names):]])
    return d.where(~unknown).groupBy(*keys).cogroup(g.groupBy(*keys)).applyInArrow(lambda x, y: bind(x, y), schema).unionByName(alone)


def overlap_totals(left: DataFrame, right: DataFrame, keys: list[str], modes: tuple[str, ...], eps: float = 1e-6, offset: float = 0.0, cell: float = 64.0) -> DataFrame:
    """keys, n_pairs and for each mode (iou, iof, giou) sum_<mode> and max_<mode> of all pairs of boxes that share area."""
    l, r = (df.dropna(subset=["x1", "y1"]).select(*keys, *[F.col(c).cast("double").alias(c) for c in BOX]) for df in (left, right))
    schema = StructType([*l.select(*keys).schema.fields, StructField("n_pairs", LongType()), *[StructField(f"{f}_{m}", DoubleType()) for m in modes for f in ("sum", "max")]])

    def total(x: pa.Table, y: pa.Table) -> pa.Table:
        a, b = numbers(x, BOX), numbers(y, BOX)
        n, sums, most = 0, dict.fromkeys(modes, 0.0), dict.fromkeys(modes, -np.inf)
        if x.num_rows and y.num_rows:
            sa, sb = area_of(a, offset), area_of(b, offset)
            for i, j in near_boxes(open_ended(a), open_ended(b), offset):
                p, q = a[:, i], b[:, j]
                inter, both = inter_as_joined(p, q, offset, cell)
                if not both.any():
                    continue
                n += int(both.sum())
                union = np.fmax(sa[i][:, None] + sb[j] - inter, eps)
                like = {"iou": inter / union}
                if "iof" in modes:
                    like["iof"] = inter / np.fmax(sa[i][:, None], eps)
                if "giou" in modes:
                    w, h = (np.maximum(np.fmax(p[k + 2][:, None], q[k + 2]) - np.minimum(p[k][:, None], q[k]) + offset, 0.0) for k in (0, 1))
                    hull = np.maximum(w * h, eps)
                    like["giou"] = like["iou"] - (hull - union) / hull
                for m in modes:
                    sums[m] += float(like[m].sum(where=both))
                    most[m] = max(most[m], float(like[m].max(where=both, initial=-np.inf)))
        one = x.select(keys).slice(0, 1 if n else 0)
        rows = one.num_rows
        return pa.table({**{k: one[k] for k in keys}, "n_pairs": pa.array([n] * rows, pa.int64()),
                         **{f"{f}_{m}": pa.array([v[m]] * rows, pa.float64()) for m in modes for f, v in (("sum", sums), ("max", most))}})

    parts = meet(l, r, keys, total, schema)
    return parts.groupBy(*keys).agg(F.sum("n_pairs").alias("n_pairs"), *[g(f"{f}_{m}").alias(f"{f}_{m}") for m in modes for f, g in (("sum", F.sum), ("max", F.max))])


def likely_pairs(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str, least: float, right_cols: tuple[str, ...] = (), share: str | None = None) -> DataFrame:
    """keys, l_<left_id>, r_<right_id>, r_<right_cols> and like of the pairs that share area with IoU >= ``least``; where ``share`` of ``right`` is set, by their share of the left box."""
    l = boxed(left, [*keys, F.col(left_id).alias(f"l_{left_id}")])
    r = boxed(right, [*keys, *[F.col(c).alias(f"r_{c}") for c in (right_id, *right_cols)], *([F.coalesce(share, F.lit(False)).alias("_share")] if share else [])])
    own = [f"r_{c}" for c in (right_id, *right_cols)]
    schema = StructType([*l.select(*keys, f"l_{left_id}").schema.fields, *r.select(*own).schema.fields]).add("like", "double")

    def over(x: pa.Table, y: pa.Table) -> pa.Table:
        a, b = numbers(x, BOX), numbers(y, BOX)
        found = []
        if x.num_rows and y.num_rows:
            sa, sb = area_of(a), area_of(b)
            of = y["_share"].to_numpy() if share else np.zeros(y.num_rows, bool)
            for i, j in near_boxes(a, b):
                inter, both = inter_of(a[:, i], b[:, j])
                with np.errstate(divide="ignore", invalid="ignore"):
                    like = inter / np.where(of[j], sa[i][:, None], sa[i][:, None] + sb[j] - inter)
                p, q = np.nonzero(both & (like >= least))
                found.append((i[p], j[q], like[p, q]))
        i, j = (pa.array(np.concatenate([f[c] for f in found]).astype(np.int64) if found else np.empty(0, np.int64)) for c in (0, 1))
        mine, other = x.select([*keys, f"l_{left_id}"]).take(i), y.select(own).take(j)
        return pa.table({**{c: mine[c] for c in mine.column_names}, **{c: other[c] for c in own}, "like": pa.array(np.concatenate([f[2] for f in found]) if found else np.empty(0))})

    return meet(l, r, keys, over, schema)


def first_free(dets: DataFrame, gts: DataFrame, keys: list[str], det_id: str, gt_id: str, order: list[Column], thr: float, small: bool = False, strict: bool = False,
               offset: float = 0.0) -> DataFrame:
    """``dets`` with gt_match, _like and _ignored: in ``order``, each detection takes the likest ground truth (iou) that no earlier one of its group took.

    A likeness counts from ``thr`` on (over it, if ``strict``; from w h / ((w + 10)
    (h + 10)), if ``small`` and that is less).  Of equal ones the smaller id is
    taken; ground truths without an id take no part.  ``gts`` has ``ignored``.
    Detections without keys or id don't come; where an id stands for several rows,
    each of them comes with what each of them took.
    """
    names = dets.columns
    asc = [f"_o{i}" for i in range(len(order))]
    some = [o.alias(n) for o, n in zip(order, asc, strict=True)]
    l = dets.dropna(subset=keys).select(*names, *some, *[o.isNotNull().alias(f"_n{i}") for i, o in enumerate(order)])
    r = boxed(gts.dropna(subset=[gt_id]), [*keys, F.col(gt_id).alias("_g"), F.coalesce("ignored", F.lit(False)).alias("_ignored")])
    schema = StructType([*dets.schema.fields]).add("gt_match", "long").add("_like", "double").add("_ignored", "boolean")
    by = [(c, "ascending") for i in range(len(order)) for c in (f"_n{i}", f"_o{i}")]  # nulls first

    def take(x: pa.Table, y: pa.Table) -> pa.Table:
        x, y = x.sort_by(by), y.sort_by([("_g", "ascending")])
        a, b = numbers(x, BOX), numbers(y, BOX)
        ids = y["_g"].to_numpy() if y.num_rows else np.empty(0, np.int64)
        w, h = b[2] - b[0] + offset, b[3] - b[1] + offset
        least = np.minimum(w * h / ((w + 10.0) * (h + 10.0)), thr) if small else np.full(len(ids), thr)
        sa, sb = area_of(a, offset), area_of(b, offset)
        free = np.arange(len(ids))
        gone = np.zeros(len(ids), bool)
        got, likes = np.full(x.num_rows, -1), np.zeros(x.num_rows)
        at = 0
        while at < x.num_rows and len(free):
            i = np.arange(at, min(x.num_rows, at + max(1, min(256, SLAB // len(free)))))
            at += len(i)
            inter, both = inter_of(a[:, i], b[:, free], offset)
            like = inter / np.maximum(sa[i][:, None] + sb[free] - inter, 1e-6)
            like[~(both & ((like > least[free]) if strict else (like >= least[free])))] = -np.inf
            for k in np.flatnonzero((like > -np.inf).any(axis=1)):
                top = like[k].argmax()
                if like[k, top] > -np.inf:
                    got[i[k]], likes[i[k]] = free[top], like[k, top]
                    copies = free[slice(*np.searchsorted(ids[free], ids[free[top]] + np.array([0, 1])))]
                    gone[copies] = True
                    like[:, np.isin(free, copies, assume_unique=True) if len(copies) > 1 else top] = -np.inf
            free = free[~gone[free]]
        rows = took = np.flatnonzero(x[det_id].is_valid().to_numpy())
        code = codes(x[det_id])[rows] if len(rows) else rows
        if len(rows) and len(np.unique(code)) < len(rows):
            order = np.argsort(code, kind="stable")
            start, end = (np.searchsorted(code[order], code, side=side) for side in ("left", "right"))
            times = end - start
            took = rows[order[np.repeat(start, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]]
            rows = np.repeat(rows, times)
        none = got[took] < 0
        matched = pa.array(got[took], pa.int64(), mask=none)
        x = x.take(pa.array(rows, pa.int64()))
        return pa.table({**{k: x[k] for k in names}, "gt_match": y["_g"].take(matched), "_like": pa.array(likes[took], mask=none),
                         "_ignored": pa.compute.fill_null(y["_ignored"].take(matched), False)})

    l, r = (df.select(*[F.col(c).alias(c) for c in df.columns]) for df in (l, r))
    return l.groupBy(*keys).cogroup(r.groupBy(*keys)).applyInArrow(lambda x, y: take(x, y), schema)


# ---- points

def _near_points(q: np.ndarray, p: np.ndarray, reach: float, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slabs (places in ``q``, places in ``p``, ascending): every point within ``reach`` of a query is in its slab."""
    cells = np.floor(q[:, rows] / max(reach, 1e-300))
    order = rows[np.lexsort((q[2, rows], cells[1], cells[0]))]
    for at in range(0, len(order), 64):
        some = order[at:at + 64]
        lo, hi = q[:, some].min(axis=1) - reach, q[:, some].max(axis=1) + reach
        hit = np.flatnonzero(((p >= lo[:, None]) & (p <= hi[:, None])).all(axis=0))
        step = max(1, SLAB // max(len(hit), 1))
        for k in range(0, len(some), step):
            yield some[k:k + step], hit


def _distances(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    dx, dy, dz = (q[k][:, None] - p[k] for k in range(3))
    return dx * dx + dy * dy + dz * dz


def nearest(q: np.ndarray, p: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, squared distance) of the k nearest points (3, m) of each query (3, n), by distance and then place.

    A slab of queries looks at the points within a reach around it; a query whose
    k-th distance the reach doesn't certify looks again with twice the reach.
    """
    n, m = q.shape[1], p.shape[1]
    found: list[tuple] = []
    if n and m:
        k = min(k, m)
        size = max(float((p.max(axis=1) - p.min(axis=1)).max()), 1e-9)
        reach, pending = size * (k / m) ** (1 / 3), np.arange(n)
        while len(pending):
            again = []
            for some, hit in _near_points(q, p, reach, pending):
                if len(hit) < k:
                    again.append(some)
                    continue
                d2 = _distances(q[:, some], p[:, hit])
                kth = np.partition(d2, k - 1, axis=1)[:, k - 1]
                ok = (kth < reach * reach * (1 - 1e-9)) | (len(hit) == m)
                again.append(some[~ok])
                i, j = np.nonzero((d2 <= kth[:, None]) & ok[:, None])
                o = np.lexsort((j, d2[i, j], i))
                i, j = i[o], j[o]
                rank = np.arange(len(i)) - np.searchsorted(i, i)
                i, j = i[rank < k], j[rank < k]
                found.append((some[i], hit[j], d2[i, j]))
            pending = np.concatenate(again) if again else pending[:0]
            reach *= 2
    return tuple(np.concatenate([f[c] for f in found]) if found else np.empty(0, t) for c, t in ((0, np.int64), (1, np.int64), (2, float)))


def within(q: np.ndarray, p: np.ndarray, least: float, most: float, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) of the first n points, by place, at d2 = 0 or least^2 <= d2 < most^2 of each query."""
    found = []
    for some, hit in _near_points(q, p, most * (1 + 1e-9), np.arange(q.shape[1])):
        d2 = _distances(q[:, some], p[:, hit])
        on = (d2 == 0) | ((d2 >= least * least) & (d2 < most * most))
        i, j = np.nonzero(on & (np.cumsum(on, axis=1) <= n))
        found.append((some[i], hit[j]))
    return tuple(np.concatenate([f[c] for f in found]) if found else np.empty(0, np.int64) for c in (0, 1))


def codes(column: pa.ChunkedArray) -> np.ndarray:
    """Numbers that are equal where the values are (nulls are equal)."""
    encoded = column.combine_chunks().dictionary_encode(null_encoding="encode")
    return (encoded.combine_chunks() if isinstance(encoded, pa.ChunkedArray) else encoded).indices.to_numpy(zero_copy_only=False)


def first_of(code: np.ndarray, n: int, *order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, ranks from 1) of the first n entries of every code by ``order``, codes together."""
    o = np.lexsort((*order[::-1], code))
    c = code[o]
    rank = np.arange(len(c)) - np.searchsorted(c, c)
    return o[rank < n], rank[rank < n] + 1


# ---- greedy removal

def keep_first(rows: DataFrame, keys: list[str], id_col: str, score: str, hull: list[Column], fields: list[Column],
               conflict: Callable[[np.ndarray, np.ndarray], np.ndarray], alike: bool = False, owners: bool = False) -> DataFrame:
    """keys and id of the rows that no kept row of a better score (ties: smaller id) conflicts with.

    ``conflict`` takes two arrays (pairs, fields) of rows whose hulls meet.  Groups
    are streamed in order past the rows that they kept, a slab of pairs at a time;
    small ones that an Arrow batch holds whole are thinned all at once.
    Rows of one id don't remove one another, unless ``alike``.  With ``owners`` all
    rows come, with the id ``_owner`` of the first kept row that conflicts with them
    (their own, if kept) and its ``_place`` among the kept.
    """
    f, h = [f"_f{i}" for i in range(len(fields))], [f"_h{i}" for i in range(4)]
    table = rows.dropna(subset=[*keys, id_col]).select(*keys, id_col, (-F.col(score)).alias("_s"), *[c.cast("double").alias(n) for c, n in zip([*hull, *fields], [*h, *f], strict=True)])
    dealt = table.repartition(*keys).sortWithinPartitions(*keys, "_s", id_col, *(h if alike else [])).drop("_s")
    schema = rows.select(*keys, id_col).schema
    names = list(schema.names)
    if owners:
        schema = schema.add("_owner", "long").add("_place", "long")

    def meets(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero((a[0][:, None] < b[2]) & (b[0] < a[2][:, None]) & (a[1][:, None] < b[3]) & (b[1] < a[3][:, None]))

    class Kept:
        """The kept rows of a group, in arrays that double."""

        def __init__(self) -> None:
            self.n, self.hull, self.fields, self.ids = 0, np.empty((4, 64)), np.empty((64, len(f))), np.empty(64, np.int64)

        def add(self, hulls, values, ids) -> None:
            while self.n + len(ids) > len(self.ids):
                self.hull, self.fields, self.ids = np.concatenate([self.hull] * 2, axis=1), np.concatenate([self.fields] * 2), np.concatenate([self.ids] * 2)
            to = slice(self.n, self.n + len(ids))
            self.hull[:, to], self.fields[to], self.ids[to] = hulls, values, ids
            self.n += len(ids)

    def chunk(kept: Kept, hulls, values, ids) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows kept, and for each row the place among the kept of the one that it belongs to."""
        free, owner = np.ones(len(ids), bool), np.zeros(len(ids), np.int64)
        for at in range(0, kept.n, 256):
            left = np.flatnonzero(free)
            to = slice(at, min(at + 256, kept.n))
            i, j = meets(hulls[:, left], kept.hull[:, to])
            if not alike:
                other = ids[left[i]] != kept.ids[to][j]  # copies of a row don't remove one another
                i, j = i[other], j[other]
            hit = conflict(kept.fields[to][j], values[left[i]])
            i, first = np.unique(i[hit], return_index=True)
            free[left[i]], owner[left[i]] = False, at + j[hit][first]
        left = np.flatnonzero(free)
        i, j = meets(hulls[:, left], hulls[:, left])
        later = i < j if alike else (i < j) & (ids[left[i]] != ids[left[j]])
        i, j = i[later], j[later]
        hit = conflict(values[left[i]], values[left[j]])
        i, j = i[hit], j[hit]
        ends = np.searchsorted(i, np.arange(len(left) + 1))
        ok, by = np.ones(len(left), bool), np.arange(len(left))
        for k in np.unique(i):
            if ok[k]:
                gone = j[ends[k]:ends[k + 1]]
                gone = gone[ok[gone]]
                ok[gone], by[gone] = False, k
        owner[left] = (kept.n + np.cumsum(ok) - 1)[by]
        kept.add(hulls[:, left[ok]], values[left[ok]], ids[left[ok]])
        return left[ok], owner

    def together(of: np.ndarray, hulls, values, ids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the rows kept of whole groups, numbered by ``of``; for each row the place of the kept one that it belongs to and that one's place among its group's."""
        left, by, nth = np.arange(len(ids)), np.arange(len(ids)), np.zeros(len(ids), np.int64)
        found = [left[:0]]
        while len(left):  # a round keeps the first row left of every group
            new = np.append(True, of[left[1:]] != of[left[:-1]])
            top = left[new]
            nth[top] = len(found) - 1
            found.append(top)
            first = top[np.cumsum(new) - 1]
            a, b = hulls[:, left], hulls[:, first]
            met = ~new & (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3])
            if not alike:
                met &= ids[left] != ids[first]
            at = np.flatnonzero(met)
            gone = at[conflict(values[first[at]], values[left[at]])]
            by[left[gone]] = first[gone]
            free = ~new
            free[gone] = False
            left = left[free]
        return np.sort(np.concatenate(found)), by, nth[by]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, kept = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            hulls, values = numbers(t, h), numbers(t, f).T if f else np.empty((batch.num_rows, 0))
            ids = t[id_col].to_numpy()
            mixed = np.zeros(batch.num_rows, bool)
            for k in keys:
                c = codes(t[k])
                mixed[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(mixed).tolist(), batch.num_rows]
            sizes = np.diff(starts)
            begun = np.arange(len(sizes)) > 0
            begun[0] = tuple(t[k][0].as_py() for k in keys) != group
            small = begun & (sizes <= TOGETHER)
            small[-1] = False  # goes on in the next batch, perhaps
            some = np.flatnonzero(np.repeat(small, sizes))
            at_kept, by, nth = together(np.repeat(np.arange(len(sizes)), sizes)[some], hulls[:, some], values[some], ids[some])
            chosen, owner, place = [some[at_kept]], np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
            owner[some], place[some] = ids[some][by], nth
            for k in np.flatnonzero(~small).tolist():
                a, b = starts[k], starts[k + 1]
                if begun[k]:
                    group, kept = tuple(t[n][a].as_py() for n in keys), Kept()
                c = a
                while c < b:  # first few rows: what they keep thins the rest before it is compared with itself
                    to = slice(c, min(c + min(256, max(16, c - a)), b))
                    some, at_kept = chunk(kept, hulls[:, to], values[to], ids[to])
                    chosen.append(c + some)
                    owner[to], place[to] = kept.ids[at_kept], at_kept
                    c = to.stop
            if owners:
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(owner), pa.array(place)], schema.names)
            else:
                yield batch.select(names).take(pa.array(np.sort(np.concatenate(chosen))))

    return dealt.mapInArrow(run, schema)
