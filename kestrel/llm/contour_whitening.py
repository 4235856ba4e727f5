"""Whitening of embeddings by components from contour integration (FEAST).

Vectors become whole numbers (fixed point), so sums are exact.  The covariance is
a sum of centred products over all rows, added up by Spark; only its d x d matrix
comes to the driver, whatever the number of rows.

Components.  Inertia counts (signs of the pivots of V - s) say how many
eigenvalues lie above s.  Bisection on s cuts the wanted top of the spectrum into
slices of at most ``per_slice`` eigenvalues.  Per slice, Gauss-Legendre nodes on a
circle through its ends give complex shifted solves (z - V)^-1 Y, whose weighted
sum projects Y onto the slice's eigenvectors; Rayleigh-Ritz on that subspace gives
eigenpairs, and the projection is repeated from them until residuals are at
rounding level.  A slice must deliver as many eigenvalues as its inertia counts
say, or it is projected again from a larger subspace: none can be missed.  The
slices are independent and run as Spark tasks.  A last Rayleigh-Ritz over all
slices' vectors makes neighbours in different slices orthogonal to rounding.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import cut_lineage

#: Fixed-point numbers beyond this are held at it.
LARGEST = 1 << 61
#: Eigenvalues below this share of the largest possible one count as zero.
ZERO = 1e-12


def fixed_point(vectors: list, dim: int, scale: int = 64, shift: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
    """(rows, x): the rows of ``vectors`` that have ``dim`` finite entries, and floor(scale * entry) + shift for each."""
    rows = [i for i, v in enumerate(vectors) if v is not None and len(v) == dim and None not in v]
    a = np.array([vectors[i] for i in rows], np.float64).reshape(len(rows), dim)
    fine = np.isfinite(a).all(1)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(a[fine] * scale), -float(LARGEST), float(LARGEST))
    return np.array(rows, np.int64)[fine], np.minimum(scaled.astype(np.int64), LARGEST - shift) + shift


def _batches(batches: Iterator, dim: int, size: int = 1 << 22):
    """(ids, x) for pieces of Arrow batches (id, vector) of about ``size`` entries."""
    for batch in batches:
        step = max(1, size // dim)
        for lo in range(0, batch.num_rows, step):
            part = batch.slice(lo, step)
            rows, x = fixed_point(part.column(1).to_pylist(), dim)
            ids = part.column(0).to_pylist()
            if len(rows):
                yield [ids[i] for i in rows], x


class Centre:
    """The mean S / n of n whole-number vectors as its whole part and remainder, so that differences to it are exact."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.whole, self.rest = n, np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S) ** 2, exact."""
        y = x - self.whole
        reach = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if reach * reach * x.shape[1] < 1 << 63:
            return ((self.n * y - self.rest) ** 2).sum(1).tolist()
        return ((self.n * y.astype(object) - self.rest.astype(object)) ** 2).sum(1).tolist()


def _vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")).where("v IS NOT NULL")


def fit_centre(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Centre | None:
    """Exact sums over all vectors without null or non-finite entries; None if there are none.

    The dimension is the most frequent length (the least of equally frequent
    ones); vectors of another length, and empty ones, take no part.
    """
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[int, list] = {}
        for batch in batches:
            for part in (batch.slice(lo, 10_000) for lo in range(0, batch.num_rows, 10_000)):
                vectors = part.column(1).to_pylist()
                for dim in {len(v) for v in vectors if v}:
                    _, x = fixed_point(vectors, dim)
                    high = (x >> 31).sum(0).astype(object)
                    sums = high * (1 << 31) + (x & ((1 << 31) - 1)).sum(0).astype(object)
                    old = held.get(dim)
                    held[dim] = [len(x), sums] if old is None else [old[0] + len(x), old[1] + sums]
        for dim, (n, sums) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
                                              pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))], names=["dim", "at", "n", "s"])

    parts = _vectors(table, id_col, vector_col).mapInArrow(run, "dim int, at int, n long, s decimal(38,0)")
    sums = cut_lineage(parts.groupBy("dim", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
    best = sums.where("n > 0").groupBy("dim").agg(F.max("n").alias("n")).orderBy(F.col("n").desc(), "dim").first()
    if best is None:
        return None
    return Centre(best["n"], [int(r["s"]) for r in sums.where(F.col("dim") == best["dim"]).orderBy("at").collect()])  # one row a dimension


def _summed_products(table: DataFrame, centre: Centre, project: np.ndarray | None, id_col: str, vector_col: str) -> np.ndarray:
    """Covariance of the centred vectors, or of their projections: a matrix, added up row by row of the matrix."""
    d = len(centre.whole)
    width = d if project is None else project.shape[1]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros((width, width))
        for _, x in _batches(batches, d):
            y = centre.centred(x) if project is None else centre.centred(x) @ project
            total += y.T @ y
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "p"])

    cells = _vectors(table, id_col, vector_col).mapInArrow(run, "i int, j int, p double").groupBy("i", "j").agg(F.sum("p").alias("p"))
    out = np.zeros((width, width))
    for r in cells.collect():  # d * (d + 1) / 2 cells
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["p"] / centre.n
    return out


def covariance(table: DataFrame, centre: Centre, id_col: str = "vec_id", vector_col: str = "embedding") -> np.ndarray:
    return _summed_products(table, centre, None, id_col, vector_col)


def count_above(v: np.ndarray, s: float) -> int:
    """Number of eigenvalues of the symmetric matrix above s: positive pivots of v - s (diagonal pivots of 1 x 1 and 2 x 2)."""
    a = v - s * np.eye(len(v))
    alpha, positive = (1 + 17 ** 0.5) / 8, 0
    while len(a):
        diagonal, off = np.abs(np.diag(a)), np.abs(a - np.diag(np.diag(a)))
        k, biggest = int(diagonal.argmax()), off.max(initial=0.0)
        if diagonal[k] >= alpha * biggest:  # also the last 1 x 1, and zero matrices
            pivot = [k]
            positive += bool(a[k, k] > 0)
        else:
            pivot = list(np.unravel_index(off.argmax(), off.shape))
            positive += 1  # a 2 x 2 pivot of this choice is indefinite
        rest = np.setdiff1d(np.arange(len(a)), pivot)
        block = a[np.ix_(pivot, pivot)]
        if len(pivot) == 1 and block[0, 0] == 0:
            a = a[np.ix_(rest, rest)]
            continue
        c = a[np.ix_(rest, pivot)]
        a = a[np.ix_(rest, rest)] - c @ np.linalg.solve(block, c.T)
    return positive


def slices(v: np.ndarray, wanted: int, per_slice: int = 8) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues in (low, high]) from the top of the spectrum down, until ``wanted`` are covered.

    Eigenvalues that bisection can't part share a slice, so one may hold more.
    """
    top = float(np.abs(v).sum(1).max()) * (1 + 1e-9)
    zero = ZERO * top
    wanted = min(wanted, count_above(v, zero))
    out, high, done = [], top, 0
    while done < wanted:
        need = min(done + per_slice, wanted)
        low, up = zero, high  # count_above(low) >= need; up is too high
        while up - low > 1e-9 * top:
            middle = (low + up) / 2
            n = count_above(v, middle)
            if n >= need:
                low = middle
            else:
                up = middle
            if n == need:
                break
        # a cut in the middle of the gap below, or as low as bisection can go
        n, edge, below = count_above(v, low), low, zero
        for _ in range(12):
            middle = (edge + below) / 2
            if count_above(v, middle) == n:
                edge = middle
            else:
                below = middle
        cut = (low + edge) / 2
        out.append((cut, high, n - done))
        high, done = cut, n
    return out


def feast(v: np.ndarray, low: float, high: float, count: int, nodes: int = 8, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, vectors) of the symmetric matrix in (low, high], ``count`` of them by its inertia."""
    d = len(v)
    size = min(d, count + count // 2 + 4)
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(nodes)
    angles = np.pi / 2 * (points + 1)  # the upper half: the lower one gives the conjugates
    turn = np.exp(1j * angles)
    tolerance = 64 * np.finfo(float).eps * np.abs(v).sum(1).max()
    rng = np.random.default_rng(seed)
    y, best = rng.standard_normal((d, size)), None
    for round_ in range(60):
        q = np.zeros((d, y.shape[1]))
        for w, e in zip(weights, turn, strict=True):
            q += np.real(w / 2 * radius * e * np.linalg.solve((centre + radius * e) * np.eye(d) - v, y))
        q = np.linalg.qr(q)[0]
        values, inner = np.linalg.eigh(q.T @ v @ q)
        y = q @ inner
        inside = (values > low) & (values <= high)
        off = np.linalg.norm(v @ y[:, inside] - y[:, inside] * values[inside], axis=0)
        if inside.sum() == count:
            worst = off.max(initial=0.0)
            if best is None or worst < best[0]:
                best = (worst, values[inside], y[:, inside])
            if worst <= tolerance:
                break
        if round_ % 15 == 14 and y.shape[1] < d and (best is None or best[0] > tolerance):
            y = np.hstack([y, rng.standard_normal((d, min(d - y.shape[1], size)))])
    if best is None or best[0] > 1e6 * tolerance:
        raise ArithmeticError(f"eigenvalues in ({low}, {high}]: {count} by inertia, not all found")
    return best[1], best[2]


def principal(v: np.ndarray, wanted: int, spark=None, per_slice: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (fewer, where the rest are zero), falling, and unit vectors; slices run as tasks of ``spark``."""
    cuts = slices(v, wanted, per_slice)
    if not cuts:
        return np.zeros(0), np.zeros((len(v), 0))
    if spark is None or len(cuts) == 1:
        found = [feast(v, *c) for c in cuts]
    else:
        def run(frames):
            import pandas as pd

            for frame in frames:
                for r in frame.itertuples():
                    values, vectors = feast(v, r.low, r.high, r.count)
                    yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

        table = spark.createDataFrame([(float(a), float(b), int(n)) for a, b, n in cuts], "low double, high double, count int").repartition(len(cuts), "low")
        rows = table.selectExpr("low", "high", "count").mapInPandas(run, "value double, vector array<double>").collect()  # at most 2 * wanted vectors
        found = [(np.array([r["value"]]), np.array([r["vector"]]).T) for r in rows]
    q = np.linalg.qr(np.hstack([x[1] for x in found]))[0]
    values, inner = np.linalg.eigh(q.T @ v @ q)
    order = np.argsort(-values)[:wanted]
    return values[order], (q @ inner)[:, order]


def whiten(table: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per vector of the fit and component.

    Entries c become floor(64 * c) + 1000000, held within 61 bits.  Vectors that
    are null, empty, hold null or non-finite entries or aren't of the table's
    dimension (``fit_centre``) give no row; repeated rows and null ids count like
    any other.  ``deviation`` is decimal(38,0), null beyond that.  Components of eigenvalue zero
    can't be whitened and are left out, so a table whose vectors are all equal, or
    an empty one, gives none.
    """
    spark = table.sparkSession
    schema = "vec_id long, n long, deviation decimal(38,0), values array<double>"
    centre = fit_centre(table, id_col, vector_col)
    out = ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
    if centre is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    v = covariance(table, centre, id_col, vector_col)
    values, vectors = principal(v, min(components, len(v)), spark)
    project = vectors / np.sqrt(values) if len(values) else vectors
    error = 0.0
    if len(values):
        error = float(np.abs(_summed_products(table, centre, project, id_col, vector_col) - np.eye(len(values))).max())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for ids, x in _batches(batches, len(centre.whole), 1 << 20):
            y = centre.centred(x) @ project
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1]), pa.array(y.ravel()))
            deviations = pa.array([Decimal(s) if s < 10 ** 38 else None for s in centre.deviations(x)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([centre.n] * len(ids), pa.int64()), deviations, flat],
                                             names=["vec_id", "n", "deviation", "values"])

    rows = _vectors(table, id_col, vector_col).mapInArrow(run, schema).select("vec_id", "n", "deviation", F.posexplode("values").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(e / np.trace(v))) for e in values]) if len(values) else F.array().cast("array<double>")
    return rows.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                       F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")).select(*out)
