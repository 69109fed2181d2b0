"""Operator 12: embedding whitening by pivoted Cholesky and one-sided Jacobi.

An entry c becomes the integer x = floor(SCALE * c) + OFFSET. Two scans gather what
the fit needs: exact sums per dimension, then the scatter of the vectors centred on
S / n (subtracted as integer and fraction, before anything is multiplied). The scatter,
dimension x dimension, is the only thing the driver sees:

* pivoted Cholesky: P' M P = L L', the largest remaining diagonal entry first, up to
  the numerical rank, so L's columns fall in norm;
* one-sided Jacobi on L itself: pairs of columns are rotated until all are orthogonal.
  Squared column norms are the eigenvalues of M, normalised columns its eigenvectors.

Whitened rows are written once; their covariance (``covar_pop``, centred as it
goes) against the identity is the ``identity_error`` every row carries.

Scale: no row is shuffled. A task sends one partial sum a dimension and one partial
scatter entry a pair of dimensions, whatever its rows; these are added up by group-bys.

Defined cases: vectors that are null or hold null or non-finite entries are dropped;
so are vectors whose length is not the most frequent one (of equally frequent, the
longest) and empty ones; repeated rows and null or repeated ids count and return
as often as they stand; components without variance (fewer vectors than dimensions,
constant or dependent entries, one vector only) are not returned; an empty table gives
an empty result; x saturates at +-2^61; a deviation beyond a long is null in
``deviation`` and exact in ``deviation_text``; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketscope.llm.common import written

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
VEC, KEY = "__ms_vec", "__ms_key"
LIMIT = float(1 << 62)
CLIP = float(1 << 61)
SWEEPS = 60


@dataclass(frozen=True)
class Whitening:
    """A fit: n vectors, their sums, and the leading components (rows) with their eigenvalues of x's covariance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def usable(vector: Column) -> Column:
    """Neither null nor empty, and without null or non-finite entries."""
    fine = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False))


def vectors(table: DataFrame, vector: str, key: str) -> DataFrame:
    vec = F.col(f"`{vector}`").cast("array<double>")
    return table.select(F.col(f"`{key}`").alias(KEY), vec.alias(VEC)).where(usable(F.col(VEC)))


def entries(column: pa.Array, dim: int) -> np.ndarray:
    """The x-vectors of a list column whose rows all have ``dim`` entries."""
    c = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * c), -CLIP, CLIP).astype(np.int64) + OFFSET


def exact_sum(x: np.ndarray) -> list[int]:
    small = not len(x) or float(np.abs(x.astype(np.float64)).max()) * len(x) < LIMIT
    return [int(v) for v in (x if small else x.astype(object)).sum(axis=0)]


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array]]:
    for batch in batches:
        col = batch.column(VEC)
        sizes = np.asarray(col.value_lengths().to_numpy(zero_copy_only=False))
        for d in np.unique(sizes):
            yield int(d), col if (sizes == d).all() else col.filter(pa.array(sizes == d))


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, list] = {}
    for d, col in _by_length(batches):
        n, s = found.get(d, (0, [0] * d))
        found[d] = (n + len(col), [a + b for a, b in zip(s, exact_sum(entries(col, d)))])
    for d, (n, s) in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
             pa.array([str(v) for v in s])], names=["dim", "i", "n", "s"])


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - S/n in double precision: the integer part is subtracted exactly."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def gather(rows: DataFrame) -> tuple[int, tuple[int, ...]]:
    """(n, sums) of the vectors of the most frequent length; (0, ()) without any."""
    sums = (rows.select(VEC).mapInArrow(_partial_sums, "dim int, i int, n long, s string")
            .groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")))
    top = (sums.groupBy("dim").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "s"))).alias("s"))
           .orderBy(F.desc("n"), F.desc("dim")).first())
    return (top["n"], tuple(int(r["s"]) for r in top["s"])) if top else (0, ())


def scatter(rows: DataFrame, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """Sum of the products of centred entries, dimension x dimension."""
    dim = len(sums)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_row = np.zeros((dim, dim)), False
        for d, col in _by_length(batches):
            if d == dim:
                y = centred(entries(col, d), n, sums)
                total += y.T @ y
                any_row = True
        if any_row:
            i, j = np.triu_indices(dim)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                             names=["i", "j", "v"])

    got = (rows.select(VEC).mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
           .toPandas())
    m = np.zeros((dim, dim))
    m[got["i"], got["j"]] = got["v"]
    return m + np.triu(m, 1).T


def pivoted_cholesky(m: np.ndarray) -> np.ndarray:
    """Columns L with L L' = m (rows in m's order), by complete diagonal pivoting up to the numerical rank."""
    d = len(m)
    left, diag = m.copy(), np.diag(m).copy()
    floor = d * np.finfo(float).eps * max(diag.max(initial=0.0), 0.0)
    columns, done = [], np.zeros(d, dtype=bool)
    for _ in range(d):
        p = int(np.argmax(np.where(done, -np.inf, diag)))
        if not diag[p] > floor:
            break
        col = np.where(done, 0.0, left[:, p]) / np.sqrt(diag[p])
        left -= np.outer(col, col)
        done[p] = True
        diag = np.diag(left).copy()
        columns.append(col)
    return np.array(columns).T if columns else np.zeros((d, 0))


def rounds(k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of k columns in rounds of disjoint pairs (a round-robin tournament)."""
    ring = list(range(k + k % 2))
    out = []
    for _ in range(len(ring) - 1):
        pairs = [(min(a, b), max(a, b)) for a, b in zip(ring[:len(ring) // 2], reversed(ring[len(ring) // 2:])) if max(a, b) < k]
        if pairs:
            out.append((np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as rows) of factor factor', falling, by rotating the factor's columns."""
    a = factor.T.copy()                      # one row per column of the factor
    tol = np.finfo(float).eps * np.sqrt(max(len(a), 1))
    schedule = rounds(len(a))
    for _ in range(SWEEPS):
        worst = 0.0
        for p, q in schedule:
            x, y = a[p], a[q]
            xx, yy, xy = (x * x).sum(1), (y * y).sum(1), (x * y).sum(1)
            off = np.abs(xy) / np.sqrt(np.maximum(xx * yy, np.finfo(float).tiny))
            worst = max(worst, float(off.max()))
            turn = off > tol
            zeta = (yy - xx) / np.where(turn, 2.0 * xy, 1.0)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1.0 / np.hypot(1.0, t)
            s = c * t
            a[p], a[q] = c[:, None] * x - s[:, None] * y, s[:, None] * x + c[:, None] * y
        if worst <= tol:
            break
    values = (a * a).sum(1)
    order = np.argsort(-values, kind="stable")
    units = a[order] / np.sqrt(values[order])[:, None]
    if len(units):                           # a fixed sign: the largest entry is positive
        units *= np.sign(units[np.arange(len(units)), np.abs(units).argmax(axis=1)])[:, None]
    return values[order], units


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the rows of ``vectors``; None if nothing varies."""
    n, sums = gather(rows)
    if not n:
        return None
    m = scatter(rows, n, sums)
    values, units = jacobi(pivoted_cholesky(m))
    if not len(values):
        return None
    return Whitening(n, sums, units[:components], values[:components] / n, float(np.trace(m)) / n)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """Exact sum over dimensions of (n x - S)^2 of each row."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=np.int64)
    gap = x - whole
    most = float(np.abs(gap.astype(np.float64)).max(initial=0.0)) * n + n
    if most * most * len(sums) < LIMIT:
        z = gap * n - rest
        return (z * z).sum(axis=1).tolist()
    z = gap.astype(object) * n - rest.astype(object)
    return [int(v) for v in (z * z).sum(axis=1)]


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """``KEY``, deviation, deviation_text, w (one entry a component), one row per vector of the fit."""
    n, sums, dim = model.n, model.sums, len(model.sums)
    basis = (model.components / np.sqrt(model.eigenvalues)[:, None]).T
    key_type = next(f.dataType.simpleString() for f in rows.schema if f.name == KEY)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(VEC)
            same = pa.array(np.asarray(col.value_lengths().to_numpy(zero_copy_only=False)) == dim)
            x = entries(col.filter(same), dim)
            dev = deviations(x, n, sums)
            w = centred(x, n, sums) @ basis
            yield pa.RecordBatch.from_arrays(
                [batch.column(KEY).filter(same), pa.array([v if v < 1 << 63 else None for v in dev], pa.int64()),
                 pa.array([str(v) for v in dev], pa.string()), pa.array(list(w), pa.list_(pa.float64()))],
                names=[KEY, "deviation", "deviation_text", "w"])

    return rows.mapInArrow(project, f"{KEY} {key_type}, deviation long, deviation_text string, w array<double>")


def identity_error(white: DataFrame, k: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    pairs = list(combinations_with_replacement(range(k), 2))
    got = white.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(got[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def embedding_whitening(table: DataFrame, vector: str = "embedding", key: str = "vec_id",
                        components: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error, eigenvalue, deviation_text: one row per vector and component."""
    rows = vectors(table, vector, key)
    model = fit(rows, components)
    if model is None:
        cols = "component int, n long, deviation long, whitened double, explained double, identity_error double, " \
               "eigenvalue double, deviation_text string"
        key_type = next(f.dataType.simpleString() for f in rows.schema if f.name == KEY)
        return table.sparkSession.createDataFrame([], f"`{key}` {key_type}, {cols}")
    white = written(whiten(rows, model), "whitened")
    k = len(model.eigenvalues)
    error = identity_error(white, k)
    share = F.array(*[F.lit(float(v / model.trace)) for v in model.eigenvalues])
    value = F.array(*[F.lit(float(v)) for v in model.eigenvalues])
    return (white.select(KEY, "deviation", "deviation_text", F.posexplode("w").alias("at", "whitened"))
            .select(F.col(KEY).alias(key), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                    "deviation", "whitened", share[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
                    value[F.col("at")].alias("eigenvalue"), "deviation_text"))
