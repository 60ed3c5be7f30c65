"""Embedding whitening by QDWH spectral divide and conquer.

The covariance is summed in Spark, exactly, over the distinct vectors. Its polar factor after a shift, by the dynamically
weighted Halley iteration, is the matrix sign: it has eigenvalue 1 on the invariant subspace above the shift and -1 below.
The spectral projectors give an orthonormal basis of both, the covariance falls into two blocks, and each is split again
until it is one dimension or a multiple of the identity. What is decomposed has the size of a vector squared, whatever the
number of rows; the components then go to all tasks, which whiten their rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docgrain.llm.common import materialize, read_table

SCALE, COMPONENTS = 256, 4
#: Scaled entries beyond this size count as this size, so that exact sums of products fit 38 digits.
LARGEST = 1 << 47
EPS = np.finfo(np.float64).eps


# --- the decomposition ----------------------------------------------------------------------------------------------------
def polar_factor(a: np.ndarray, most: int = 30) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix: the signs of its eigenvalues on its eigenvectors.

    The weights of a step come from a lower bound of the least singular value, so that some six steps do; the first ones,
    of large weight, by QR, the later ones by Cholesky.
    """
    m = len(a)
    x = a / np.linalg.norm(a)
    try:
        low = min(1.0, 1 / np.linalg.norm(np.linalg.inv(x)))
    except np.linalg.LinAlgError:
        low = 0.0
    low, one = max(low, EPS), np.eye(m)
    for _ in range(most):
        d = (4 * (1 - low**2) / low**4) ** (1 / 3)
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low**2) / (low**2 * root))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, one]))[0]
            step = (wa - wb / wc) / np.sqrt(wc) * (q[:m] @ q[m:].T)
        else:
            w = np.linalg.cholesky(one + wc * (x.T @ x))
            step = (wa - wb / wc) * np.linalg.solve(w.T, np.linalg.solve(w, x.T)).T
        new = wb / wc * x + step
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
        if 1 - low < 10 * EPS and moved < EPS ** (1 / 3):
            break
    return x


def _halves(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift near the mean eigenvalue; None if none parts."""
    m = len(a)
    mean = np.trace(a) / m
    spread = np.linalg.norm(a - mean * np.eye(m)) / np.sqrt(m)
    start = np.random.default_rng(m).normal(size=(m, m))
    best = None
    for off in (0.0, 0.21, -0.17, 0.43, -0.37):  # a shift that meets an eigenvalue is moved aside
        sign = polar_factor(a - (mean + off * spread) * np.eye(m))
        above = int(round((m + np.trace(sign)) / 2))
        if not 0 < above < m:
            continue
        upper = (np.eye(m) + sign) / 2
        q = np.linalg.qr(np.hstack([upper @ start[:, :above], start[:, above:] - upper @ start[:, above:]]))[0]
        for _ in range(2):
            q = np.linalg.qr(np.hstack([upper @ q[:, :above], q[:, above:] - upper @ q[:, above:]]))[0]
        left = np.linalg.norm(q[:, :above].T @ a @ q[:, above:])
        if best is None or left < best[0]:
            best = (left, q[:, :above], q[:, above:])
        if left <= 10 * m * EPS * scale:
            break
    return best[1:] if best else None


def eigenvectors(v: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns, by spectral
    divide and conquer; the largest entry of each is positive. Subspaces below the wanted ones are not split."""
    most, scale = min(len(v), most or len(v)), np.linalg.norm(v)
    found, stack = [], [np.eye(len(v))]
    while stack and len(found) < most:
        basis = stack.pop()
        block = basis.T @ v @ basis
        block = (block + block.T) / 2
        m = basis.shape[1]
        same = np.linalg.norm(block - np.trace(block) / m * np.eye(m)) <= EPS * scale
        halves = None if m == 1 or same else _halves(block, scale)
        if halves is None:
            found += list(basis.T)
        else:
            stack += [basis @ halves[1], basis @ halves[0]]
    vectors = np.array(found).T if found else np.zeros((len(v), 0))
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")[:most]
    vectors = vectors[:, order]
    flip = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return values[order], vectors * flip


# --- sums over the rows ---------------------------------------------------------------------------------------------------
def _usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def scaled(vectors: DataFrame) -> DataFrame:
    """vec_id, d (the length), x (whole numbers) of the rows whose vector takes part."""
    wide = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(_usable(F.col("v")))
    most = F.lit(float(LARGEST))
    return wide.select("vec_id", F.size("v").alias("d"), F.transform("v", lambda c: F.least(F.greatest(F.floor(F.least(F.greatest(c * SCALE, -most), most)), F.lit(-LARGEST)), F.lit(LARGEST))).alias("x"))


def _by_length(batch: pa.RecordBatch, column: str = "x") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each length in a batch, the places of its rows and their vectors."""
    lists = batch.column(batch.schema.get_field_index(column))
    flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    for d in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == d)
        yield d, at, flat[starts[at][:, None] + np.arange(d)]


def exact_products(c: np.ndarray) -> np.ndarray:
    """The exact sum over rows of the products of whole numbers: in doubles as long as these are exact, else in integers."""
    largest = int(np.abs(c).max(initial=0)) ** 2
    if largest >= 1 << 53:
        c = c.astype(object)
        return c.T @ c
    rows, total = (1 << 53) // max(1, largest), np.zeros((c.shape[1],) * 2, object)
    for first in range(0, len(c), rows):
        part = c[first : first + rows].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """n and the sums by dimension of each length: as many numbers as a vector has, for each length that occurs."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for d, _, x in _by_length(batch):
                n, s = held.get(d, (0, np.zeros(d, object)))
                safe = len(x) * int(np.abs(x).max(initial=0)) < 1 << 62
                held[d] = (n + len(x), s + x.sum(0, dtype=np.int64 if safe else object).astype(object))
        rows = [(d, i, n, Decimal(v)) for d, (n, s) in held.items() for i, v in enumerate(s.tolist())]
        yield _batch(rows, [("d", pa.int32()), ("i", pa.int32()), ("n", pa.int64()), ("v", pa.decimal128(38, 0))])

    summed = fit.mapInArrow(of, "d int, i int, n long, v decimal(38,0)").groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("v").cast("decimal(38,0)").alias("v"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(summed.collect()):
        out.setdefault(r.d, (r.n, []))[1].append(int(r.v))
    return out


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, fields)], [name for name, _ in fields])


def _components(fit: DataFrame, sums: dict, most: int) -> DataFrame:
    """d, component, vector, e (its eigenvalue), trace: of each length the leading eigenvectors of its covariance.

    Vectors are centred on the whole number next to the mean before they are multiplied, so sums of products are exact
    whatever the order, and the small rest of the mean is taken off in whole numbers too.
    """
    near = {d: np.array([(2 * v + n) // (2 * n) for v in s]) for d, (n, s) in sums.items()}

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in _by_length(batch):
                held[d] = held.get(d, 0) + exact_products(x - near[d])
        rows = [(d, i, j, Decimal(m[i, j])) for d, m in held.items() for i in range(d) for j in range(i, d)]
        yield _batch(rows, [("d", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("v", pa.decimal128(38, 0))])

    def decompose(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        d = int(key[0])
        n, s = sums[d]
        v = np.zeros((d, d))
        rest = [a - n * int(b) for a, b in zip(s, near[d])]
        for i, j, total in zip(cells["i"], cells["j"], cells["v"]):
            v[i, j] = v[j, i] = (n * int(total) - rest[i] * rest[j]) / n**2
        values, vectors = eigenvectors(v, most)
        return pd.DataFrame({"d": d, "component": np.arange(1, len(values) + 1), "vector": list(vectors.T), "e": values, "trace": np.trace(v)})

    cells = fit.mapInArrow(of, "d int, i int, j int, v decimal(38,0)").groupBy("d", "i", "j").agg(F.sum("v").cast("decimal(38,0)").alias("v"))
    return cells.groupBy("d").applyInPandas(decompose, "d int, component int, vector array<double>, e double, trace double")


class Whitening:
    """What one length needs: n, S, components, eigenvalues and the trace of the covariance."""

    def __init__(self, n: int, s: list[int], rows: list):
        rows = sorted(rows, key=lambda r: r.component)
        self.n, self.s = n, s
        self.vectors = np.array([r.vector for r in rows]).T
        self.e, self.trace = np.array([r.e for r in rows]), rows[0].trace
        self.error = None
        self.rank = self.e > len(s) * EPS * max(self.trace, 0.0)  # others have no variance to divide by

    def moved(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exact."""
        if self.n * int(np.abs(x).max(initial=0)) < 1 << 61 and max(map(abs, self.s)) < 1 << 61:
            return self.n * x - np.array(self.s, np.int64)
        return self.n * x.astype(object) - np.array(self.s, object)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sums of squares of n*x - S; None where one passes a long."""
        y = self.moved(x)
        if int(np.abs(y).max(initial=0)) ** 2 * y.shape[1] >= 1 << 63:
            y = y.astype(object)
        return [int(v) if v < 1 << 63 else None for v in (y * y).sum(1)]

    def white(self, x: np.ndarray) -> np.ndarray:
        """Rows projected on the components over the root of their variance; not a number for a component without any."""
        root = np.sqrt(np.where(self.rank, self.e, np.nan))
        return (self.moved(x).astype(np.float64) / self.n) @ self.vectors / root


def fit_whitening(fit: DataFrame, most: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of each length of ``fit`` (d, x: each vector once), with its measured error.

    What comes to the driver has the size of some vectors a length, whatever the number of rows.
    """
    sums = _sums(fit)
    if not sums:
        return {}
    by: dict[int, list] = {}
    for r in _components(fit, sums, most).collect():
        by.setdefault(r.d, []).append(r)
    fitted = {d: Whitening(*sums[d], rows) for d, rows in by.items()}

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in _by_length(batch):
                w = fitted[d].white(x)
                w = np.hstack([np.ones((len(w), 1)), w])
                held[d] = held.get(d, 0) + w.T @ w
        rows = [(d, i, j, float(m[i, j])) for d, m in held.items() for i in range(len(m)) for j in range(i, len(m))]
        yield _batch(rows, [("d", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("v", pa.float64())])

    totals = fit.mapInArrow(of, "d int, i int, j int, v double").groupBy("d", "i", "j").agg(F.sum("v").alias("v"))
    cells = {(r.d, r.i, r.j): r.v for r in totals.collect()}
    for d, w in fitted.items():
        means = [cells[d, 0, i + 1] / w.n for i in range(len(w.e))]
        errors = [abs(cells[d, i + 1, j + 1] / w.n - means[i] * means[j] - (i == j)) for i in range(len(w.e)) for j in range(i, len(w.e)) if w.rank[i] and w.rank[j]]
        w.error = max(errors, default=None)
    return fitted


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable vector and component.

    Null vectors, empty ones and such with null or non-finite entries are dropped. The covariance is that of the distinct
    scaled vectors; vectors of different lengths are different spaces, each with its own. Vectors of fewer entries than
    ``components`` have as many components as entries. A component without variance has whitened null and explained 0 (null
    where nothing varies at all); ``deviation`` is null where it passes a long; entries beyond 2**39 in size count as
    that. Rows without an id and repeated rows stay; an empty table gives an empty result; other columns are ignored.
    """
    rows = scaled(vectors)
    fit = materialize(rows.select("d", "x").distinct(), "whiten-fit")
    fitted = fit_whitening(fit, components)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, at, x in _by_length(batch):
                w = fitted[d]
                k, white = len(w.e), w.white(x)
                explained = [max(0.0, v) * r / w.trace if w.trace > 0 else None for v, r in zip(w.e.tolist(), w.rank.tolist())]
                arrays = [
                    batch.column(0).take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))), pa.array(np.full(len(at) * k, w.n)),
                    pa.array(w.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))), pa.array(white.ravel(), pa.float64(), from_pandas=True),
                    pa.array(explained * len(at), pa.float64()), pa.array([w.error] * (len(at) * k), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "x").mapInArrow(of, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def op11_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))
