"""Approximate nearest neighbours by shifted space-filling curves.

Several Hilbert orderings of randomly turned, projected and shifted vectors are cut into cells of about equal numbers of
rows. A query meets the rows of its own cell and of the two next to it on each curve; its best rows of each cell merge
over all cells and curves and are ranked by exact scores. Cells with many rows, and many queries, are cut into blocks.

How many cells a curve gets is fitted: the exact neighbours of a bounded number of queries are found over the whole table,
and cells are the most, up to a bound that grows with the table, for which those neighbours lie in the windows with the
wanted recall. Where vectors have structure cells are many and a query meets few rows; vectors spread evenly in many
dimensions leave wide cells, as no ordering then keeps neighbours together.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docgrain.llm.common import materialize, read_table, uniform

CURVES, DIMENSIONS, BITS = 12, 4, 12
#: Rows that the ranges of the axes are fitted on, queries among them whose exact neighbours are sought, and rows whose keys
#: place the cuts (about as many at most).
SAMPLE, SAMPLE_QUERIES, SAMPLE_KEYS = 4096, 256, 1 << 17
RECALL = 0.96
#: Rows that a cell is to hold at least, on average.
ROWS_PER_CELL = 32
ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 16_384, 4_096
#: Lengths of vectors that get curves of their own, the most frequent ones; the rest is compared exactly, in blocks.
FITTED_LENGTHS = 16


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions on the Hilbert curve of points with whole coordinates of ``bits`` bits; one column a dimension.

    Each level turns the axes so that the curve leaves a cube where the next one begins; the Gray code of the turned
    bits, level by level, is the position.
    """
    x = [points[:, k].astype(np.uint64).copy() for k in range(points.shape[1])]
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for k in range(len(x)):
            on = (x[k] & bit) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[k]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[k] = x[k] ^ swap
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(level)) & np.uint64(1) != 0, np.uint64((1 << level) - 1), np.uint64(0))
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for v in x:
            key = (key << np.uint64(1)) | (((v ^ turn) >> np.uint64(level)) & np.uint64(1))
    return key


class Curves:
    """The fitted orderings: turned axes, shifts, ranges and the cuts between cells of each curve."""

    def __init__(self, sample: np.ndarray, curves: int = CURVES, dimensions: int = DIMENSIONS, seed: int = 0):
        random = np.random.default_rng(seed)
        dim = sample.shape[1]
        d = min(dimensions, dim)
        self.axes = [np.linalg.qr(random.normal(size=(dim, d)))[0] for _ in range(curves)]
        self.shift = [random.random(d) for _ in range(curves)]
        self.low = [(sample @ a).min(0) for a in self.axes]
        self.span = [np.maximum((sample @ a).max(0) - low, 1e-12) for a, low in zip(self.axes, self.low)]
        self.cells, self.held = 1, [np.zeros(1)] * curves

    def cut(self, keys: np.ndarray, asked: np.ndarray, near: np.ndarray, most: float, recall: float) -> None:
        """Cut curves to as many cells, ``most`` at most, as leave ``recall`` of the pairs (``asked``, ``near``) together.

        What is held are ordered keys of sampled rows (one column a curve); cells are equal shares of the rows as these keys
        have it, in straight lines between them, so their number may grow with the table while the sample stays.
        """
        if not len(near) or not len(keys):
            return
        self.held = list(np.sort(keys, axis=0).T.astype(np.float64))
        cells = 4
        while cells <= most:
            found = np.zeros(len(near), bool)
            for c in range(len(self.held)):
                found |= np.abs(self._cells(c, near[:, c], cells) - self._cells(c, asked[:, c], cells)) <= 1
            if found.mean() < recall:
                break
            self.cells = cells
            cells = cells * 3 // 2 if cells & (cells - 1) == 0 else cells * 4 // 3

    def _cells(self, curve: int, keys: np.ndarray, cells: int) -> np.ndarray:
        held = self.held[curve]
        at = np.interp(keys.astype(np.float64), held, (np.arange(len(held)) + 0.5) / len(held))
        return np.minimum((at * cells).astype(np.int64), cells - 1)

    def all_keys(self, x: np.ndarray) -> np.ndarray:
        return np.stack([self.keys(c, x) for c in range(len(self.axes))], axis=1)

    def keys(self, curve: int, x: np.ndarray) -> np.ndarray:
        unit = np.clip((x @ self.axes[curve] - self.low[curve]) / self.span[curve], 0, 1)
        return hilbert_keys(((unit + self.shift[curve]) / 2 * ((1 << BITS) - 1)).astype(np.int64))

    def cell(self, curve: int, x: np.ndarray) -> np.ndarray:
        return self._cells(curve, self.keys(curve, x), self.cells)


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, not zero, all components there and finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column(1)
    n = len(values)
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _cells(rows: DataFrame, fitted: Curves, width: int) -> DataFrame:
    """curve, cell, vec_id, vector (bytes of doubles), spread: the rows of cells ``cell - width`` to ``cell + width``."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors(batch)
            packed = pa.array([v.tobytes() for v in x], pa.binary())
            ids = batch.column(0)
            for c in range(len(fitted.axes)):
                cell = fitted.cell(c, x)
                for step in range(-width, width + 1):
                    ok = np.flatnonzero((cell + step >= 0) & (cell + step < fitted.cells))
                    take = pa.array(ok)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ok), c, np.int32)), pa.array((cell[ok] + step).astype(np.int32)), ids.take(take), packed.take(take)], ["curve", "cell", "vec_id", "vector"])

    return rows.mapInArrow(of, "curve int, cell int, vec_id long, vector binary")


def _nearest(k: int):
    """Of each query of a block the ``k`` nearest ids there, by the best exact score of each, ties to the smaller id."""

    def of(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(rows) and len(queries):
            x = np.frombuffer(b"".join(rows["vector"]), np.float64).reshape(len(rows), -1)
            ids = rows["vec_id"].to_numpy()
            starts = np.arange(len(ids))
            if len(np.unique(ids)) < len(ids):  # rows of one id side by side, so that k counts ids
                by_id = np.argsort(ids, kind="stable")
                x, ids = x[by_id], ids[by_id]
                starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            for first in range(0, len(queries), 256):
                some = queries.iloc[first : first + 256]
                y = np.frombuffer(b"".join(some["vector"]), np.float64).reshape(len(some), -1)
                rough = y @ x.T
                size, longest = np.sqrt((y * y).sum(1)), np.sqrt((x * x).sum(1).max())
                for q, own in enumerate(some["vec_id"].to_numpy()):
                    s = rough[q]
                    s[ids == own] = -np.inf
                    each = np.maximum.reduceat(s, starts) if len(starts) < len(s) else s
                    cut = np.partition(each, len(each) - k)[len(each) - k] if len(each) > k else -np.inf
                    near = np.flatnonzero((s >= cut - 1e-12 * len(y[q]) * size[q] * longest) & (s > -np.inf))  # rough scores may differ in last bits
                    exact = (x[near] * y[q]).sum(1)
                    best = np.lexsort((ids[near], -exact))
                    if len(starts) < len(s):
                        best = best[np.sort(np.unique(ids[near][best], return_index=True)[1])]  # the best row of each id, best id first
                    best = best[:k]
                    out["query_id"].append(np.full(len(best), own))
                    out["vec_id"].append(ids[near][best])
                    out["score"].append(exact[best])
        return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, np.float64 if c == "score" else np.int64) for c, v in out.items()})

    return of


def nearest_neighbours(vectors: DataFrame, queries: Column, k: int = 20, recall: float = RECALL, seed: int = 0) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each row of ``vectors`` that ``queries`` holds for.

    Nearest is the largest inner product in double precision. Null, zero and non-finite vectors, and rows without an id,
    take no part. Vectors are compared with those of their own length; curves are fitted to the ``FITTED_LENGTHS`` most
    frequent lengths, and vectors of others meet all of their length, in blocks. Rows that share an id count as one candidate with their best score and never find each other; ties go to the smaller id; fewer candidates give
    fewer rows; an empty table gives an empty result; other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), queries.alias("is_query"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable("vector"))
    counted = rows.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows"))
    lengths = sorted(r.n for r in counted.orderBy(F.desc("rows"), "n").limit(FITTED_LENGTHS + 1).collect()[:FITTED_LENGTHS])
    if not lengths:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    parts = [_found(rows.where(F.size("vector") == n), k, recall, seed) for n in lengths]
    if len(lengths) == FITTED_LENGTHS:
        parts.append(_compared(rows.where(~F.size("vector").isin(lengths)), k))
    found = reduce(DataFrame.unionByName, parts)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _exact_neighbours(rows: DataFrame, ids: np.ndarray, asked: np.ndarray, fitted: Curves, k: int) -> DataFrame:
    """q, vec_id, score, keys: the ``k`` nearest ids of each vector of ``asked`` over all ``rows``; each task keeps its own best."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[dict[int, tuple[float, np.ndarray]]] = [{} for _ in ids]
        for batch in batches:
            if not batch.num_rows:
                continue
            x, own = _vectors(batch), batch.column(0).to_numpy()
            for first in range(0, len(x), 4096):
                part = slice(first, first + 4096)
                scores = asked @ x[part].T
                scores[ids[:, None] == own[part][None, :]] = -np.inf
                for q, s in enumerate(scores):
                    # rows of one id may fill the best places: the floor is the kth id held, not the kth row
                    floor = min((v for v, _ in best[q].values()), default=-np.inf) if len(best[q]) >= k else -np.inf
                    for at in np.flatnonzero(s > floor)[np.argsort(-s[s > floor], kind="stable")].tolist():
                        if len(best[q]) >= k and s[at] <= floor:
                            break
                        i = int(own[first + at])
                        if s[at] > best[q].get(i, (-np.inf, x[0]))[0]:
                            best[q][i] = (float(s[at]), x[first + at].copy())
                            if len(best[q]) > k:
                                del best[q][min(best[q], key=lambda i, held=best[q]: held[i][0])]
                        if len(best[q]) >= k:
                            floor = min(v for v, _ in best[q].values())
        rows_of = [(q, i, v, row) for q, held in enumerate(best) for i, (v, row) in held.items()]
        keys = fitted.all_keys(np.array([row for *_, row in rows_of])) if rows_of else []
        flat = [(q, i, v, key.tobytes()) for (q, i, v, _), key in zip(rows_of, keys)]
        yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in flat], t) for n, t in enumerate((pa.int32(), pa.int64(), pa.float64(), pa.binary()))], ["q", "vec_id", "score", "keys"])

    found = rows.select("vec_id", "vector").mapInArrow(of, "q int, vec_id long, score double, keys binary")
    merged = found.groupBy("q", "vec_id").agg(F.max(F.struct("score", "keys")).alias("best")).select("q", "vec_id", "best.score", "best.keys")
    return merged.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)


def fit(rows: DataFrame, k: int = 20, recall: float = RECALL, seed: int = 0) -> Curves:
    """Curves for ``rows`` (vec_id, vector of one length), from bounded samples and exact neighbours over all rows."""
    # one vector an id: copies would fill the sample
    by_hash = [F.xxhash64("vec_id", F.lit(seed)), F.col("vec_id")]
    chosen = rows.select("vec_id").distinct().orderBy(*by_hash).limit(SAMPLE)
    sample = rows.join(F.broadcast(chosen), "vec_id").groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy(*by_hash).collect()
    vectors = np.array([r.vector for r in sample])
    fitted = Curves(vectors, seed=seed)
    asked, ids = vectors[:SAMPLE_QUERIES], np.array([r.vec_id for r in sample[:SAMPLE_QUERIES]])
    near = _exact_neighbours(rows, ids, asked, fitted, k).select("q", "keys").collect()

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([fitted.all_keys(_vectors(batch)).tobytes()], pa.binary())], ["keys"])

    n = rows.agg(F.approx_count_distinct("vec_id").alias("n")).first().n
    picked = rows.where(uniform(F.col("vec_id"), F.lit(seed + 1)) < SAMPLE_KEYS / max(n, 1)).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    unpack = lambda parts: np.frombuffer(b"".join(parts), np.uint64).reshape(-1, CURVES)
    keys = unpack(bytes(r.keys) for r in picked.mapInArrow(keys_of, "keys binary").collect())
    fitted.cut(keys, fitted.all_keys(asked)[[r.q for r in near]], unpack(bytes(r.keys) for r in near), n / ROWS_PER_CELL, recall)
    return fitted


def _found(rows: DataFrame, k: int, recall: float, seed: int) -> DataFrame:
    """query_id, vec_id, score: the best of each block that queries meet, over vectors of one length."""
    fitted = fit(rows, k, recall, seed)
    placed = materialize(_cells(rows.select("vec_id", "vector"), fitted, 0), "nn-rows")
    asked = materialize(_cells(rows.where("is_query").select("vec_id", "vector"), fitted, 1), "nn-queries")
    return _met(placed, asked, ["curve", "cell"], k)


def _compared(rows: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: the best of each block, all queries against all rows of their length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.array(v, np.float64) for v in batch.column(1).to_pylist()]
            arrays = [pa.array([len(v) for v in values], pa.int32()), batch.column(0), pa.array([v.tobytes() for v in values], pa.binary()), batch.column(2)]
            yield pa.RecordBatch.from_arrays(arrays, ["length", "vec_id", "vector", "is_query"])

    packed = materialize(rows.mapInArrow(pack, "length int, vec_id long, vector binary, is_query boolean"), "nn-rest")
    return _met(packed, materialize(packed.where("is_query"), "nn-rest-queries"), ["length"], k)


def _met(placed: DataFrame, asked: DataFrame, group: list[str], k: int) -> DataFrame:
    """query_id, vec_id, score: the best of each block that queries meet; large groups are cut into blocks of both sides."""
    parts = lambda df, per, name: df.groupBy(*group).agg(F.ceil(F.count("*") / per).cast("int").alias(name))
    plan = parts(placed, ROWS_PER_BLOCK, "n_r").join(parts(asked, QUERIES_PER_BLOCK, "n_q"), group)
    spread = lambda df, own, other, a, b: df.join(plan, group).withColumn(a, F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int")).withColumn(b, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
    block = [*group, "r", "q"]
    left = spread(placed, "n_r", "n_q", "r", "q").select(*block, "vec_id", "vector")
    right = spread(asked, "n_q", "n_r", "q", "r").select(*block, "vec_id", "vector")
    return left.groupBy(*block).cogroup(right.groupBy(*block)).applyInPandas(_nearest(k), "query_id long, vec_id long, score double")


def op9_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
