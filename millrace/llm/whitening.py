"""Whitening of embeddings by shifted CholeskyQR.

Entries become integers, x = floor(64 * c) + 1000000, so sums and the mean are exact. The centred rows, a tall matrix dealt
over tasks, are orthogonalised by repeated passes: a pass divides its rows by the triangular factors found so far
(substitution, no inverse), adds up the Gram matrix, and the next factor is its Cholesky factor. The first pass shifts the
diagonal a little, so that the factor exists whatever the condition of the rows; a later pass does so only where its own
Gram matrix is near singular. Passes end once the rows came out nearly orthogonal: then the factor of that pass makes them
so to double precision. The product R of the factors has the singular values and right singular vectors of the centred
rows, which are the components; no covariance is ever decomposed.

A task sends one row of numbers for each row of its Gram matrix; tasks of a second step add these up row by row, so the
driver receives one matrix of the size of the vector squared, whatever the number of rows or tasks.

Rows without vector, with a null or non-finite entry, or with an entry of 2^44 or more in size are left out, and so are
empty vectors and those whose length is not the most frequent one (the smaller of two equally frequent). Repeated rows
count as often as they occur; a null id stays null. A component exists where the variance along it exceeds 1e-13 of the
largest: equal vectors, or a single one, have none, and an empty table gives no rows. ``deviation`` is null where the exact
sum passes 64 bits; ``deviation_exact`` still holds it, up to 38 digits. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import map_arrow, pieces

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
LARGEST = float(1 << 44)
LEAST_SHARE = 1e-13
PASSES = 5
BLOCK = 32
_ROUNDING = 2.0 ** -53


@dataclass
class Fit:
    """Count, whole part and rest of the mean (x = whole + rest / n), factors, components and their variances."""
    size: int
    n: int
    whole: np.ndarray
    rest: np.ndarray
    factors: list[np.ndarray]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float = 0.0


def matrix(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows whose vectors have ``size`` usable entries, and their x."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == size)
    flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null is NaN here
    values = flat.reshape(len(at), size)
    good = (np.abs(values) < LARGEST).all(axis=1)
    return at[good], np.floor(SCALE * values[good]).astype(np.int64) + OFFSET


def divided(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangular factor, by forward substitution over blocks of columns."""
    out = np.empty_like(rows)
    for at in range(0, factor.shape[0], BLOCK):
        end = min(at + BLOCK, factor.shape[0])
        part = rows[:, at:end] - out[:, :at] @ factor[:at, at:end]
        for j in range(end - at):
            part[:, j] = (part[:, j] - part[:, :j] @ factor[at:at + j, at + j]) / factor[at + j, at + j]
        out[:, at:end] = part
    return out


def centred(x: np.ndarray, fit: Fit) -> np.ndarray:
    return (x - fit.whole) - fit.rest / fit.n


def deviations(x: np.ndarray, fit: Fit) -> list[int]:
    """Exact sums of (n*x - S)^2, as Python integers: n*x - S is n times the distance to the whole part, less the rest."""
    y, r, n = x - fit.whole, fit.rest, fit.n
    if not len(y):
        return []
    big = max(int(np.abs(y).max()), 1)
    if big * big * fit.size >= 1 << 62 or big * n * fit.size >= 1 << 62:
        y, r = y.astype(object), r.astype(object)
    square, cross, rest = (y * y).sum(axis=1), (y * r).sum(axis=1), sum(int(v) ** 2 for v in fit.rest)
    return [n * n * int(a) - 2 * n * int(b) + rest for a, b in zip(square, cross)]


def _totals(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """Length, number and exact column sums of the usable vectors of the most frequent length."""
    schema = pa.schema([("size", pa.int32()), ("at", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            rows = []
            for size in pc.unique(pc.list_value_length(piece.column(0))).to_pylist():
                if size:
                    x = matrix(piece.column(0), size)[1]
                    if len(x):
                        rows += [(size, i, len(x), Decimal(t)) for i, t in enumerate(x.sum(axis=0, dtype=object).tolist())]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)

    per = map_arrow(vectors, run, "size int, at int, n long, total decimal(38,0)").groupBy("size", "at").agg(
        F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))
    best = per.where("at = 0").orderBy(F.desc("n"), "size").first()
    if best is None:
        return 0, 0, []
    sums = per.where(F.col("size") == best["size"]).orderBy("at").collect()
    return best["size"], best["n"], [int(r["total"]) for r in sums]


def _summed(vectors: DataFrame, fit: Fit, form: Callable[[np.ndarray, Fit], np.ndarray], width: int) -> np.ndarray:
    """Sum of the products of all pairs of columns that ``form`` makes of the centred rows, one column of ones added."""
    shared = vectors.sparkSession.sparkContext.broadcast(vars(fit))
    schema = pa.schema([("at", pa.int32()), ("part", pa.int64()), ("sums", pa.binary())])

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        fit_ = Fit(**shared.value)
        total = np.zeros((width + 1, width + 1))
        for piece in pieces(batches):
            rows = form(centred(matrix(piece.column(0), fit_.size)[1], fit_), fit_)
            rows = np.concatenate([rows, np.ones((len(rows), 1))], axis=1)
            total += rows.T @ rows
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(range(width + 1), pa.int32()), pa.array([part] * (width + 1), pa.int64()),
                                          pa.array([r.tobytes() for r in total], pa.binary())], schema=schema)

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, row in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                sums[at] = sums.get(at, 0.0) + np.frombuffer(row)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([0] * len(sums), pa.int64()),
                                          pa.array([v.tobytes() for v in sums.values()], pa.binary())], schema=schema)

    kind = "at int, part long, sums binary"
    parts = map_arrow(vectors, of_task, kind).repartition(min(width + 1, 64), "at").sortWithinPartitions("at", "part")
    rows = map_arrow(parts, added, kind).collect()  # the same order of addition at every run
    shared.unpersist()
    return np.stack([np.frombuffer(r["sums"]) for r in sorted(rows, key=lambda r: r["at"])])


def orthogonal(rows: np.ndarray, fit: Fit) -> np.ndarray:
    for factor in fit.factors:
        rows = divided(rows, factor)
    return rows


def projected(rows: np.ndarray, fit: Fit) -> np.ndarray:
    return rows @ (fit.components / np.sqrt(fit.variances)[:, None]).T


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """Mean, factors and components; None where no row is usable."""
    vectors = df.select(F.col(vector).alias("vector"))
    size, n, sums = _totals(vectors)
    if not n:
        return None
    whole = np.array([s // n for s in sums], np.int64)
    out = Fit(size, n, whole, np.array([s - int(w) * n for s, w in zip(sums, whole)], np.int64), [],
              np.zeros((0, size)), np.zeros(0), 0.0)
    for step in range(PASSES):
        gram = _summed(vectors, out, orthogonal, size)[:size, :size]
        values = np.linalg.eigvalsh(gram)
        if values[-1] <= 0:
            return out  # all vectors are equal
        singular = values[0] < 1e-8 * values[-1]
        shift = 11 * (n * size + size * (size + 1)) * _ROUNDING * values[-1] if step == 0 or singular else 0.0
        out.factors.append(np.linalg.cholesky(gram + shift * np.eye(size)).T)
        if step and ((np.abs(values - 1) < 0.1) | (values < 1e-6)).all():
            break
    r = out.factors[0]
    for factor in out.factors[1:]:
        r = factor @ r
    _, scale, turned = np.linalg.svd(r)
    variances = scale ** 2 / n
    out.trace = float(variances.sum())
    kept = int(min(components, (variances > LEAST_SHARE * variances[0]).sum()))
    out.variances = variances[:kept]
    sign = np.sign(turned[np.arange(kept), np.abs(turned[:kept]).argmax(axis=1)])
    out.components = turned[:kept] * sign[:, None]
    sums_ = _summed(vectors, out, projected, kept)
    mean = sums_[kept, :kept] / n
    out.identity_error = float(np.abs(sums_[:kept, :kept] / n - np.outer(mean, mean) - np.eye(kept)).max())
    return out


def whiten(df: DataFrame, model: Fit | None, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact of every usable row."""
    kind = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
            "deviation_exact decimal(38,0)")
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    if model is None or not len(model.variances):
        return df.sparkSession.createDataFrame([], kind)
    shared = df.sparkSession.sparkContext.broadcast(vars(model))
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
                        ("deviation_exact", pa.decimal128(38, 0))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit_ = Fit(**shared.value)
        kept = len(fit_.variances)
        for piece in pieces(batches, 1 << 18):  # a row becomes one for each component
            at, x = matrix(piece.column(1), fit_.size)
            far = deviations(x, fit_)
            each = np.repeat(np.arange(len(at)), kept)
            near = pa.array([d if d < 1 << 63 else None for d in far], pa.int64())
            exact = pa.array([Decimal(d) if d < 10 ** 38 else None for d in far], pa.decimal128(38, 0))
            out = [piece.column(0).take(pa.array(at[each])), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(at))),
                   pa.array(np.full(len(each), fit_.n)), near.take(pa.array(each)),
                   pa.array(projected(centred(x, fit_), fit_).reshape(-1)),
                   pa.array(np.tile(fit_.variances / fit_.trace, len(at))),
                   pa.array(np.full(len(each), fit_.identity_error)), exact.take(pa.array(each))]
            yield pa.RecordBatch.from_arrays(out, schema=schema)

    return map_arrow(rows, run, kind)
