"""Embedding whitening (operator 13) by a bidiagonal qd solver.

1. Entries become whole numbers, ``floor(256 * c)``; each distinct vector is once in the fit
   list (an aggregation, so copies collapse before the shuffle).  Number and sums are exact.
2. Blockwise QR: each task turns its centred rows, a batch at a time, into one triangle with a
   row for each dimension; triangles are combined ``FAN`` at a time in as many rounds as it
   takes.  Nothing but triangles moves, and no task holds more than ``FAN`` of them.
3. One triangle is left, of the size of the dimensions: Householder reflections bring it to
   bidiagonal form, dqds finds the singular values, twisted factorisations the directions
   (:mod:`tessera.llm.qd`).
4. Every row is projected; the covariance of the result over the fit list is gathered as
   counts, means and centred products that combine like the triangles.

Defined results: rows whose vector is NULL, or holds NULL, NaN or an infinity, are left out, and
so are rows that do not have the most common number of entries (of equally common numbers the
largest), which are no vectors of that space.  Entries beyond the range of a long stand for its
ends.  Repeated rows and NULL ids are rows like others.  Without remaining rows there is no
result.  A component without variance (fewer distinct vectors than dimensions, constant
dimensions) has whitened and explained 0 and does not count in identity_error.  ``deviation`` is
exact, and NULL where it is beyond the range of a long.  Equal eigenvalues have some orthonormal
basis, the same for all rows.  Other columns are not read.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.qd import EPS, right_singular

COMPONENTS = 4
SCALE = 256
#: Triangles (or moments) that meet in one task.
FAN = 32

_PART = "part long, value binary"
_PART_ARROW = pa.schema([("part", pa.int64()), ("value", pa.binary())])
_OUT = ("vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double")


@dataclass
class Whitening:
    """Number of distinct vectors, their exact sums, directions as columns, the eigenvalues of
    these, and the sum of all eigenvalues."""
    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        """Rows of x, centred, on the directions, over the root of the eigenvalues."""
        root = np.sqrt(self.variances)
        return (x - self.mean) @ self.directions * np.divide(1.0, root, out=np.zeros_like(root), where=root > 0)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S)^2, exact."""
        largest = self.n * max(1, int(np.abs(x.astype(float)).max(initial=0))) + max(map(abs, self.sums), default=0)
        if largest * largest * max(1, x.shape[1]) < 2 ** 62:
            moved = self.n * x - np.array(self.sums, np.int64)
            return (moved * moved).sum(axis=1).tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist())
        return [v if v < 2 ** 63 else None for v in exact]


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x): rows with whole-number vectors of one length."""
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                      & (F.abs(c.cast("double")) < float("inf")))
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    rows = vectors.where(vector.isNotNull() & finite).select(F.col(id_col).alias("vec_id"), whole.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("rows"))
    size = lengths.select(F.max(F.struct("rows", "size"))["size"]).scalar()
    return rows.where(F.size("x") == size)


def _matrices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            x = batch.column(column)
            yield batch, x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _dump(*arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, *arrays)
    return out.getvalue()


def _load(data: bytes) -> list[np.ndarray]:
    with np.load(io.BytesIO(data)) as found:
        return [found[name] for name in found.files]


def _gather(fit: DataFrame, start: Callable, combine: Callable, label: str) -> list[np.ndarray]:
    """``start`` of every batch of the fit list, brought together by ``combine``, which takes
    two results and gives one: first inside a task, then ``FAN`` tasks' results at a time."""
    def in_task(batches):
        held = None
        for _, x in _matrices(batches, 0):
            mine = start(x)
            held = mine if held is None else combine(held, mine)
        if held is not None:
            yield pa.RecordBatch.from_pylist(
                [{"part": TaskContext.get().partitionId(), "value": _dump(*held)}], _PART_ARROW)

    def in_group(key: tuple, rows: pa.Table) -> pa.Table:
        held = None
        for row in sorted(rows.to_pylist(), key=lambda r: r["part"]):
            mine = _load(row["value"])
            held = mine if held is None else combine(held, mine)
        return pa.Table.from_pylist([{"part": key[0].as_py(), "value": _dump(*held)}], _PART_ARROW)

    parts = written(fit.mapInArrow(in_task, _PART), label)
    while parts.count() > 1:
        groups = parts.select(F.expr(f"part div {FAN}").alias("to"), "part", "value").groupBy("to")
        parts = written(groups.applyInArrow(in_group, _PART), label)
    return _load(parts.first()["value"])


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of every dimension.  High and low halves are added
    apart, so that nothing overflows."""
    def halves(batches):
        for batch, x in _matrices(batches, 0):
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            yield pa.RecordBatch.from_pydict({"n": np.full(x.shape[1], len(x), np.int64), "dim": np.arange(x.shape[1]),
                                              "high": high, "low": low})

    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = (fit.mapInArrow(halves, "n long, dim long, high long, low long")
            .groupBy("dim").agg(F.sum("n").alias("n"), total("high"), total("low")).orderBy("dim").collect())
    return (rows[0]["n"] if rows else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """``fit`` (x): distinct whole-number vectors.  None without any dimension or row."""
    n, sums = _sums(fit)
    if not n:
        return None
    mean = np.array([s / n for s in sums])
    size = len(mean)

    def triangle(rows: np.ndarray) -> np.ndarray:
        r = np.linalg.qr(rows, mode="r")
        return r if len(r) == size else np.vstack([r, np.zeros((size - len(r), size))])

    r, = _gather(fit, lambda x: [triangle(x - mean)], lambda a, b: [triangle(np.vstack([a[0], b[0]]))], "qr")
    squares, directions = right_singular(r, components)
    top = squares[:directions.shape[1]] / n
    # what rounding leaves of a direction without variance
    top = np.where(squares[:len(top)] > (8 * size * EPS) ** 2 * squares[0], top, 0.0)
    return Whitening(n, sums, directions, top, float(np.sum(r * r)) / n)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    some = model.variances > 0
    if not some.any():
        return 0.0

    def start(x: np.ndarray) -> list[np.ndarray]:
        w = model.project(x)[:, some]
        centred = w - w.mean(axis=0)
        return [np.array(float(len(w))), w.mean(axis=0), centred.T @ centred]

    def combine(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
        n, apart = a[0] + b[0], b[1] - a[1]
        return [n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)]

    n, _, products = _gather(fit, start, combine, "moments")
    return float(np.abs(products / n - np.eye(len(products))).max())


def apply_whitening(rows: DataFrame, model: Whitening, error: float) -> DataFrame:
    """``rows`` (vec_id, x) -> a row for each component."""
    schema = _OUT.format(id_type=rows.schema["vec_id"].dataType.simpleString())
    k = len(model.variances)
    explained = model.variances / model.trace if model.trace > 0 else np.zeros(k)

    def run(batches):
        for batch, x in _matrices(batches, 1):
            rows_of = np.repeat(np.arange(len(x)), k)
            deviations = pa.array(model.deviations(x), pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows_of)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(rows_of), model.n)), deviations.take(pa.array(rows_of)),
                pa.array(model.project(x).reshape(-1)), pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(rows_of), error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained,
    identity_error for every remaining row and component."""
    rows = quantised(vectors, id_col, vector_col)
    fit = written(rows.select("x").distinct(), "whitening_fit")
    model = fit_whitening(fit, components)
    if model is None:
        empty = _OUT.format(id_type=rows.schema["vec_id"].dataType.simpleString())
        return vectors.sparkSession.createDataFrame([], empty)
    return apply_whitening(rows, model, identity_error(fit, model))
