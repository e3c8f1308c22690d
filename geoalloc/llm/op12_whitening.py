"""Whitening of embeddings by shifted CholeskyQR.

Entries become whole numbers, so sums are exact and rows are centred before anything is
multiplied. A pass over the distinct rows adds up their Gram matrix; its Cholesky factor R
makes the next pass's rows, solved through the triangular factors so far, nearly orthogonal.
The first factor is shifted, which keeps it positive for rows of any condition. The product
of the factors is the R of a QR factorisation of the whole centred table, and its singular
vectors and values are the components, to double precision and without squaring the condition.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoalloc.llm.common import stored

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
BATCH, MOST_PASSES, ORTHOGONAL = 2048, 6, 1e-8
#: Entries from here on count as not finite: beyond it whole numbers are not exact as doubles.
LARGEST = 2.0**52
#: A singular value below this share of the largest one is rounding, not a direction.
RANK = 1e-12
HALF = 26


@dataclass
class Model:
    """What is known of the vectors of one length: their number, sums, factors and components."""

    n: int
    sums: list[int]
    factors: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray | None = None
    explained: np.ndarray | None = None
    identity_error: float = 0.0

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """``n x - sums``, exact: 64-bit whole numbers where they suffice, else Python's."""
        far = int(np.abs(x).max(initial=0))
        if (self.n * far + max(map(abs, self.sums))) < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n


def solved(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of the upper triangular ``r``, by substitution column by column."""
    out = np.empty_like(rows)
    for j in range(r.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def whole_entries(column: pa.Array, scale: int, offset: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that remain, their lengths, and the whole numbers of all of them in one run."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    owner = np.repeat(np.arange(len(column)), lengths)
    with np.errstate(invalid="ignore"):
        bad = np.bincount(owner[~(np.abs(values) < LARGEST)], minlength=len(column)) > 0
    keep = ~bad & column.is_valid().to_numpy(zero_copy_only=False)
    return np.flatnonzero(keep), lengths[keep], values[keep[owner]].astype(np.int64) + offset


def points(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``id, dim, x``: length and packed whole numbers of every remaining row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                rows, lengths, x = whole_entries(batch["vector"], scale, offset)
                ends = np.concatenate([[0], np.cumsum(8 * lengths)])
                packed = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(x.astype("<i8"))])
                yield pa.RecordBatch.from_arrays([batch["id"].take(pa.array(rows)), pa.array(lengths.astype(np.int32)), packed.cast(pa.binary())], ["id", "dim", "x"])

    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, dim int, x binary")


def by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """Vectors of one length as a matrix, with their rows."""
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH):
            batch = whole.slice(at, BATCH)
            dims = batch["dim"].to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == dim))
                yield dim, np.frombuffer(b"".join(some["x"].to_pylist()), "<i8").reshape(some.num_rows, dim), some


def exact_sums(fit: DataFrame) -> dict[int, Model]:
    """Number and sums of the vectors of every length; a task sends one row for each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for dim, x, _ in by_length(batches):
            part = np.stack([np.full(dim, len(x)), (x >> HALF).sum(0), (x & (1 << HALF) - 1).sum(0)])
            held[dim] = held[dim] + part if dim in held else part
        for dim, (n, high, low) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(dim, dim, np.int32)), pa.array(np.arange(dim, dtype=np.int32)), pa.array(n), pa.array(high), pa.array(low)], ["dim", "i", "n", "high", "low"])

    sent = fit.mapInArrow(run, "dim int, i int, n long, high long, low long")
    out: dict[int, Model] = {}
    for r in sent.groupBy("dim", "i").agg(*(F.sum(c).alias(c) for c in ("n", "high", "low"))).orderBy("dim", "i").collect():
        out.setdefault(r.dim, Model(r.n, [])).sums.append((r.high << HALF) + r.low)
    return out


def gram_matrices(fit: DataFrame, models: dict[int, Model], last: str = "factors") -> dict[int, np.ndarray]:
    """Gram matrices of the centred rows, solved through all factors so far, or weighted.

    A task sends the rows of its own matrix; each row of the sum is added up in the order of
    the tasks, apart from the others. The sums come to the driver, ``dim`` squared each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for dim, x, _ in by_length(batches):
            if dim not in models:
                continue
            rows = models[dim].centred(x)
            if last == "weights":
                rows = rows @ models[dim].weights
            else:
                for r in models[dim].factors:
                    rows = solved(rows, r)
            held[dim] = held.get(dim, 0) + rows.T @ rows
        task = TaskContext.get().partitionId()
        for dim, g in held.items():
            k = len(g)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, dim, np.int32)), pa.array(np.arange(k, dtype=np.int32)), pa.array(np.full(k, task, np.int64)),
                                              pa.array([x.astype("<f8").tobytes() for x in g], pa.binary())], ["dim", "i", "task", "row"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        rows = np.frombuffer(b"".join(table["row"].to_pylist()), "<f8").reshape(table.num_rows, -1)
        return pa.table({"dim": table["dim"][:1], "i": table["i"][:1], "row": pa.array([rows.sum(0).tobytes()], pa.binary())})

    sent = fit.mapInArrow(run, "dim int, i int, task long, row binary")
    out: dict[int, list] = {}
    for r in sent.groupBy("dim", "i").applyInArrow(add, "dim int, i int, row binary").orderBy("dim", "i").collect():
        out.setdefault(r.dim, []).append(np.frombuffer(r.row, "<f8"))
    return {dim: np.array(g) for dim, g in out.items()}


def cholesky(g: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper triangular factor; where the plain one fails, or first of all, of the shifted matrix."""
    d, norm = len(g), float(np.linalg.norm(g, 2))
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * norm
    for k in range(0 if not shifted else 1, 40):
        try:
            return np.linalg.cholesky(g + (shift * 4.0 ** (k - 1) if k else 0.0) * np.eye(d)).T
        except np.linalg.LinAlgError:
            continue
    raise ValueError("the Gram matrix is not finite")


def root(g: np.ndarray) -> np.ndarray:
    """A matrix whose Gram matrix is ``g``, for semi-definite ones too."""
    try:
        return np.linalg.cholesky(g).T
    except np.linalg.LinAlgError:
        values, vectors = np.linalg.eigh(g)
        return np.sqrt(np.maximum(values, 0))[:, None] * vectors.T


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """A model for each vector length of the distinct rows ``dim, x``.

    Passes go on until the rows are orthogonal to ``ORTHOGONAL`` (the last factor squares that
    error away), at most ``MOST_PASSES``: rows of lower rank never are, and the Gram matrix
    left over then joins the product as it is.
    """
    models = {dim: m for dim, m in exact_sums(fit).items() if dim}
    going, whole, total = dict(models), {}, {}
    for step in range(MOST_PASSES):
        if not going:
            break
        for dim, g in gram_matrices(fit, going).items():
            m = going[dim]
            if step == 0:
                total[dim], whole[dim] = float(np.trace(g)), np.eye(dim)
                if not total[dim]:  # all rows are equal: no components
                    m.weights, m.explained = np.empty((dim, 0)), np.empty(0)
                    del going[dim]
                    continue
            if step and np.abs(g - np.eye(dim)).max() < ORTHOGONAL or step == MOST_PASSES - 1:
                _, sigma, v = np.linalg.svd(root(g) @ whole[dim])
                k = min(components, int((sigma > RANK * sigma[0]).sum()))
                m.weights = (v[:k] * (math.sqrt(m.n) / sigma[:k])[:, None]).T
                m.explained = sigma[:k] ** 2 / total[dim]
                del going[dim]
            else:
                r = cholesky(g, m.n, step == 0)
                m.factors.append(r)
                whole[dim] = r @ whole[dim]
    for dim, g in gram_matrices(fit, {d: m for d, m in models.items() if m.weights.shape[1]}, "weights").items():
        models[dim].identity_error = float(np.abs(g / models[dim].n - np.eye(len(g))).max())
    return models


def deviations(y: np.ndarray) -> list[int | None]:
    """Sums of squares of whole numbers, exact; null where one does not fit 64 bits."""
    near = (y.astype(np.float64) ** 2).sum(1)
    if y.dtype != object and near.max(initial=0) < 2.0**62:
        return (y * y).sum(1).tolist()
    sums = [sum(v * v for v in row) for row in y.tolist()]
    return [s if s < 1 << 63 else None for s in sums]


def whiten(rows: DataFrame, models: dict[int, Model]) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every row of ``points``."""
    models = {dim: Model(m.n, m.sums, [], m.weights, m.explained, m.identity_error) for dim, m in models.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, x, batch in by_length(batches):
            m = models.get(dim)
            if m is None or not m.weights.shape[1]:
                continue
            y, k, many = m.scaled(x), m.weights.shape[1], len(x)
            out = (y.astype(np.float64) / m.n) @ m.weights
            at = pa.array(np.repeat(np.arange(many), k))
            yield pa.RecordBatch.from_arrays([
                batch["id"].take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)), pa.array(np.full(many * k, m.n, np.int64)),
                pa.array(deviations(y), pa.int64()).take(at), pa.array(out.ravel()), pa.array(np.tile(m.explained, many)),
                pa.array(np.full(many * k, m.identity_error))], names)

    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return rows.mapInArrow(run, f"vec_id {rows.schema['id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whitened_components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Every remaining row on the leading components of the distinct rows.

    Rows whose vector is null, or holds null or non-finite entries or such from 2^52 / 64 on, are
    left out. Repeated rows count once in the fit and are returned as often as they stand there;
    null ids are ids. Vectors of different lengths are spaces of their own. Directions without
    variance are no components, so a space of one distinct vector (or of length 0) has no rows.
    Components of equal variance may come in any basis. ``deviation`` is null where it does not
    fit 64 bits. An empty table gives no rows; other columns are not read. Tasks and driver hold
    a few matrices of length squared for each length, meant for lengths up to some thousands.
    """
    rows = points(vectors, id_col, vector_col)
    fit = stored(rows.select("dim", "x").distinct())
    return whiten(rows, fit_whitening(fit, components))


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """All embeddings on their first 16 components."""
    return whitened_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
