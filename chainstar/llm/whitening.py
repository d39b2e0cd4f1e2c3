"""Embedding whitening by incremental eigendecomposition (operator 13).

Entries become whole numbers x = floor(scale * entry); each distinct vector
counts once (the fit list).  Every partition of the fit list adds its vectors
to a spectrum (count, mean, eigenpairs of the centred scatter matrix) by
centred rank-one updates: secular equations with deflation, in
``eigen_update``.  Spectra are combined by further rank-one updates, ``FAN`` at
a time in a tree of groups, so one task holds a few matrices and the driver
one.  The combined eigenvectors then start a Rayleigh-Ritz refinement: a pass
over the fit list gives V Q for the covariance V and the basis Q, the small
matrix Q^T V Q is decomposed, and its Ritz vectors go round again (as an
orthonormalised V Q) until their residual is at rounding.

The sums S and the deviations are exact: 64-bit integers where they fit, else
Python's.  What goes through the driver are matrices of the dimension's size.

Defined results: rows are left out whose vector is null or empty, holds a
null or non-finite entry or one of 2^54 and more, or has another length than
most such vectors (of lengths equally common, the shortest counts).  Every other row
is returned, also where ids are null or repeated; extra columns are not read.
Components with less than 1e-12 of the variance have no scale and are left
out: a table of equal vectors, of one vector or of none gives no rows.  A
deviation beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from chainstar.llm.common import c, task_id, work_dir, written
from chainstar.llm.eigen_update import Spectrum

SCALE = 256
FAN = 16               # spectra or matrices that one task combines
LIMIT = 2.0 ** 54      # of an entry
TOLERANCE = 1e-13      # residual of a Ritz pair, against the largest eigenvalue
PASSES = 50            # of the refinement at most; a full basis needs one
LEAST_SHARE = 1e-12
SAFE = 2 ** 62

_SPECTRUM = "node long, n long, sums array<string>, mean array<double>, vals array<double>, vecs array<double>"
_MATRIX = "node long, m array<double>"
_ARROW = {
    _SPECTRUM: pa.schema([("node", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.string())),
                          *[(k, pa.list_(pa.float64())) for k in ("mean", "vals", "vecs")]]),
    _MATRIX: pa.schema([("node", pa.int64()), ("m", pa.list_(pa.float64()))]),
}


def integer_vectors(table: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(x_id, x) of the rows whose entries are all finite numbers."""
    v = c(vector_col)
    fine = F.forall(v, lambda e: F.coalesce(F.abs(e.cast("double")) < LIMIT, F.lit(False)))
    x = F.transform(v, lambda e: F.floor(e.cast("double") * scale).cast("long"))
    return table.filter(v.isNotNull() & (F.size(v) > 0) & fine).select(c(id_col).alias("x_id"), x.alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def exact_sums(x: np.ndarray) -> list[int]:
    if len(x) and int(np.abs(x).max()) * len(x) >= SAFE:
        return [int(s) for s in x.astype(object).sum(axis=0)]
    return x.sum(axis=0).tolist()


def _batch(schema: str, *columns) -> pa.RecordBatch:
    arrow = _ARROW[schema]
    return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(columns, arrow, strict=True)],
                                      schema=arrow)


def _tree(rows: DataFrame, schema: str, merge: Callable[[pa.Table], tuple], path: str) -> DataFrame:
    """``rows`` (node, ...) combined, up to ``FAN`` nodes in a group, until one node is left."""

    def combine(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_batch(schema, [group["node"][0].as_py() // FAN], *merge(group))])

    rows, n = written(rows, f"{path}/0"), 0
    while (rows.agg(F.max("node")).first()[0] or 0) > 0:
        n += 1
        rows = written(rows.groupBy(F.expr(f"node div {FAN}").alias("g")).applyInArrow(combine, schema), f"{path}/{n}")
    return rows


def _merge_spectra(group: pa.Table) -> tuple:
    total, sums = None, None
    for r in group.sort_by("node").to_pylist():
        one = Spectrum.of(r["n"], r["mean"], r["vals"], r["vecs"])
        part = [int(s) for s in r["sums"]]
        if total is None:
            total, sums = one, part
        else:
            total.merge(one)
            sums = [a + b for a, b in zip(sums, part)]
    return ([total.n], [[str(s) for s in sums]], [total.mean.tolist()], [total.values.tolist()],
            [total.vectors.ravel().tolist()])


def _add_matrices(group: pa.Table) -> tuple:
    return ([sum(np.array(m) for m in group.sort_by("node")["m"].to_pylist()).tolist()],)


def spectrum(fit: DataFrame, dim: int, path: str) -> tuple[int, list[int], np.ndarray] | None:
    """(n, S, eigenvectors by falling eigenvalue) of the fit list (x), or None where it is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, sums = Spectrum(dim), [0] * dim
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            sums = [a + b for a, b in zip(sums, exact_sums(x))]
            for row in x.astype(np.float64):
                s.add(row)
        if s.n:
            yield _batch(_SPECTRUM, [task_id()], [s.n], [[str(v) for v in sums]], [s.mean.tolist()],
                         [s.values.tolist()], [s.vectors.ravel().tolist()])

    got = _tree(fit.mapInArrow(run, _SPECTRUM), _SPECTRUM, _merge_spectra, path).first()
    if got is None:
        return None
    return got["n"], [int(v) for v in got["sums"]], np.array(got["vecs"]).reshape(dim, dim)[:, ::-1]


def _pass(fit: DataFrame, dim: int, work: Callable[[np.ndarray], np.ndarray], path: str) -> np.ndarray:
    """The sum over the fit list of ``work``, a function from a block of vectors to a fixed shape, flat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            part = work(_matrix(batch.column(0), dim).astype(np.float64))
            total = part if total is None else total + part
        if total is not None:
            yield _batch(_MATRIX, [task_id()], [total.ravel().tolist()])

    return np.array(_tree(fit.mapInArrow(run, _MATRIX), _MATRIX, _add_matrices, path).first()["m"])


def refine(fit: DataFrame, n: int, mean: np.ndarray, basis: np.ndarray, keep: int, path: str,
           tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray, float]:
    """Rayleigh-Ritz: (eigenvalues, eigenvectors as columns, trace of the covariance); the first ``keep`` pairs are held
    to the residual's tolerance."""
    dim = len(mean)
    q = np.linalg.qr(basis)[0]
    trace = 0.0
    for k in range(PASSES):
        width = q.shape[1]

        def product(x: np.ndarray, q: np.ndarray = q) -> np.ndarray:
            y = x - mean
            return np.append((y.T @ (y @ q)).ravel(), np.sum(y * y))

        flat = _pass(fit, dim, product, f"{path}/{k}") / n
        vq, trace = flat[:-1].reshape(dim, width), float(flat[-1])
        h = q.T @ vq
        e, w = np.linalg.eigh((h + h.T) / 2)
        e, w = e[::-1], w[:, ::-1]
        ritz, image = q @ w, vq @ w
        off = np.abs(image - ritz * e)[:, :keep].max()
        if off <= tolerance * max(e[0], 0.0) * dim:
            break
        q = np.linalg.qr(image)[0]
    return e[:keep], ritz[:, :keep], trace


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None beyond 64 bits."""
    most = max([int(np.abs(x).max()) if x.size else 0]) * n + max(map(abs, sums), default=0)
    if most < 2 ** 31 and most * most * max(len(sums), 1) < SAFE:
        away = n * x - np.array(sums, dtype=np.int64)
        return np.einsum("ij,ij->i", away, away).tolist()
    away = n * x.astype(object) - np.array(sums, dtype=object)
    return [int(v) if v < 2 ** 63 else None for v in (away * away).sum(axis=1)]


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4,
           scale: int = SCALE) -> DataFrame:
    """A row for each vector left and component: id, component, n, deviation, whitened, explained, identity_error."""
    base = work_dir(table.sparkSession, "whitening")
    rows = integer_vectors(table, id_col, vector_col, scale)
    kind = rows.schema["x_id"].dataType
    out = f"x_id {kind.simpleString()}, component int, n long, deviation long, whitened double, " \
          "explained double, identity_error double"
    named = [F.col("x_id").alias(id_col), "component", "n", "deviation", "whitened", "explained", "identity_error"]
    most = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    found, e = None, np.zeros(0)
    if most is not None:
        dim = most["dim"]
        rows = rows.filter(F.size("x") == dim)
        # Copies are combined before the first shuffle; the second deals what is left evenly, as its work by the
        # row is much larger than its size tells.
        parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        fit = written(rows.select("x").distinct().repartition(parts, "x"), f"{base}/fit")
        found = spectrum(fit, dim, f"{base}/spectra")
    if found is not None:
        n, sums, basis = found
        mean = np.array([s / n for s in sums])
        e, q, trace = refine(fit, n, mean, basis, components, f"{base}/ritz")
        held = e > LEAST_SHARE * trace
        e, q = e[held], q[:, held]
    if not len(e):
        return table.sparkSession.createDataFrame([], out).select(*named)
    k = len(e)
    project = q / np.sqrt(e)

    def moments(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ project
        return np.append(w.sum(axis=0), (w.T @ w).ravel())

    flat = _pass(fit, dim, moments, f"{base}/identity") / n
    first, second = flat[:k], flat[k:].reshape(k, k)
    error = float(np.abs(second - np.outer(first, first) - np.eye(k)).max())
    share = (e / trace).tolist()
    schema = to_arrow_schema(StructType.fromDDL(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            w = (x.astype(np.float64) - mean) @ project
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k)))
            deviation = deviations(x, n, sums)
            size = len(x) * k
            columns = [ids, np.tile(np.arange(1, k + 1), len(x)), np.full(size, n), [d for d in deviation for _ in range(k)],
                       w.ravel(), np.tile(share, len(x)), np.full(size, error)]
            yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, type=f.type)
                                              for v, f in zip(columns, schema)], schema=schema)

    return rows.mapInArrow(run, out).select(*named)
