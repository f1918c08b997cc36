"""Whitening of embeddings by an incremental eigendecomposition.

The fit is over the distinct vectors. Every partition adds its vectors one by one to a
spectrum (``spectra``): a centred rank-one update each. Spectra are combined by adding
one's weighted eigenvectors to the other, at most ``FAN`` in a task, level by level until
one is left. A last pass over the vectors refines it (Rayleigh-Ritz): the covariance is
projected on the basis found, and the eigenvectors of that small matrix turn the basis.
Another pass measures how far the whitened covariance is from the identity.

Only counts, sums and one ``d x d`` matrix reach the driver, whatever the number of rows.

Edge cases: vectors that are null, empty or hold null or non-finite components (or
components of 2^25 or more in size) are left out; vectors of different lengths are fitted apart, each
length like a table of its own; repeated rows are each returned and count once in the fit;
a component without variance (all vectors equal, or fewer vectors than components) has
``whitened`` and ``explained`` 0 and no part in ``identity_error``; an empty table has no
rows; where ``deviation`` leaves a long (from some 10^8 vectors of usual size on) it is null and
``deviation_exact``, else null, has it in decimal; other columns, whatever their names, are
carried along.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .spectra import EPS, Spectra
from .vectors import by_dim, coded

OFFSET = 1_000_000  # added to every whole component; exact results do not depend on it
COMPONENTS, LANES, FAN = 16, 16, 16
LIMIT = float(1 << 31)
_PART = "dim int, node bigint, n bigint, sums binary, mean binary, spectrum binary, vectors binary"
_MATRIX = "dim int, node bigint, total binary"


def _part(dim: int, node: int, sums: np.ndarray, whole: Spectra) -> pa.RecordBatch:
    row = {"dim": dim, "node": node, "n": int(whole.count[0]), "sums": sums.tobytes(), "mean": whole.mean[0].tobytes(),
           "spectrum": whole.values[0].tobytes(), "vectors": whole.vectors[0].tobytes()}
    return pa.RecordBatch.from_pylist([row], pa.schema([
        ("dim", pa.int32()), ("node", pa.int64()), ("n", pa.int64()), *[
            (c, pa.binary()) for c in ("sums", "mean", "spectrum", "vectors")]]))


def _spectrum(part: dict) -> Spectra:
    read = {c: np.frombuffer(part[c]) for c in ("mean", "spectrum", "vectors")}
    return Spectra(np.array([float(part["n"])]), read["mean"][None].copy(), read["spectrum"][None].copy(),
                   read["vectors"].reshape(1, part["dim"], part["dim"]).copy())


def _decomposed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One spectrum for each length of vector in a partition."""
    found: dict[int, tuple[Spectra, np.ndarray]] = {}
    for batch in batches:
        for dim, _, x in by_dim(batch):
            if dim not in found:
                found[dim] = Spectra.empty(LANES, dim), np.zeros(dim, np.int64)
            lanes, sums = found[dim]
            sums += x.sum(0)
            rows = x.astype(float)
            for i in range(0, len(rows), LANES):
                lanes.add(rows[i:i + LANES])
    for dim, (lanes, sums) in found.items():
        yield _part(dim, TaskContext.get().partitionId(), sums, lanes.merged())


def _combined(key: tuple, parts: pa.Table) -> pa.Table:
    """One spectrum out of at most ``FAN``."""
    rows = sorted(parts.to_pylist(), key=lambda r: r["node"])
    sums = np.sum([np.frombuffer(r["sums"], np.int64) for r in rows], 0)
    whole = Spectra.stacked([_spectrum(r) for r in rows]).merged()
    return pa.Table.from_batches([_part(rows[0]["dim"], rows[0]["node"] // FAN, sums, whole)])


def _added(key: tuple, parts: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(m) for m in parts.column("total").to_pylist()], 0)
    return pa.table({"dim": pa.array([parts.column("dim")[0].as_py()], pa.int32()),
                     "node": pa.array([parts.column("node")[0].as_py() // FAN], pa.int64()),
                     "total": pa.array([total.tobytes()], pa.binary())})


def _up_a_tree(parts: DataFrame, combine: Callable, schema: str, name: str) -> list[dict]:
    """The parts of every ``dim`` combined to one row; a task sees at most ``FAN`` of them."""
    while True:
        parts = materialise(parts, name)
        if parts.groupBy("dim").count().where("count > 1").isEmpty():
            return parts.toArrow().to_pylist()
        parts = parts.groupBy("dim", F.expr(f"node div {FAN}")).applyInArrow(combine, schema)


def _squares(vectors: DataFrame, means: dict, bases: dict) -> dict[int, np.ndarray]:
    """Sums of ``y y'`` over all vectors, ``y`` the centred vector on its length's basis."""
    shared = vectors.sparkSession.sparkContext.broadcast((means, bases))

    def run(batches):
        means, bases = shared.value
        totals = {}
        for batch in batches:
            for dim, _, x in by_dim(batch):
                y = (x - means[dim]) @ bases[dim].T
                totals[dim] = totals.get(dim, 0) + y.T @ y
        for dim, total in totals.items():
            yield pa.RecordBatch.from_pylist(
                [{"dim": dim, "node": TaskContext.get().partitionId(), "total": total.tobytes()}],
                pa.schema([("dim", pa.int32()), ("node", pa.int64()), ("total", pa.binary())]))
    found = _up_a_tree(vectors.mapInArrow(run, _MATRIX), _added, _MATRIX, "squares")
    return {r["dim"]: np.frombuffer(r["total"]).reshape(len(bases[r["dim"]]), -1) for r in found}


class Whitener:
    """Of the vectors of one length: ``n``, exact ``sums``, eigenvalues ``variances`` of the
    covariance (falling), ``components`` (rows), and ``scaled`` components, which whiten."""

    def __init__(self, n: int, sums: np.ndarray, basis: np.ndarray, projected: np.ndarray, components: int):
        self.n, self.sums, self.mean = n, sums, sums / n
        variances, turn = np.linalg.eigh((projected + projected.T) / (2 * n))
        self.variances, self.trace = np.maximum(variances[::-1], 0), float(np.trace(projected)) / n
        self.components = (turn.T[::-1] @ basis)[:components]
        kept = self.variances[:components]
        self.real = kept > len(sums) * EPS * max(float(self.variances[0]), 0)
        self.scaled = self.components * np.where(self.real, 1 / np.sqrt(np.where(self.real, kept, 1)), 0)[:, None]
        self.explained = kept * self.real / (self.trace or 1)


def fitted(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, tuple[Whitener, float]]:
    """For every length of the ``coded`` vectors: its whitener, and the largest absolute entry
    of whitened covariance minus identity."""
    distinct = materialise(vectors.select("dim", "code").distinct(), "vectors")
    spectra = {r["dim"]: r for r in _up_a_tree(distinct.mapInArrow(_decomposed, _PART), _combined, _PART, "spectra")}
    sums = {d: np.frombuffer(r["sums"], np.int64) for d, r in spectra.items()}
    means = {d: s / spectra[d]["n"] for d, s in sums.items()}
    # Orthonormal to the last digit before it is refined.
    bases = {d: np.linalg.qr(_spectrum(r).vectors[0].T)[0].T for d, r in spectra.items()}
    projected = _squares(distinct, means, bases)
    whiteners = {d: Whitener(r["n"], sums[d], bases[d], projected[d], components) for d, r in spectra.items()}
    left = _squares(distinct, means, {d: w.scaled for d, w in whiteners.items()})
    return {d: (w, float(np.abs(left[d] / w.n - np.diag(w.real.astype(float))).max(initial=0)))
            for d, w in whiteners.items()}


def _deviations(x: np.ndarray, w: Whitener) -> list[int] | np.ndarray:
    """Exact sums of squares of ``n * x - sums``."""
    apart = int(np.abs(x).max(initial=0)) * w.n + int(np.abs(w.sums).max(initial=0))
    if apart * apart * x.shape[1] < 1 << 63:
        gap = x * w.n - w.sums
        return (gap * gap).sum(1)
    gap = x.astype(object) * w.n - w.sums.astype(object)
    return (gap * gap).sum(1).tolist()


def whitened(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS,
             carried: list[str] | None = None) -> DataFrame:
    """``row``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error`` and ``deviation_exact`` of every usable vector and component."""
    spark = vectors.sparkSession
    rows = coded(vectors, vector_col, carried, LIMIT)
    models = fitted(rows, components)
    shared = spark.sparkContext.broadcast({d: w for d, (w, _) in models.items()})

    def run(batches):
        for batch in batches:
            for dim, at, x in by_dim(batch):
                model = shared.value[dim]
                y = (x - model.mean) @ model.scaled.T
                far = _deviations(x, model)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(pa.array(at)), pa.array(np.full(len(at), dim, np.int32)),
                     pa.array([int(v) if v < 1 << 63 else None for v in far], pa.int64())
                     if isinstance(far, list) else pa.array(far),
                     pa.array([str(v) if v >= 1 << 63 else None for v in far], pa.string())
                     if isinstance(far, list) else pa.nulls(len(at), pa.string()),
                     pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * y.shape[1], y.ravel())],
                    names=["row", "dim", "deviation", "large", "values"])
    kind = rows.schema["row"].dataType.simpleString()
    found = rows.mapInArrow(run, f"row {kind}, dim int, deviation bigint, large string, values array<double>")
    fits = spark.createDataFrame(
        [(d, w.n, [float(v) for v in w.explained], error) for d, (w, error) in models.items()],
        "dim int, n bigint, shares array<double>, identity_error double")
    # One row for each length of vector; the driver holds a matrix for each already.
    return found.join(F.broadcast(fits), "dim").select(
        "row", "n", "deviation", "large", "shares", "identity_error", F.posexplode("values").alias("at", "whitened")
    ).select("row", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
             F.col("shares")[F.col("at")].alias("explained"), "identity_error",
             F.col("large").alias("deviation_exact"))
