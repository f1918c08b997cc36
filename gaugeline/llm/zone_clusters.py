"""Nearest-centroid clustering over zone maps along a Hilbert curve.

Vectors are ordered along a Hilbert curve through their most varying components and cut
into blocks that store the smallest and largest value of every component, a box. A box
bounds the distances of all its vectors to a centroid from below and above: a centroid
whose lower bound exceeds another's upper bound cannot be the nearest of any of them. The
rest, the block's candidates, are compared with every vector exactly, in whole numbers.

Per round a task returns one sum per centroid and component; the blocks are written once.

Edge cases: vectors that are null, of another length, or hold null or non-finite
components (or components of 2^21 or more in size) are left out; repeated rows and equal
ids are vectors of their own; a null id sorts last when the first centroids are chosen;
with fewer vectors than centroids each vector starts one; an empty table has no rows; other
columns, whatever their names, are carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .vectors import coded, decoded, encoded

DIMS, CENTROIDS, ROUNDS = 64, 16, 3
LIMIT = float(1 << 27)  # squared distances of 64 such components fit a long
CURVE_DIMS, CURVE_BITS = 16, 4  # a place on the curve fills 64 bits
BLOCK = 256


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with whole coordinates below ``2 ** bits``
    (Skilling's transform, all points at once), in the order of signed longs."""
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, lower = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(dims):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & lower).astype(np.uint64)
            x[0] ^= np.where(flip, lower, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & np.uint64(1 << level), np.uint64((1 << level) - 1), np.uint64(0))
    x ^= turn
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            place = (place << np.uint64(1)) | ((x[i] >> np.uint64(level)) & np.uint64(1))
    place <<= np.uint64(64 - bits * dims)
    return (place ^ np.uint64(1 << 63)).view(np.int64)


def _moments(vectors: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of every component, summed by Spark."""
    def run(batches):
        total = np.zeros((3, dims))
        for batch in batches:
            x = decoded(batch.column("code"), dims).astype(float)
            total += [np.full(dims, len(x)), x.sum(0), (x * x).sum(0)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), *map(pa.array, total)],
                                         names=["i", "n", "s", "q"])
    found = vectors.select("code").mapInArrow(run, "i int, n double, s double, q double").groupBy("i").agg(
        F.sum("n"), F.sum("s"), F.sum("q")).orderBy("i").toArrow().to_pandas().to_numpy()
    if not len(found) or not found[0, 1]:
        return np.zeros(dims), np.zeros(dims)
    mean = found[:, 2] / found[:, 1]
    return mean, np.sqrt(np.maximum(found[:, 3] / found[:, 1] - mean ** 2, 0))


def blocks(vectors: DataFrame, dims: int) -> DataFrame:
    """``rows``, their ``codes``, and the box (``low``, ``high``) of every block, in curve order.

    Vectors are dealt by ranges of their place on the curve and then of their row number,
    so that many equal vectors fill several tasks.
    """
    mean, spread = _moments(vectors, dims)
    axes = np.argsort(-spread, kind="stable")[:CURVE_DIMS]
    low, width = mean[axes] - 2 * spread[axes], np.maximum(4 * spread[axes], 1e-9)
    schema = vectors.schema["row"].dataType.simpleString()

    def place(batches):
        for batch in batches:
            x = decoded(batch.column("code"), dims)[:, axes]
            cells = np.clip((x - low) / width * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "code", "number")), pa.array(
                hilbert(cells, CURVE_BITS))], names=["row", "code", "number", "place"])

    def cut(batches):
        for batch in batches:
            x = decoded(batch.column("code"), dims)
            starts = np.arange(0, len(x), BLOCK)
            ends = np.append(starts, len(x)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(ends, batch.column("row")), pa.ListArray.from_arrays(ends, batch.column("code")),
                 encoded(np.minimum.reduceat(x, starts), 8), encoded(np.maximum.reduceat(x, starts), 8)],
                names=["rows", "codes", "low", "high"])
    placed = vectors.select("row", "code", F.monotonically_increasing_id().alias("number")).mapInArrow(
        place, f"row {schema}, code binary, number bigint, place bigint")
    ordered = placed.repartitionByRange("place", "number").sortWithinPartitions("place", "number")
    return materialise(ordered.select("row", "code").mapInArrow(
        cut, f"rows array<{schema}>, codes array<binary>, low binary, high binary"), "blocks")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be the nearest of a vector in the box."""
    out = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    far = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    return np.flatnonzero((out * out).sum(1) <= (far * far).sum(1).min())


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest of ``centroids`` (the first of equally near ones) and squared distance."""
    size = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * size * size * x.shape[1] < 1 << 53:  # doubles hold every term exactly
        c = centroids.astype(float)
        y = x.astype(float)
        distances = (y * y).sum(1)[:, None] - 2 * (y @ c.T) + (c * c).sum(1)
    else:
        distances = np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)
    at = distances.argmin(1)
    return at, distances[np.arange(len(x)), at].astype(np.int64)


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each block of a batch: its place there, numbers, clusters and distances."""
    dims = centroids.shape[1]
    lows, highs = (decoded(batch.column(c), dims) for c in ("low", "high"))
    for i, codes in enumerate(batch.column("codes")):
        x = decoded(codes.values, dims)
        among = candidates(lows[i], highs[i], centroids)
        at, distance = nearest(x, centroids[among])
        yield i, x, among[at], distance


def _tallied(zones: DataFrame, centroids: np.ndarray) -> list[tuple[int, int, int, list[int]]]:
    """Per cluster: number, size, inertia and component sums, added up exactly by Spark."""
    k, dims = centroids.shape

    def run(batches):
        sizes, inertia, sums = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for _, x, cluster, distance in _assigned(batch, centroids):
                np.add.at(inertia, cluster, distance)
                sizes += np.bincount(cluster, minlength=k)
                for c in np.unique(cluster):
                    sums[c] += x[cluster == c].sum(0)
        table = np.concatenate([sizes[:, None], inertia[:, None], sums], 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k, dtype=np.int32), dims + 2)),
             pa.array(np.tile(np.arange(dims + 2, dtype=np.int32), k)), pa.array(table.ravel())],
            names=["cluster", "i", "total"])
    found = zones.select("codes", "low", "high").mapInArrow(run, "cluster int, i int, total bigint").groupBy(
        "cluster", "i").agg(F.sum("total").alias("total")).orderBy("cluster", "i").collect()
    totals = [[r["total"] for r in found[c * (dims + 2):(c + 1) * (dims + 2)]] for c in range(len(found) // (dims + 2))]
    return [(c, t[0], t[1], t[2:]) for c, t in enumerate(totals)]


def _first(vectors: DataFrame, id_col: str, dims: int, k: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes."""
    mixed = F.sha2(F.concat(F.lit("1:"), F.col("row")[id_col].cast("string")), 256)
    rows = vectors.select(mixed.alias("hash"), "code").orderBy(F.col("hash").asc_nulls_last(), "code").limit(k)
    return decoded(rows.select("code").toArrow().column("code").combine_chunks(), dims)


def clustered(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS,
              k: int = CENTROIDS, rounds: int = ROUNDS, carried: list[str] | None = None) -> DataFrame:
    """``row``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and
    ``centroid_sha256`` of every usable vector."""
    spark = vectors.sparkSession
    usable = materialise(coded(vectors, vector_col, carried, LIMIT).where(F.col("dim") == dims).select(
        "row", "code"), "vectors")
    centroids = _first(usable, id_col, dims, k)
    zones = blocks(usable, dims)
    for _ in range(rounds):
        for c, size, _, sums in _tallied(zones, centroids) if len(centroids) else []:
            if size:
                centroids[c] = [s // size for s in sums]
    last = _tallied(zones, centroids) if len(centroids) else []
    total = sum(inertia for _, _, inertia, _ in last)

    def run(batches):
        for batch in batches:
            rows, found = batch.column("rows"), list(_assigned(batch, centroids))
            yield pa.RecordBatch.from_arrays(
                [rows.flatten(), pa.array(np.concatenate([f[2] for f in found]).astype(np.int32)),
                 pa.array(np.concatenate([f[3] for f in found]))], names=["row", "cluster", "distance"])
    schema = usable.schema["row"].dataType.simpleString()
    about = spark.createDataFrame(
        [(c, inertia, total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
         for c, _, inertia, _ in last], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # One row per centroid.
    return zones.mapInArrow(run, f"row {schema}, cluster int, distance bigint").join(
        F.broadcast(about), "cluster").select("row", "cluster", "distance", "cluster_inertia", "inertia",
                                              "centroid_sha256")
