"""Centroid clustering with a LAESA pivot table.

The distances of every vector to a few fixed pivots are stored once, beside
the vector's integers.  In each round the difference between a vector's and a
centroid's distance to the same pivot bounds their distance from below, for
every centroid at once; only centroids whose bound does not exceed the best
exact distance so far get an exact one.  Exact distances are integers, so
results do not depend on rounding or on the order of rows.

A round reads the stored table, and each task sums its own vectors by cluster
before anything is shuffled.  The driver holds the centroids alone, k * dims
integers.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import written

DIMS, SCALE, K, ROUNDS, PIVOTS = 64, 256, 40, 5, 16
#: Scaled components up to here keep every distance within a long.
LARGEST = 1 << 27
_EXACT = 1 << 22  # up to here products of whole vectors are exact in doubles
_ROWS = 8192


def scaled(values: pa.ListArray, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, their integers): lists of ``dims`` components, none null or
    not finite, as floor(scale * x)."""
    n = len(values)
    lengths = np.asarray(values.value_lengths().fill_null(-1))
    at = np.flatnonzero(lengths == dims)
    if not len(at):
        return at, np.empty((0, dims), dtype=np.int64)
    starts = np.asarray(values.offsets)[:n].astype(np.int64)[at]
    flat = values.values.to_numpy(zero_copy_only=False)  # null components become nan
    with np.errstate(over="ignore"):
        x = np.floor(scale * flat[starts[:, None] + np.arange(dims)].astype(np.float64))
    good = (np.abs(x) <= LARGEST).all(axis=1)  # false for nan and infinities too
    return at[good], x[good].astype(np.int64)


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` from the rows of ``c``."""
    if len(x) and len(c) and max(np.abs(x).max(), np.abs(c).max()) <= _EXACT:
        xf, cf = x.astype(np.float64), c.astype(np.float64)
        return ((xf * xf).sum(axis=1)[:, None] - 2 * (xf @ cf.T) + (cf * cf).sum(axis=1)[None, :]).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1) if len(c) else np.empty((len(x), 0), dtype=np.int64)


def choose_pivots(seeds: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Rows of ``seeds`` far from each other: each next one has the largest
    distance from its nearest pivot so far."""
    chosen = [0]
    low = squares(seeds, seeds[:1])[:, 0]
    while len(chosen) < min(pivots, len(seeds)):
        chosen.append(int(low.argmax()))
        low = np.minimum(low, squares(seeds, seeds[chosen[-1:]])[:, 0])
    return seeds[chosen]


def assign(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance, exact distances computed) per row of ``x``;
    ``to_pivots`` holds the rows' stored distances.  Ties go to the smaller
    cluster: a centroid is left out only if its bound is above the best by more
    than all rounding."""
    of_centroids = np.sqrt(squares(centroids, pivots).astype(np.float64))
    bound = np.zeros((len(x), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - of_centroids[None, :, p]), out=bound)
    slack = 1e-9 * (to_pivots.max(axis=1, initial=0) + of_centroids.max(initial=0) + 1)
    out = np.full(bound.shape, np.iinfo(np.int64).max)
    first = bound.argmin(axis=1)
    best = np.empty(len(x))
    asked = len(x)
    for c in np.unique(first).tolist():
        rows = np.flatnonzero(first == c)
        out[rows, c] = squares(x[rows], centroids[c:c + 1])[:, 0]
        best[rows] = np.sqrt(out[rows, c].astype(np.float64))
    open_ = bound <= (best + slack)[:, None]
    open_[np.arange(len(x)), first] = False
    # the nearest bounds first: what they find closes others
    for c in np.argsort(bound.mean(axis=0)).tolist() if len(x) else []:
        rows = np.flatnonzero(open_[:, c] & (bound[:, c] <= best + slack))
        if len(rows):
            out[rows, c] = squares(x[rows], centroids[c:c + 1])[:, 0]
            best[rows] = np.minimum(best[rows], np.sqrt(out[rows, c].astype(np.float64)))
            asked += len(rows)
    cluster = out.argmin(axis=1)
    return cluster, out[np.arange(len(x)), cluster], asked


@dataclass
class Clusters:
    """The last centroids (integers), the rows' assignment to them, and how
    many exact distances each pass computed (of rows * k)."""
    centroids: np.ndarray
    assigned: DataFrame
    computed: list[int]


# Integers as bytes that sort as the integers do.
def _packed(x: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in (x + (1 << 31)).astype(">u4")]


def _unpacked(column: list[bytes], dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=">u4").reshape(len(column), dims).astype(np.int64) - (1 << 31)


def _kept(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            at, x = scaled(batch.column(1), dims, scale)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(_packed(x), type=pa.binary())], names=["id", "x"])

    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>")).mapInArrow(run, "id long, x binary")


def pivot_table(kept: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(id, x, to_pivots): the vectors with their distances to the pivots,
    stored once for all rounds."""
    def run(batches):
        for batch in batches:
            d = np.sqrt(squares(_unpacked(batch.column(1).to_pylist(), pivots.shape[1]), pivots).astype("<f8"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r.tobytes() for r in d], type=pa.binary())], names=["id", "x", "to_pivots"])

    return written(kept.mapInArrow(run, "id long, x binary, to_pivots binary"), "pivot-table")


def _parts(batches, dims: int, n_pivots: int):
    """(ids, integers, stored distances) of at most _ROWS rows at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, _ROWS):
            part = batch.slice(lo, _ROWS)
            d = np.frombuffer(b"".join(part.column(2).to_pylist()), dtype="<f8").reshape(part.num_rows, n_pivots)
            yield part.column(0), _unpacked(part.column(1).to_pylist(), dims), d


def _moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, int]:
    """Centroids after one round, and the exact distances it computed."""
    k, dims = centroids.shape

    def run(batches):
        n, total, asked = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64), 0
        for _, x, d in _parts(batches, dims, len(pivots)):
            found, _, some = assign(x, d, centroids, pivots)
            order = np.argsort(found, kind="stable")
            at = np.flatnonzero(np.diff(found[order], prepend=-1))
            total[found[order[at]]] += np.add.reduceat(x[order], at, axis=0)
            n += np.bincount(found, minlength=k)
            asked += some
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(n), pa.array([asked] + [0] * (k - 1), type=pa.int64()),
                                          pa.array(total.tolist(), type=pa.list_(pa.int64()))], names=["cluster", "n", "asked", "total"])

    sums = table.mapInArrow(run, "cluster int, n long, asked long, total array<long>")
    # k * dims rows come to the driver, whatever the table holds
    rows = (sums.select("cluster", "n", "asked", F.posexplode("total").alias("i", "v")).groupBy("cluster", "i")
            .agg(F.sum("n").alias("n"), F.sum("asked").alias("asked"), F.sum("v").alias("v")).collect())
    out = centroids.copy()
    for r in rows:
        if r["n"]:
            out[r["cluster"], r["i"]] = r["v"] // r["n"]
    return out, sum(r["asked"] for r in rows if r["i"] == 0)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = DIMS, scale: int = SCALE,
            k: int = K, rounds: int = ROUNDS, pivots: int = PIVOTS, seed: str = "2:") -> Clusters:
    """Cluster the vectors of exactly ``dims`` components, none null or not
    finite, each component as the integer floor(``scale`` * x).

    The first centroids are the ``k`` kept vectors with the smallest sha256 of
    ``seed`` and the id, in that order (equal ids: smaller integers first; null
    ids last); with fewer vectors, all of them.  Each round assigns every
    vector to the nearest centroid (ties: the smaller number) and moves each
    non-empty centroid to the floor of its vectors' mean; after the rounds the
    vectors are assigned once more.  ``assigned`` is (id, cluster, distance)
    with squared distances; rows that repeat ids or vectors are rows of their
    own.  Vectors with a scaled component beyond +-2**27 are not kept, as their
    distances need not fit a long.  An empty table, or one without such
    vectors, gives no centroids and no rows.  Only the two columns are read."""
    kept = _kept(vectors, id_col, vec_col, dims, scale)
    order = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")).cast("binary"), 256)
    first = [bytes(r["x"]) for r in kept.orderBy(order.asc_nulls_last(), "x").limit(k).collect()]
    now, computed = _unpacked(first, dims), []
    fixed = choose_pivots(now, pivots) if len(now) else now
    table = pivot_table(kept, fixed)
    for _ in range(rounds if len(now) else 0):
        now, asked = _moved(table, now, fixed)
        computed.append(asked)

    def run(batches):
        for ids, x, d in _parts(batches, dims, len(fixed)):
            found, distance, _ = assign(x, d, now, fixed)
            yield pa.RecordBatch.from_arrays([ids, pa.array(found.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    return Clusters(now, written(table.mapInArrow(run, "id long, cluster int, distance long"), "assigned"), computed)


def with_inertia(found: Clusters) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256); a
    sum beyond a long is null."""
    per = found.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    sums = {r["cluster"]: int(r["s"]) for r in per.collect()}  # at most k rows
    fits = lambda v: v if v < 1 << 63 else None
    total = fits(sum(sums.values()))
    rows = [(c, fits(s), total, hashlib.sha256(",".join(map(str, found.centroids[c].tolist())).encode()).hexdigest()) for c, s in sums.items()]
    facts = found.assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.assigned.join(F.broadcast(facts), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
