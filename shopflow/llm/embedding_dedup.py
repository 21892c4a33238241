"""Near-duplicate vectors: iterative quantisation and multi-index Hamming tables.

A rotation learned on a bounded sample (principal axes, then the alternation
between binary codes and the best rotation onto them) turns vectors into
balanced bits; further starts give as many bits as the tables need.  The code
is cut into disjoint keys, one table each, and vectors that share a key in any
table are compared with their original components in double precision.  Key
length grows with the logarithm of the row count, so a bucket holds about
OCCUPANCY vectors at every size, and the number of tables follows from the
chance that a pair at the threshold shares no key.

Equal vectors are one class.  A bucket larger than CHUNK classes is dealt into
parts, and every pair of parts is a block of its own, so no block is larger
than a chunk.  Blocks give counts and spanning edges of their links, never pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import blocks, runs, written
from shopflow.llm.components import components

SAMPLE = 10_000
OCCUPANCY = 64
CHUNK = 4096
MISS = 0.01
ITERATIONS = 30


def learn_rotations(sample: np.ndarray, blocks: int, iterations: int = ITERATIONS) -> np.ndarray:
    """(dims, blocks * dims) projections whose signs are the code bits.  The
    data are unit vectors and stay uncentred: a large group of near copies
    must not become noise around its own mean."""
    dims = sample.shape[1]
    _, axes = np.linalg.eigh(sample.T @ sample)
    v = sample @ axes
    out = []
    for block in range(blocks):
        r, _ = np.linalg.qr(np.random.default_rng(block).standard_normal((dims, dims)))
        for _ in range(iterations):
            b = np.where(v @ r >= 0, 1.0, -1.0)
            u, _, w = np.linalg.svd(b.T @ v)
            r = (u @ w).T
        out.append(axes @ r)
    return np.concatenate(out, axis=1)


def plan_tables(n: int, threshold: float, miss: float = MISS, occupancy: int = OCCUPANCY) -> tuple[int, int]:
    """(bits per key, tables)."""
    bits = max(6, min(60, math.ceil(math.log2(max(n, 1) / occupancy)) if n > occupancy else 6))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(4, math.ceil(math.log(miss) / math.log(1 - agree)))


def _unit(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, digest, dims, unit): unit is the vector over its norm as double
    bytes, digest of it; null where the vector links with nothing."""
    def run(batches):
        for batch in batches:
            digests, dims, units = [], [], []
            for value in batch.column(1):
                x = np.array(value.as_py() if value.is_valid else [], dtype=np.float64)  # null components become nan
                big = np.abs(x).max() if len(x) else 0.0
                if not len(x) or not np.isfinite(x).all() or big == 0:
                    digests.append(None), dims.append(None), units.append(None)
                    continue
                x = x / big
                x = (x / np.sqrt(x @ x) + 0.0).tobytes()
                digests.append(hashlib.md5(x).digest()), dims.append(len(x) // 8), units.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, type=pa.binary()), pa.array(dims, type=pa.int32()),
                                              pa.array(units, type=pa.binary())], names=["id", "digest", "dims", "unit"])

    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col)).mapInArrow(
        run, "id long, digest binary, dims int, unit binary")


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (per member the smallest member it is connected to) after the
    links (a, b) have been added."""
    while True:
        x, y = label[a], label[b]
        open_ = np.flatnonzero(x != y)
        if not len(open_):
            return label
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while ((up := label[label]) != label).any():
            label = up


def _block(units, counts, keys, parts, i: int, j: int, t: int, cids, threshold: float):
    """(cid, links, low) of the members of one block, given by ascending cid:
    low is the smallest cid that links of the block connect it to."""
    x = np.frombuffer(b"".join(units)).reshape(len(units), -1)
    left = np.flatnonzero(parts == i)
    right = left if i == j else np.flatnonzero(parts == j)
    links = np.zeros(len(units), dtype=np.int64)
    label = np.arange(len(units))
    for lo in range(0, len(left), 512):
        rows = left[lo:lo + 512]
        a, b = np.nonzero(x[rows] @ x[right].T >= threshold)
        a, b = rows[a], right[b]
        a, b = (a[a < b], b[a < b]) if i == j else (a, b)
        if not len(a):
            continue
        label = _join(label, a, b)
        new = ~(keys[a, :t] == keys[b, :t]).any(axis=1)  # not met in an earlier table
        np.add.at(links, a[new], counts[b[new]])
        np.add.at(links, b[new], counts[a[new]])
    some = np.flatnonzero((links > 0) | (label < np.arange(len(units))))
    return cids[some], links[some], cids[label[some]]


def _compare(rows: DataFrame, threshold: float) -> DataFrame:
    """(cid, links, low) from rows sorted by block inside each partition."""
    def emit(table):
        head = {c: table.column(c)[0].as_py() for c in ("t", "i", "j")}
        keys = np.array(table.column("keys").to_pylist(), dtype=np.int64)
        col = lambda c: table.column(c).to_numpy()
        cids, links, low = _block(table.column("unit").to_pylist(), col("c"), keys, col("part"), head["i"], head["j"],
                                  head["t"], col("cid"), threshold)
        return pa.RecordBatch.from_arrays([pa.array(cids), pa.array(links), pa.array(low)], names=["cid", "links", "low"])

    def run(batches):
        for table in runs(batches, ["dims", "t", "key", "i", "j"]):
            yield emit(table)

    return rows.mapInArrow(run, "cid long, links long, low long")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9,
                 miss: float = MISS, sample_rows: int = SAMPLE) -> DataFrame:
    """(id, n_links, component_id, kept) per row of ``vectors``.

    Two vectors are linked when their cosine in double precision is at least
    ``threshold``; none below it is.  A pair at the threshold is missed with a
    chance of about ``miss``, a closer one with less.  Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing;
    vectors link with those of their own length, each length with a rotation
    and tables of its own.  Rows of equal vectors always share a class.
    Rows may repeat ids; a null id names a component only where no id is known."""
    spark = vectors.sparkSession
    unit = written(_unit(vectors, id_col, vec_col), "units")
    classes = written(unit.filter("digest is not null").groupBy("digest")
                      .agg(F.min("id").alias("rep"), F.count("*").alias("c"), F.first("dims").alias("dims"), F.first("unit").alias("unit"))
                      .withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    plans = {}  # per length: bits per key, tables, projections
    for r in classes.groupBy("dims").count().filter("count > 1").collect():
        dims = r["dims"]
        bits, tables = plan_tables(r["count"], threshold, miss)
        sample = (classes.filter(F.col("dims") == dims).orderBy(F.xxhash64("digest"), "cid").select("unit").limit(sample_rows).collect())
        sample = np.frombuffer(b"".join(bytes(x["unit"]) for x in sample)).reshape(len(sample), dims)
        plans[dims] = bits, tables, learn_rotations(sample, -(-bits * tables // dims))[:, :bits * tables]
    codes = spark.sparkContext.broadcast(plans)

    def encode(batches):
        for batch in batches:
            lengths = batch.column(3).to_numpy()
            for dims in np.unique(lengths).tolist():
                bits, tables, projections = codes.value[dims]
                part = batch.filter(pa.array(lengths == dims))
                x = np.frombuffer(b"".join(part.column(2).to_pylist())).reshape(part.num_rows, dims)
                signs = (x @ projections >= 0).reshape(len(x), tables, bits)
                keys = signs @ (1 << np.arange(bits, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(keys), type=pa.list_(pa.int64()))],
                                                 names=["cid", "c", "unit", "dims", "keys"])

    usable = classes.filter(F.col("dims").isin(list(plans)))
    coded = written(usable.select("cid", "c", "unit", "dims")
                    .mapInArrow(encode, "cid long, c long, unit binary, dims int, keys array<long>"), "codes")
    light = coded.select("cid", "dims", F.posexplode("keys").alias("t", "key"))
    dealt = blocks(light, ["dims", "t", "key"], "cid", CHUNK)
    rows = (dealt.join(coded.drop("dims"), "cid").repartition("dims", "t", "key", "i", "j")
            .sortWithinPartitions("dims", "t", "key", "i", "j", "cid"))
    found = written(_compare(rows, threshold).groupBy("cid", "low").agg(F.sum("links").alias("links")), "vector-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    labels = components(found, "cid", "low").withColumnRenamed("id", "cid")
    named = (classes.join(labels, "cid", "left").join(links, "cid", "left")
             .select("digest", "rep", "c", F.coalesce("component", "cid").alias("component"), F.coalesce("links", F.lit(0)).alias("links")))
    lowest = named.groupBy("component").agg(F.min("rep").alias("low"))
    of = named.join(lowest, "component").select("digest", (F.col("c") - 1 + F.col("links")).alias("links"), "low")
    return (unit.select("id", "digest").join(of, "digest", "left")
            .select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("low")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))
