"""Small helpers of the training-data operators."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopflow.session import scratch_dir


ROOT = str(Path(__file__).resolve().parents[2])


def ready(spark: SparkSession) -> None:
    """Python workers find this package where the driver has it, whatever
    folder the session was started in."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH = 1024  # rows that hold whole texts or sets, at a time


@contextmanager
def batches_of(spark: SparkSession, rows: int | None):
    """Python operators in what runs inside get at most ``rows`` rows at a time
    (None: as many as the session says)."""
    before = spark.conf.get(_BATCH, None)
    if rows:
        spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        if rows:
            spark.conf.unset(_BATCH) if before is None else spark.conf.set(_BATCH, before)


def written(df: DataFrame, name: str, batch_rows: int | None = None, **options) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts
    the lineage at a copy that outlives any executor.  Python operators in it
    get at most ``batch_rows`` rows at a time, for rows that are large."""
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    with batches_of(df.sparkSession, batch_rows):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROWS_PER_BUCKET = 200_000


def bucket_count(n_rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(1, math.ceil(n_rows / per_bucket))


def gapless_rank(df: DataFrame, key: str, order: list[str], n_rows: int, out: str) -> DataFrame:
    """Rank (long, from 0, gapless) of each row among the rows of its ``key``.

    A key may hold any share of the rows: rows are dealt into hash buckets of
    about ROWS_PER_BUCKET, ranked inside (key, bucket), and shifted by the
    counts of the key's earlier buckets.  ``df`` should be stored (it is read
    twice); rows that tie in ``order`` get ranks in any order."""
    part = F.pmod(F.xxhash64(*order), F.lit(bucket_count(n_rows))).cast("int")
    df = df.withColumn("_bucket", part)
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (df.groupBy(key, "_bucket").agg(F.count("*").alias("_n"))
              .select(key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(inside) - 1)
            .join(starts, [key, "_bucket"])
            .withColumn(out, (F.col("_start") + F.col("_rank")).cast("long"))
            .drop("_bucket", "_rank", "_start"))


def blocks(members: DataFrame, keys: list[str], id_col: str, chunk: int) -> DataFrame:
    """``members`` (keys, id, ...) dealt for comparing the members of each key
    pair by pair, with ``part``, ``i`` and ``j``: a key of at most ``chunk``
    members is the block (0, 0); a larger one is cut into parts of about half
    a chunk by hash, and each pair of parts i <= j is a block, so no block
    holds much more than ``chunk`` members whatever the key holds."""
    large = members.groupBy(*keys).count().filter(F.col("count") > chunk).select(
        *keys, F.ceil(F.col("count") / (chunk / 2)).cast("int").alias("_parts"))
    return (members.join(large, keys, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
            .withColumn("part", F.pmod(F.xxhash64(id_col), F.col("_parts")).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
            .withColumn("i", F.least("part", "_other")).withColumn("j", F.greatest("part", "_other"))
            .drop("_parts", "_other"))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows that agree in the (integer) ``keys``, from
    batches sorted by them; runs of a single row are left out."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        if not table.num_rows:
            continue
        same = np.ones(table.num_rows - 1, dtype=bool)
        for c in keys:
            v = table.column(c).to_numpy()
            same &= v[1:] == v[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(~same) + 1]).tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a > 1:
                yield table.slice(a, b - a)
        rest = table.slice(cuts[-1])
    if rest is not None and rest.num_rows > 1:
        yield rest
