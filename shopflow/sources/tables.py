"""Readers for the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopflow.session import use_utc


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table.  Column pruning and filter pushdown happen in the
    scan because callers only ever select / filter on the result."""
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_day_range(spark: SparkSession, path: str, start_date: str, end_date: str,
                   by: str = "date", schema=None) -> DataFrame:
    """Read a day-partitioned table for an inclusive range: the predicate
    is on the partition column, so only the matching directories are listed
    and read (PartitionFilters).  With ``schema`` the stored types are kept
    (partition discovery would turn a yyyy-MM-dd string into a date)."""
    from pyspark.sql import functions as F
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).where(F.col(by).between(start_date, end_date))


def normalize_actions(actions: DataFrame) -> DataFrame:
    """Bring an action table in the reference's format (``action_time`` as
    ``yyyy-MM-dd HH:mm:ss`` text, no event id) to the form the jobs use: the
    time parsed once, and ``event_id`` as the tie-break for equal times.
    Without a stored id, the id is a 64-bit hash of the whole row: it is
    deterministic (a recomputed task yields the same ids), and rows with
    equal hashes are identical rows, whose order cannot matter."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StringType
    out = actions
    if isinstance(out.schema["action_time"].dataType, StringType):
        out = out.withColumn("action_time", F.to_timestamp("action_time", "yyyy-MM-dd HH:mm:ss"))
    if "event_id" not in out.columns:
        out = out.withColumn("event_id", F.xxhash64(*[F.col(c) for c in actions.columns]))
    return out
