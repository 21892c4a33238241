"""Result sinks: append a result with its run id, overwrite a managed table,
or write through JDBC (the reference's MySQL tables)."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def append_result(df: DataFrame, path: str, task_id: str, fmt: str = "parquet") -> None:
    """Store the result of one run as the ``task_id`` partition of ``path``.
    A rerun with the same id replaces its own rows and nothing else."""
    df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/task_id={quote(task_id, safe='')}")


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Drop-and-recreate a table; with ``path`` it is an external table in
    the shared folder rather than the local warehouse."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def write_partitioned(df: DataFrame, path: str, by: str = "date", within: str = "event_id",
                      mode: str = "overwrite") -> None:
    """Store a table partitioned by ``by`` (the action table by day), so a
    later range read prunes whole directories instead of filtering rows.

    Rows are range-partitioned on (by, within) first: each task writes a few
    days, and a hot day is split over several tasks by its ``within`` range
    (deterministic, unlike a random salt, so task retries write the same
    files)."""
    df.repartitionByRange(by, within).write.mode(mode).partitionBy(by).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **props: str) -> None:
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    for k, v in props.items():
        w = w.option(k, v)
    w.save()


def read_back(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The stored runs; a task id is text even where it looks like a number."""
    found = spark.read.format(fmt).load(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name == "task_id" else f for f in found.fields]
    return spark.read.schema(T.StructType(fields)).format(fmt).load(path)
