"""Result tables of the streams: Parquet partitioned by day (or by batch), each
micro-batch overwriting the partitions it touches (dynamic partition
overwrite).

The operators give absolute totals, so writing a batch again, after a failure,
changes nothing.  Totals themselves live in Spark's checkpointed state
(``totals_in_state`` reads them from there); a day that a dying driver left
half replaced can be written again from them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_TOUCHED_DAYS = 1000


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The stored rows, in the order of ``schema``; none before the first
    batch."""
    try:
        return spark.read.schema(schema).parquet(path).select(*spark.createDataFrame([], schema).columns)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _overwrite(rows: DataFrame, path: str, partition: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def merge_days(rows: DataFrame, path: str, schema: str, keys: list[str]) -> None:
    """Overwriting upsert by ``keys`` (whole groups, where several rows share
    them) into the table of ``schema``, partitioned by ``date``: only the days
    that ``rows`` touches are read and replaced."""
    days = [r[0] for r in rows.select("date").distinct().limit(MAX_TOUCHED_DAYS + 1).collect()]
    if not days:
        return
    stored = read_table(rows.sparkSession, path, schema)
    if len(days) <= MAX_TOUCHED_DAYS:  # else a backfill: all days
        stored = stored.where(F.col("date").isin(days))
    kept = stored.join(rows.select(*keys).distinct(), keys, "left_anti")
    _overwrite(kept.unionByName(rows.select(*kept.columns)), path, "date")


def put_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """The rows of a micro-batch, in place of those of an earlier try."""
    _overwrite(rows.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")), path, "batch_id")


def totals_in_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The running totals of a stopped query (kind, date, g, a, item,
    click_count), from its checkpoint.  ``operator`` numbers the query's
    stateful operators from 0, the one nearest to the sink first."""
    state = (spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator)
             .option("stateVarName", "totals").load())
    v = F.col("user_map_value")
    held = F.arrays_zip(v["a"].alias("a"), v["items"].alias("item"), v["counts"].alias("click_count"))
    return state.select("user_map_key.kind", "user_map_key.date", "user_map_key.g", F.inline(held))
