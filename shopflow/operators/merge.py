"""Keyed merges of result tables, set-based (one shuffle on the keys each).

The reference keeps its result tables in MySQL and merges row by row; here
a merge is a DataFrame → DataFrame operator over (current table, batch of
updates), returning the new table and an ``action`` per row
('kept' / 'inserted' / 'updated' / 'replaced').
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _tagged(target: DataFrame, updates: DataFrame, cols: Sequence[str]) -> DataFrame:
    t = target.select(*cols, F.lit(1).alias("_in_t"), F.lit(0).alias("_in_u"))
    u = updates.select(*cols, F.lit(0).alias("_in_t"), F.lit(1).alias("_in_u"))
    return t.unionByName(u)


def _action(in_t, in_u):
    return (F.when((in_t == 1) & (in_u == 1), "updated")
            .when(in_u == 1, "inserted").otherwise("kept"))


def upsert_add(target: DataFrame, updates: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Insert new keys; add the update to the stored value of existing keys."""
    merged = _tagged(target, updates, [*keys, value]).groupBy(*keys).agg(
        F.sum(value).cast("bigint").alias(value), F.max("_in_t").alias("_in_t"), F.max("_in_u").alias("_in_u"))
    return merged.select(*keys, value, _action(F.col("_in_t"), F.col("_in_u")).alias("action"))


def upsert_set(target: DataFrame, updates: DataFrame, keys: Sequence[str],
               values: Sequence[str]) -> DataFrame:
    """Insert new keys; overwrite the values of existing keys.  ``updates``
    holds one row per key."""
    # One max_by per value (fixed-width buffers keep this a hash aggregate);
    # a key has at most one row per side, so all of them pick the same row.
    merged = (_tagged(target, updates, [*keys, *values])
              .groupBy(*keys).agg(*[F.max_by(v, F.col("_in_u")).alias(v) for v in values],
                                  F.max("_in_t").alias("_in_t"), F.max("_in_u").alias("_in_u")))
    return merged.select(*keys, *values, _action(F.col("_in_t"), F.col("_in_u")).alias("action"))


def replace_groups(target: DataFrame, updates: DataFrame, group_keys: Sequence[str]) -> DataFrame:
    """Every group (by ``group_keys``) present in ``updates`` is replaced
    whole by its update rows; other groups are kept."""
    cols = target.columns
    touched = updates.select(*group_keys).distinct()
    kept = target.join(touched, list(group_keys), "left_anti").select(*cols).withColumn("action", F.lit("kept"))
    old_groups = target.select(*group_keys).distinct().withColumn("_old", F.lit(True))
    new = (updates.select(*cols).join(old_groups, list(group_keys), "left")
           .select(*cols, F.when(F.col("_old"), "replaced").otherwise("inserted").alias("action")))
    return kept.unionByName(new)


def append_distinct(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append the rows of ``new`` whose key is not yet in ``target``, with all
    columns of ``target``; one row per key, the smallest where several have it."""
    rest = [c for c in target.columns if c not in keys]

    def one_per_key(df: DataFrame) -> DataFrame:
        if not rest:
            return df.select(*keys).distinct()
        return (df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
                .select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in target.columns]))

    added = one_per_key(new).join(target.select(*keys), list(keys), "left_anti")
    return (one_per_key(target).withColumn("action", F.lit("kept"))
            .unionByName(added.withColumn("action", F.lit("inserted"))))


def lookup_by_key(batch: DataFrame, stored: DataFrame, keys: Sequence[str], value: str,
                  alias: str, default: int = 0) -> DataFrame:
    """For every batch key, the stored value (``default`` when absent)."""
    s = stored.select(*keys, F.col(value).alias(alias))
    return (batch.join(s, list(keys), "left")
            .withColumn(alias, F.coalesce(F.col(alias), F.lit(default).cast("bigint"))))
