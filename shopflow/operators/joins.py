"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIMENSION_MAX_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = DIMENSION_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only after checking it holds at most ``max_rows``
    rows; the check reads at most ``max_rows + 1`` rows.  Beyond the bound
    the plain DataFrame is returned and the planner shuffles (or AQE
    broadcasts from runtime statistics)."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


GROUP_LIMIT = 1000
SALTS = 64


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """A superset of the first ``n`` rows of every key under ``order`` that
    is small for every key.  Up to GROUP_LIMIT the optimizer's own cut inside
    each task (window group limit) does that for the ranking that follows,
    and ``df`` is returned; beyond it each key is first ranked in SALTS
    parts, so a hot key is never ranked whole in one task."""
    if n <= GROUP_LIMIT:
        return df
    part = Window.partitionBy(*keys, "_salt").orderBy(*order)
    return (df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
            .withColumn("_rn", F.row_number().over(part)).where(F.col("_rn") <= n).drop("_salt", "_rn"))
