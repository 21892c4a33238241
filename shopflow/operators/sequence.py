"""Consecutive rows inside a group, without putting a hot group into one
task.

``lead`` over ``partitionBy(group)`` sends every row of a group to a single
task; one hot session (a crawler holding a third of all actions, or the rows
without a session) would then be one task.  Here:

1. one partially aggregated pass counts rows per group and takes the span of
   the sort position; groups above ``hot_rows`` are *hot*.  There are at most
   rows / hot_rows of them, the proven bound under which they are broadcast;
   the pass is part of the same plan, no job runs while it is built;
2. a hot group is cut into chunks of its own span, about one per
   ``hot_rows`` / CHUNKS_PER_HOT rows where positions are even, so sparse
   ids are cut as well as dense ones; every other group is one chunk;
3. ``lead`` inside each (group, chunk) gives every pair except those that
   cross from a chunk to the next;
4. each chunk of a hot group contributes at most two boundary rows (its
   first and last); a window over the boundary rows of a group links each
   chunk's last row to the following chunk's first row.

Step 4 sees at most two rows per chunk, so a hot group costs at most
2 x (number of chunks) rows in one task.  The null group is a group like any
other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
CHUNKS_PER_HOT = 4


def hot_groups(df: DataFrame, group: str, position: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(_group, _lo, _width): the groups above ``hot_rows`` rows, their first
    position and the width of one chunk."""
    n = F.greatest(F.ceil(F.col("_n") * CHUNKS_PER_HOT / max(hot_rows, 1)), F.lit(1))
    return (df.groupBy(F.col(group).alias("_group"))
            .agg(F.count(F.lit(1)).alias("_n"), F.min(position).alias("_lo"), F.max(position).alias("_hi"))
            .where(F.col("_n") > hot_rows)
            .select("_group", "_lo", F.greatest((F.col("_hi") - F.col("_lo") + 1) / n, F.lit(1.0)).alias("_width")))


def with_chunks(df: DataFrame, group: str, position: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` with ``_hot`` and ``_chunk`` (0 outside hot groups)."""
    hot = hot_groups(df, group, position, hot_rows)
    return (df.join(F.broadcast(hot), df[group].eqNullSafe(hot["_group"]), "left")
            .withColumn("_hot", F.col("_width").isNotNull())
            # a null position sorts first
            .withColumn("_chunk", F.when(F.col("_hot"), F.coalesce(F.floor((position - F.col("_lo")) / F.col("_width")), F.lit(-1)))
                        .otherwise(F.lit(0)).cast("bigint"))
            .drop("_group", "_lo", "_width"))


def consecutive_pairs(df: DataFrame, group: str, order: Sequence[str], chunk: Column,
                      cols: Sequence[str], hot_rows: int = HOT_ROWS, keep_last: bool = False) -> DataFrame:
    """Rows (group, c..., next_c...) for every row that has a successor in
    its group under ``order`` (which must be a total order, e.g. ending in a
    unique id).  ``chunk`` is a number that does not decrease along ``order``.
    With ``keep_last`` the last row of each group is returned too, its next_c
    null and ``has_next`` false, so one pass also counts all rows."""
    keep = list(dict.fromkeys([*order, *cols]))
    d = with_chunks(df.select(group, *keep), group, chunk, hot_rows)
    w = Window.partitionBy(group, "_chunk").orderBy(*order)
    marked = d.select(
        "*",
        *[F.lead(c).over(w).alias(f"next_{c}") for c in cols],
        F.lead(F.lit(1)).over(w).isNull().alias("_last"),
        (F.row_number().over(w) == 1).alias("_first"))
    out = [group, *cols, *[f"next_{c}" for c in cols], "has_next"]
    inside = marked.withColumn("has_next", ~F.col("_last")).where(
        F.col("has_next") | ~F.col("_hot") if keep_last else F.col("has_next")).select(*out)
    wb = Window.partitionBy(group).orderBy(*order)
    boundary = (marked.where(F.col("_hot") & (F.col("_first") | F.col("_last")))
                .select(group, *keep, "_last"))
    across = (boundary.select(
        group, *keep, "_last",
        *[F.lead(c).over(wb).alias(f"next_{c}") for c in cols],
        F.lead(F.lit(1)).over(wb).isNotNull().alias("has_next"))
        .where(F.col("_last") if keep_last else F.col("_last") & F.col("has_next")).select(*out))
    both = inside.unionByName(across)
    return both if keep_last else both.drop("has_next")


def second_chunk(ts: str) -> Column:
    """Position in a group ordered by time, in seconds."""
    return F.unix_timestamp(ts)


def minute_chunk(ts: str) -> Column:
    return F.floor(F.unix_timestamp(ts) / 60)


def id_chunk(id_col: str, width: int = 1) -> Column:
    """Position in a group ordered by a long id."""
    return F.floor(F.col(id_col) / width)
