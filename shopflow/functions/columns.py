"""Column expressions shared by the jobs.  All are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

# --- Fixed values: session length buckets (must equal the reference) -------
# Visit length in seconds, (label, lower, upper) with both bounds inclusive;
# 0 s falls in no bucket, the last bucket is open-ended.
VISIT_BUCKETS = [
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
]
# Step length (actions per session), same convention.
STEP_BUCKETS = [
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
]
# ---------------------------------------------------------------------------


def in_bucket(c: Column, lo: int, hi: int | None) -> Column:
    return (c >= lo) if hi is None else c.between(lo, hi)


def int_div(a: Column, b: Column) -> Column:
    """Exact integer division of non-negative longs (SQL ``a div b``).  The
    exact multiple is divided as a decimal: a double would lose integers
    above 2^53 (e.g. 2 * 10^4 * a click count of 10^12)."""
    multiple = (a - F.pmod(a, b)).cast("decimal(38,0)")
    return (multiple / b.cast("decimal(38,0)")).cast("bigint")


def half_up_ratio(n: Column, d: Column, places: int = 2) -> Column:
    """``round(n / d, places)`` with HALF_UP, computed from integers so that
    every engine agrees on ties (n >= 0, d > 0)."""
    scale = 10 ** places
    q = int_div(F.lit(2 * scale) * n + d, F.lit(2) * d)
    return q.cast("double") / scale


def half_up_text(n: Column, d: Column, places: int = 4) -> Column:
    """``n / d`` rendered with ``places`` decimals, HALF_UP, from integers."""
    scale = 10 ** places
    q = int_div(F.lit(2 * scale) * n + d, F.lit(2) * d)
    return F.concat(int_div(q, F.lit(scale)).cast("string"), F.lit("."),
                    F.lpad(F.pmod(q, F.lit(scale)).cast("string"), places, "0"))


def order_key(ts: str, tie: str) -> Column:
    """One exact, hash-aggregatable ordering key for (timestamp, long id):
    ``micros * 10^20 + (id + 2^63)`` as decimal(38,0).  It orders exactly
    like the pair for any long id and any timestamp before year 4000, and a
    ``min`` over it stays a hash aggregate (a struct min forces a sort)."""
    micros = F.unix_micros(F.col(ts)).cast("decimal(38,0)")
    shifted = F.col(tie).cast("decimal(38,0)") + F.lit(str(2 ** 63)).cast("decimal(38,0)")
    return micros * F.lit(str(10 ** 20)).cast("decimal(38,0)") + shifted


def first_seen_join(cond: Column, order_key: Column, value: Column, sep: str = ",") -> Column:
    """Aggregate: values (already distinct per group) joined in the order of
    their first occurrence.  ``collect_list`` skips rows where ``cond`` is
    false; the input is one row per distinct value, so the list is bounded by
    the number of distinct values, not by the group's row count."""
    items = F.collect_list(F.when(cond, F.struct(order_key.alias("o"), value.alias("v"))))
    return F.array_join(F.transform(F.array_sort(items), lambda x: x["v"]), sep)


def concat_distinct(c: Column, sep: str = ",") -> Column:
    """Aggregate: sorted distinct values joined by ``sep`` (the reference's
    group_concat_distinct, with its intended semantics)."""
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def id_list(c: Column) -> Column:
    """Comma-separated id list → array<bigint>, empty items dropped."""
    return F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("bigint"))


def trim_edge_commas(c: Column) -> Column:
    """Strip one leading and one trailing comma, keep the rest."""
    return F.regexp_replace(c, "^,|,$", "")


def pad2(c: Column) -> Column:
    """Left-pad to two characters; longer input is kept whole."""
    return F.when(F.length(c) >= 2, c).otherwise(F.lpad(c, 2, "0"))


def render_times(df: DataFrame, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Render timestamp columns as text at the output boundary."""
    return df.select(*[
        F.date_format(f.name, fmt).alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema.fields])
