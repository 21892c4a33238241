"""Category funnel: categories touched by click / order / pay, their counts,
the top categories and the most active sessions per top category."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.functions.columns import id_list


def _empty():
    return F.array().cast("array<bigint>")


def category_events(actions: DataFrame) -> DataFrame:
    """One row per (action, category, kind): the clicked category, and every
    id of the order and pay lists.  One pass over the actions (no union of
    three scans); an action contributes to every kind it carries."""
    click = F.when(F.col("click_category_id") != -1, F.array("click_category_id")).otherwise(_empty())
    items = F.concat(
        F.transform(click, lambda c: F.struct(F.lit("click").alias("kind"), c.alias("category_id"))),
        F.transform(F.coalesce(id_list(F.col("order_category_ids")), _empty()),
                    lambda c: F.struct(F.lit("order").alias("kind"), c.alias("category_id"))),
        F.transform(F.coalesce(id_list(F.col("pay_category_ids")), _empty()),
                    lambda c: F.struct(F.lit("pay").alias("kind"), c.alias("category_id"))),
    )
    return actions.select("session_id", F.inline(items))


def category_touched(actions: DataFrame) -> DataFrame:
    return category_events(actions).select("category_id").distinct()


def _kind_counts(actions: DataFrame, kind: str, name: str) -> DataFrame:
    """Reads the one column of the kind: filtered and projected before its
    list is opened."""
    if kind == "click":
        ids = actions.where(F.col("click_category_id") != -1).select(F.col("click_category_id").alias("category_id"))
    else:
        column = f"{kind}_category_ids"
        ids = actions.where(F.col(column).isNotNull()).select(F.explode(id_list(F.col(column))).alias("category_id"))
    return ids.groupBy("category_id").agg(F.count(F.lit(1)).alias(name))


def category_click_counts(actions: DataFrame) -> DataFrame:
    return _kind_counts(actions, "click", "click_count")


def category_order_counts(actions: DataFrame) -> DataFrame:
    return _kind_counts(actions, "order", "order_count")


def category_pay_counts(actions: DataFrame) -> DataFrame:
    return _kind_counts(actions, "pay", "pay_count")


def category_full_counts(actions: DataFrame) -> DataFrame:
    """Touched categories with click, order and pay counts, zero-filled.
    One conditional aggregate replaces the three outer joins; partial
    aggregation per task keeps hot categories cheap to shuffle."""
    kind = F.col("kind")
    return category_events(actions).groupBy("category_id").agg(
        F.count_if(kind == "click").alias("click_count"),
        F.count_if(kind == "order").alias("order_count"),
        F.count_if(kind == "pay").alias("pay_count"))


def category_top(full_counts: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` by (click, order, pay) descending, id ascending on ties:
    a per-task top-n before one small merge (TakeOrderedAndProject)."""
    return full_counts.orderBy(F.desc("click_count"), F.desc("order_count"),
                               F.desc("pay_count"), F.asc("category_id")).limit(n)


def session_category_clicks(actions: DataFrame, top: DataFrame) -> DataFrame:
    """Clicks per (category, session) for the top categories.  ``top`` has
    at most n rows (a limit), so the semi-join broadcasts it."""
    clicks = actions.where(F.col("click_category_id") != -1).select(
        F.col("click_category_id").alias("category_id"), "session_id")
    return (clicks.join(F.broadcast(top.select("category_id")), "category_id", "left_semi")
            .groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count")))


def category_top_sessions(session_clicks: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most active sessions per category (count desc, session id
    asc).  ``row_number <= n`` lets the optimizer cut each category to n
    rows inside every task before the shuffle (window group limit)."""
    w = Window.partitionBy("category_id").orderBy(F.desc("click_count"), F.asc("session_id"))
    return (session_clicks.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
            .select("category_id", "session_id", "click_count"))
