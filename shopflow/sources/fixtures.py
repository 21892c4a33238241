"""The reference's input tables, derived from the driver's tables.

The reference reads three Hive tables (actions, users, products), a literal
city dimension and a space-separated ad-click log.  Here each is a DataFrame
view over the driver's parquet (see FIXTURES.md §3); DuckDB builds the same
views in ``shopflow.plans.oracle``.  Every view is lazy, so filters and
projections of the jobs reach the parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.sources.tables import read_table


def events(spark: SparkSession, sf_dir: str, start_date: str | None = None,
           end_date: str | None = None) -> DataFrame:
    """``events`` with an optional inclusive day range applied to the raw
    ``ts`` column, so the parquet reader prunes row groups (PushedFilters)."""
    ev = read_table(spark, sf_dir, "events")
    if start_date is not None:
        ev = ev.where(F.col("ts") >= F.lit(start_date).cast("timestamp_ntz"))
    if end_date is not None:
        after = (dt.date.fromisoformat(end_date) + dt.timedelta(days=1)).isoformat()
        ev = ev.where(F.col("ts") < F.lit(after).cast("timestamp_ntz"))
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def user_visit_action(spark: SparkSession, sf_dir: str, start_date: str | None = None,
                      end_date: str | None = None) -> DataFrame:
    """One row per page action; a session is one user's day.

    Columns follow the reference's action record, plus ``event_id`` as the
    tie-break for actions with equal time.  ``action_time`` is a timestamp
    (rendered as text only at the outputs).
    """
    ev = events(spark, sf_dir, start_date, end_date)
    day = F.date_format("ts", "yyyy-MM-dd")
    off = (F.when(F.col("event_id") % 4 == 0, (F.col("event_id") * 37) % 10)
            .when(F.col("event_id") % 4 == 1, (F.col("event_id") * 37) % 60)
            .when(F.col("event_id") % 4 == 2, (F.col("event_id") * 37) % 600)
            .otherwise((F.col("event_id") * 37) % 3600))
    et = F.col("event_type")
    k = F.col("k")
    return (
        ev.select("event_id", "ts", "user_id", "event_type", _k().alias("k"), off.alias("off"))
        .select(
            day.alias("date"),
            F.col("user_id"),
            F.concat(F.col("user_id").cast("string"), F.lit("_"), day).alias("session_id"),
            F.col("event_id"),
            (k % 10).alias("page_id"),
            F.expr("timestampadd(SECOND, off, timestampadd(HOUR, user_id % 23, date_trunc('DAY', ts)))")
            .alias("action_time"),
            F.when(et == "view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
            F.when(et == "click", k).otherwise(F.lit(-1).cast("bigint")).alias("click_category_id"),
            F.when(et == "click", F.col("event_id") % 100).otherwise(F.lit(-1).cast("bigint"))
            .alias("click_product_id"),
            F.when(et == "signup", F.concat(k.cast("string"), F.lit(","), ((k + 1) % 100).cast("string")))
            .alias("order_category_ids"),
            F.when(et == "signup", (F.col("event_id") % 100).cast("string")).alias("order_product_ids"),
            F.when(et == "purchase", k.cast("string")).alias("pay_category_ids"),
            F.when(et == "purchase", (F.col("event_id") % 100).cast("string")).alias("pay_product_ids"),
            (F.col("user_id") % 25).alias("city_id"),
        )
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("username"),
            F.col("c_name").alias("name"),
            (F.lit(18) + F.col("c_custkey") % 42).cast("int").alias("age"),
            F.col("c_mktsegment").alias("professional"),
            F.col("n_name").alias("city"),
            F.when(F.col("c_custkey") % 2 == 0, "male").otherwise("female").alias("sex"),
        )
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (F.col("p_partkey") % 2).cast("string"), F.lit("}"))
        .alias("extend_info"),
    )


def city_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def ad_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-click log lines ``epoch_millis province city userid adid`` (the
    stream's message value), with ``event_id`` kept for ordering the feed."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")
    # nation/region are dimension tables of fixed, tiny size (25 / 5 rows).
    joined = ev.join(F.broadcast(geo), (ev.user_id % 25) == geo.n_nationkey)
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    value = F.concat_ws(
        " ", ms.cast("string"), F.regexp_replace("r_name", " ", "-"), F.col("n_name"),
        F.col("user_id").cast("string"), (_k() % 20).cast("string"))
    return joined.select("event_id", value.alias("value"))


def ad_log_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with five kinds of broken lines, chosen by event id."""
    part = F.split("value", " ")
    kind = F.col("event_id") % 40

    def line(*fields):
        return F.concat_ws(" ", *[F.lit(f) if isinstance(f, str) else part.getItem(f) for f in fields])

    value = (F.when(kind == 0, line(0, 1, 2, 3)).when(kind == 1, line(0, 1, 2, "x", 3, 4))
             .when(kind == 2, line("oops", 1, 2, 3, 4)).when(kind == 3, line(0, 1, 2, "abc", 4))
             .when(kind == 4, F.lit("")).otherwise(F.col("value")))
    return ad_log(spark, sf_dir).select("event_id", value.alias("value"))
