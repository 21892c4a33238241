"""Ad-click statistics in batch form (the stream forms reuse them per
micro-batch).  Input: parsed clicks from ``sources.parse_ad_log``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.operators.joins import first_per_key

MINUTE_MS = 60_000

CLICK_COLS = ["ts_ms", "date", "hour", "minute", "minute_key", "province", "city", "userid", "adid"]


def ad_user_daily_clicks(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("date", "userid", "adid").agg(F.count(F.lit(1)).alias("click_count"))


def ad_blacklist(clicks: DataFrame, threshold: int = 100) -> DataFrame:
    """Users with more than ``threshold`` clicks on one ad in one day."""
    return (ad_user_daily_clicks(clicks).where(F.col("click_count") > threshold)
            .select("userid").distinct())


def ad_blocked_at(clicks: DataFrame, threshold: int = 100) -> DataFrame:
    """Per user, the time of the first click that takes some daily (user,
    ad) count over ``threshold``.  Only the first threshold+1 clicks of each
    (day, user, ad) are ranked (``first_per_key``), so a user with millions
    of clicks ships at most threshold + 1 rows per task and key, whatever the
    threshold."""
    keys = ["date", "userid", "adid"]
    w = Window.partitionBy(*keys).orderBy("ts_ms")
    nth = (first_per_key(clicks.select(*keys, "ts_ms"), keys, ["ts_ms"], threshold + 1)
           .withColumn("rn", F.row_number().over(w))
           .where(F.col("rn") <= threshold + 1)
           .where(F.col("rn") == threshold + 1))
    return nth.groupBy("userid").agg(F.min("ts_ms").alias("blocked_at"))


def ad_clicks_allowed(clicks: DataFrame, threshold: int = 100) -> DataFrame:
    """Event-exact blacklist policy: a user's clicks are kept up to and
    including the click that listed them; later clicks are dropped.

    The listed users are a left join away: adaptive execution broadcasts
    them when their measured size allows and else splits a hot user's
    partition; no job runs while the plan is built."""
    blocked = ad_blocked_at(clicks, threshold)
    return (clicks.join(blocked, "userid", "left")
            .where(F.col("blocked_at").isNull() | (F.col("ts_ms") <= F.col("blocked_at")))
            .drop("blocked_at"))


def ad_stat(clicks: DataFrame) -> DataFrame:
    """Running click total per (date, province, city, ad)."""
    return clicks.groupBy("date", "province", "city", "adid").agg(F.count(F.lit(1)).alias("click_count"))


def ad_province_top(stat: DataFrame, n: int = 3) -> DataFrame:
    """Top ``n`` ads per (date, province) from the city-level totals; ties
    by ad id.  Partial sums per task, then a per-task top-n before the
    ranking shuffle."""
    per_province = stat.groupBy("date", "province", "adid").agg(
        F.sum("click_count").cast("bigint").alias("click_count"))
    w = Window.partitionBy("date", "province").orderBy(F.desc("click_count"), F.asc("adid"))
    return (per_province.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
            .select("date", "province", "adid", "click_count"))


def ad_click_trend(clicks: DataFrame) -> DataFrame:
    """Clicks per (minute, ad), minute split into date / hour / minute."""
    return clicks.groupBy("date", "hour", "minute", "adid").agg(F.count(F.lit(1)).alias("click_count"))


def ad_recent_hour(clicks: DataFrame, minutes: int = 60) -> DataFrame:
    """Trend rows of the last ``minutes`` minutes before the newest click
    (minute start later than max(ts) - minutes).  The newest click time is a
    scalar subquery; the filter runs before the aggregation."""
    newest = clicks.select(F.max("ts_ms")).scalar()
    minute_start = F.col("ts_ms") - F.pmod(F.col("ts_ms"), F.lit(MINUTE_MS))
    return ad_click_trend(clicks.where(minute_start > newest - minutes * MINUTE_MS))


def ad_hourly_sliding(clicks: DataFrame, window_minutes: int = 60, slide_minutes: int = 1) -> DataFrame:
    """Clicks per ad in every ``window_minutes`` window sliding by
    ``slide_minutes`` (event time), windows without clicks left out.

    A sweep over window starts instead of a copy of each count per window: the
    clicks of a minute enter at the first window that holds it and leave after
    the last, so a (minute, ad) makes two events.  Running sums go by ad and
    day, with the sum of the earlier days carried in; an interval that crosses
    into another day gets an empty event there.  Only the result is expanded
    into a row per window."""
    step, span = slide_minutes, slide_minutes * -(-1440 // slide_minutes)  # a day, rounded up to whole steps
    per_minute = (clicks.groupBy("adid", F.floor(F.col("ts_ms") / MINUTE_MS).cast("bigint").alias("m"))
                  .agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("first", (F.ceil((F.col("m") - window_minutes + 1) / step) * step).cast("bigint"))
                  .withColumn("after", ((F.floor(F.col("m") / step) + 1) * step).cast("bigint"))
                  .where(F.col("first") < F.col("after")))
    day_of = lambda c: F.floor(c / span).cast("bigint")
    crossed = F.when(day_of(F.col("after")) > day_of(F.col("first")),
                     F.transform(F.sequence(day_of(F.col("first")) + 1, day_of(F.col("after"))),
                                 lambda d: F.struct((d * span).alias("s"), F.lit(0).cast("bigint").alias("d"))))
    events = F.concat(F.array(F.struct(F.col("first").alias("s"), F.col("n").alias("d")),
                              F.struct(F.col("after").alias("s"), (-F.col("n")).alias("d"))),
                      F.coalesce(crossed, F.array().cast("array<struct<s: bigint, d: bigint>>")))
    swept = (per_minute.select("adid", F.inline(events)).groupBy("adid", day_of(F.col("s")).alias("day"), "s")
             .agg(F.sum("d").alias("d")))
    days = Window.partitionBy("adid").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = (swept.groupBy("adid", "day").agg(F.sum("d").alias("d"))
               .select("adid", "day", F.coalesce(F.sum("d").over(days), F.lit(0)).alias("carried")))
    inside = Window.partitionBy("adid", "day").orderBy("s")
    totals = (swept.withColumn("total", F.sum("d").over(inside))
              .withColumn("until", F.coalesce(F.lead("s").over(inside), (F.col("day") + 1) * span))
              .join(carried, ["adid", "day"])
              .select("adid", "s", "until", (F.col("total") + F.col("carried")).cast("bigint").alias("click_count"))
              .where("click_count > 0"))
    text = lambda minute: F.timestamp_seconds(minute * 60).cast("string")
    return (totals.select("adid", "click_count", F.explode(F.sequence("s", F.col("until") - step, F.lit(step).cast("bigint"))).alias("s"))
            .select(text(F.col("s")).alias("window_start"), text(F.col("s") + window_minutes).alias("window_end"), "adid", "click_count"))
