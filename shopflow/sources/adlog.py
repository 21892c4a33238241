"""Parsing of the ad-click log and the streaming readers for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.session import use_utc


def _split(lines: DataFrame, value_col: str) -> DataFrame:
    """(value, parts): every line split once.  The one-row explode keeps the
    optimizer from copying the split into each use of its parts."""
    value = F.col(value_col).cast("string")
    return lines.select(value.alias("value"), F.explode(F.array(F.split(value, " "))).alias("parts"))


def _number(i: int) -> Column:
    """Field ``i`` as a number, null where the text is none."""
    return F.get("parts", F.lit(i)).try_cast("bigint")


def _reason() -> Column:
    """Why a split line is no click; null for a click."""
    return (F.when(F.col("value").isNull(), "null line")
            .when(F.size("parts") != 5, "not five fields")
            .when(_number(0).isNull(), "bad time")
            .when(_number(3).isNull() | _number(4).isNull(), "bad user or ad"))


def rejected_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """(value, reason) of the lines that ``parse_ad_log`` leaves out."""
    return _split(lines, value_col).select("value", _reason().alias("reason")).where(F.col("reason").isNotNull())


def parse_ad_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``ts_ms province city userid adid`` → typed columns, parsed once.

    A click has exactly five fields and numbers where numbers belong; other
    lines are left to ``rejected_lines``.  Adds the timestamp and the keys
    the statistics group by: ``date`` (yyyyMMdd), ``hour``, ``minute`` and
    ``minute_key`` (yyyyMMddHHmm).
    """
    parsed = _split(lines, value_col).where(_reason().isNull()).select(
        _number(0).alias("ts_ms"), F.get("parts", F.lit(1)).alias("province"), F.get("parts", F.lit(2)).alias("city"),
        _number(3).alias("userid"), _number(4).alias("adid"))
    ts = F.timestamp_millis("ts_ms")
    return parsed.select(
        "ts_ms", ts.alias("ts"),
        F.date_format(ts, "yyyyMMdd").alias("date"),
        F.date_format(ts, "HH").alias("hour"),
        F.date_format(ts, "mm").alias("minute"),
        F.date_format(ts, "yyyyMMddHHmm").alias("minute_key"),
        "province", "city", "userid", "adid",
    )


def read_ad_log_stream(spark: SparkSession, path: str, fmt: str = "text",
                       **options: str) -> DataFrame:
    """Streaming source of log lines.

    ``fmt="text"`` reads a directory of log files (tests, replays);
    ``fmt="kafka"`` takes the usual ``kafka.bootstrap.servers`` /
    ``subscribe`` options (the connector jar must be on the classpath).
    """
    use_utc(spark)  # day / minute keys of the stream are UTC, as in the batch forms
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        # The reference's consumer starts at the newest offsets; offsets are
        # tracked in the query checkpoint, never auto-committed.
        options = {"startingOffsets": "latest", **options}
    for k, v in options.items():
        reader = reader.option(k, v)
    if fmt == "kafka":
        return reader.load().select(F.col("value").cast("string").alias("value"))
    return reader.load(path)
