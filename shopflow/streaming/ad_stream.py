"""The ad-click stream: running counts, top ads per province, per-minute
trend, sliding hourly totals and the click-fraud blacklist.

Every query reads log lines from a streaming source (text files here, Kafka
by option), parses them once, counts them in Spark's checkpointed state
(``streaming.state``; the unfiltered trend is a plain windowed aggregation) and
writes what changed through ``foreachBatch`` into Parquet tables by day
(``streaming.tables``).  Operators give absolute totals, so a batch that is
tried again changes nothing.  No click is lost for being late, unless a
``lateness`` is given.  Lines that do not parse go to a reject table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopflow.operators import ads as D
from shopflow.sources.adlog import parse_ad_log, read_ad_log_stream, rejected_lines
from shopflow.streaming.state import OUT, OUT_SCHEMA, SLOTS, ClickFilter, RunningTotals, SlidingTotals, combine, slot
from shopflow.streaming.tables import merge_days, put_batch, read_table

#: Result tables under ``out`` and the keys that a new row replaces.
TABLES = {
    "ad_stat": ("date string, province string, city string, adid bigint, click_count bigint", ["date", "province", "city", "adid"]),
    "province_top": ("date string, province string, adid bigint, click_count bigint", ["date", "province"]),
    "click_trend": ("date string, hour string, minute string, adid bigint, click_count bigint", ["date", "hour", "minute", "adid"]),
    "hourly_sliding": ("date string, window_start string, window_end string, adid bigint, click_count bigint",
                       ["date", "window_start", "adid"]),
    "blacklist": ("userid bigint, batch_id bigint", None),
    "rejects": ("value string, reason string, batch_id bigint", None),
}

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_TRIGGER = {"processingTime": "5 seconds"}


def result(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The stored rows of a result table."""
    return read_table(spark, f"{out}/{name}", TABLES[name][0]).drop("batch_id")


def _merge(rows: DataFrame, out: str, name: str) -> None:
    merge_days(rows, f"{out}/{name}", *TABLES[name])


def _start(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, mode: str,
           trigger: dict | None, state_partitions: int | None = None) -> StreamingQuery:
    """Start a ``foreachBatch`` query with its state in RocksDB.
    ``state_partitions`` sizes the state store; it is fixed in the checkpoint
    at the first start (later restarts keep it).  Both settings are made only
    while the query starts: it takes a snapshot of the session's then."""
    spark = df.sparkSession
    wanted = {"spark.sql.streaming.stateStore.providerClass": _ROCKSDB}
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        return (df.writeStream.outputMode(mode).foreachBatch(fn)
                .option("checkpointLocation", checkpoint).trigger(**(trigger or _TRIGGER)).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _write(out: str) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of rows in OUT_SCHEMA: each kind to its
    table."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # used once per kind
        kind = lambda k: batch.where(F.col("kind") == k)
        try:
            ad, two = F.col("item").alias("adid"), lambda c: F.lpad(F.floor(c).cast("string"), 2, "0")
            _merge(kind("stat").select("date", F.col("g").alias("province"), F.col("a").alias("city"), ad, "click_count"), out, "ad_stat")
            _merge(kind("top").select("date", F.col("g").alias("province"), ad, "click_count"), out, "province_top")
            _merge(kind("trend").select("date", two(F.col("item") / 60).alias("hour"), two(F.col("item") % 60).alias("minute"),
                                        F.col("g").cast("bigint").alias("adid"), "click_count"), out, "click_trend")
            put_batch(kind("black").select(F.col("g").cast("bigint").alias("userid")), f"{out}/blacklist", batch_id)
            put_batch(kind("reject").select(F.col("a").alias("value"), F.col("g").alias("reason")), f"{out}/rejects", batch_id)
        finally:
            batch.unpersist()

    return sink


def _rejects(lines: DataFrame) -> DataFrame:
    """The lines that do not parse, as rows of OUT_SCHEMA."""
    return rejected_lines(lines).select(F.lit("reject").alias("kind"), F.lit("").alias("date"), F.col("reason").alias("g"),
                                        F.col("value").alias("a"), F.lit(None).cast("bigint").alias("item"),
                                        F.lit(None).cast("bigint").alias("click_count"))


def _totals(rows: DataFrame, top_n: int, slots: int, lateness: str | None = None) -> DataFrame:
    rows = rows.select(slot(slots, "kind", "date", "g"), *OUT, *(["ts"] if lateness else []))
    return rows.groupBy("slot").transformWithStateInPandas(
        RunningTotals(top_n, expire=bool(lateness)), OUT_SCHEMA, "append", "eventTime" if lateness else "none")


def _by_user(lines: DataFrame, threshold: int, only_list: bool, ttl_ms: int | None, slots: int) -> DataFrame:
    clicks = parse_ad_log(lines)
    keys = ["userid", "date", "adid"]
    if not only_list:
        clicks = clicks.withColumn("minute", F.hour("ts") * 60 + F.minute("ts"))
        keys += ["province", "city", "minute"]
    return combine(clicks, keys).select(slot(slots, "userid"), "*").groupBy("slot").transformWithStateInPandas(
        ClickFilter(threshold, only_list, ttl_ms), OUT_SCHEMA, "append", "processingTime" if ttl_ms else "none")


def ad_stat_stream(spark: SparkSession, lines: DataFrame, out: str, checkpoint: str, top_n: int = 3,
                   lateness: str | None = None, trigger: dict | None = None,
                   state_partitions: int | None = None, slots: int = SLOTS) -> StreamingQuery:
    """Running click totals per (day, province, city, ad) into ``out/ad_stat``
    and the ``top_n`` ads of every (day, province) into ``out/province_top``,
    both from one stateful operator whose groups are (day, province): the totals that
    a batch changed, and a group's top when it changed.  Without ``lateness``
    the state never expires and every click counts, however late; with it, the
    groups of days that ended longer ago are dropped and so are later clicks."""
    keys = ["date", "province", "city", "adid"]
    clicks = parse_ad_log(lines)
    if lateness:
        clicks, keys = clicks.withColumn("ts", F.date_trunc("minute", "ts")), [*keys, "ts"]
    counts = combine(clicks, keys, "click_count")
    if lateness:
        counts = counts.withWatermark("ts", lateness)
    rows = counts.withColumnsRenamed({"province": "g", "city": "a", "adid": "item"}).withColumn("kind", F.lit("stat"))
    return _start(_totals(rows, top_n, slots, lateness).unionByName(_rejects(lines)), _write(out), checkpoint, "append", trigger, state_partitions)


def click_trend_stream(spark: SparkSession, lines: DataFrame, out: str, checkpoint: str,
                       lateness: str | None = None, trigger: dict | None = None,
                       state_partitions: int | None = None) -> StreamingQuery:
    """Clicks per (minute, ad) in event time, a windowed aggregation in update
    mode; updated minutes overwrite their row in ``out/click_trend``.
    ``lateness`` as in ``ad_stat_stream``.  Start ``reject_stream`` beside it
    to keep the lines that do not parse."""
    clicks = parse_ad_log(lines)
    clicks = clicks.withWatermark("ts", lateness) if lateness else clicks
    counts = (clicks.groupBy(F.window("ts", "1 minute").alias("m"), "adid")
              .agg(F.count(F.lit(1)).alias("click_count"))
              .select(F.date_format("m.start", "yyyyMMdd").alias("date"),
                      F.date_format("m.start", "HH").alias("hour"),
                      F.date_format("m.start", "mm").alias("minute"), "adid", "click_count"))
    return _start(counts, _merge_sink(out, "click_trend"), checkpoint, "update", trigger, state_partitions)


def _merge_sink(out: str, name: str) -> Callable[[DataFrame, int], None]:
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            _merge(batch, out, name)
        finally:
            batch.unpersist()

    return sink


def hourly_sliding_stream(spark: SparkSession, lines: DataFrame, out: str, checkpoint: str,
                          window_minutes: int = 60, slide_minutes: int = 1, trigger: dict | None = None,
                          state_partitions: int | None = None, ttl_ms: int | None = None) -> StreamingQuery:
    """Clicks per ad in sliding event-time windows, into ``out/hourly_sliding``
    (by day): after every batch the table holds the totals of all windows met
    so far, open ones and late clicks included.  The state holds one number
    per (minute, ad); ``ttl_ms`` drops hours that long unchanged."""
    minute = F.floor(F.col("ts_ms") / D.MINUTE_MS).cast("bigint")
    counts = combine(parse_ad_log(lines).withColumn("minute", minute), ["adid", "minute"])
    found = counts.groupBy("adid").transformWithStateInPandas(
        SlidingTotals(window_minutes, slide_minutes, ttl_ms), "start bigint, adid bigint, click_count bigint", "append",
        "processingTime" if ttl_ms else "none")
    at = F.timestamp_seconds(F.col("start") * 60)
    until = F.timestamp_seconds((F.col("start") + window_minutes) * 60)
    rows = found.select(F.date_format(at, "yyyyMMdd").alias("date"), F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                        F.date_format(until, "yyyy-MM-dd HH:mm:ss").alias("window_end"), "adid", "click_count")
    return _start(rows, _merge_sink(out, "hourly_sliding"), checkpoint, "append", trigger, state_partitions)


def reject_stream(spark: SparkSession, lines: DataFrame, out: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Lines that do not parse, into ``out/rejects``."""
    return _start(rejected_lines(lines), lambda b, i: put_batch(b, f"{out}/rejects", i), checkpoint, "append", trigger)


def blacklist_stream(spark: SparkSession, lines: DataFrame, out: str, checkpoint: str,
                     threshold: int = 100, trigger: dict | None = None, state_partitions: int | None = None,
                     ttl_ms: int | None = None, slots: int = SLOTS) -> StreamingQuery:
    """The feedback loop in one stateful operator keyed by user: clicks of
    listed users are dropped, the others are counted per (day, ad), and a user
    over ``threshold`` is listed from the next batch on and written to
    ``out/blacklist``.  ``ttl_ms`` drops daily counts that long unchanged."""
    rows = _by_user(lines, threshold, True, ttl_ms, slots).unionByName(_rejects(lines))
    return _start(rows, _write(out), checkpoint, "append", trigger, state_partitions)


def filtered_ad_stream(spark: SparkSession, lines: DataFrame, out: str, checkpoint: str,
                       threshold: int = 100, top_n: int = 3, trigger: dict | None = None,
                       state_partitions: int | None = None, ttl_ms: int | None = None,
                       slots: int = SLOTS) -> StreamingQuery:
    """All statistics of the reference's stream over blacklist-filtered
    clicks, in one pass per micro-batch: the operator of ``blacklist_stream``
    lets the clicks through that no earlier batch's list stops, and a second
    one, by (day, province) and by (day, ad), keeps the running totals
    per (day, province, city, ad), the per-minute trend and each (day,
    province)'s ``top_n`` ads.  Nothing is read back from the five tables
    (``ad_stat``, ``province_top``, ``click_trend``, ``blacklist``, ``rejects``)
    but the days that a batch rewrites."""
    rows = _totals(_by_user(lines, threshold, False, ttl_ms, slots), top_n, slots).unionByName(_rejects(lines))
    return _start(rows, _write(out), checkpoint, "append", trigger, state_partitions)


# --- replay of a log table as an ordered sequence of arrivals ----------------

def replay_feed(spark: SparkSession, log: DataFrame, src: str, batches: int,
                on_arrival: Callable[[int], None]) -> None:
    """Append ``log`` (event_id, value) to the text directory ``src`` in
    ``batches`` event-id ranges, calling ``on_arrival(i)`` after each (tests
    restart the stream from its checkpoint there).  Each range is written by
    all tasks in parallel; the event-id filter is pushed into the scan."""
    bounds = log.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    step = (hi - lo) // batches + 1
    for i in range(batches):
        a, b = lo + i * step, lo + (i + 1) * step
        (log.where((F.col("event_id") >= a) & (F.col("event_id") < b)).select("value")
         .write.mode("append").text(src))
        on_arrival(i)


def run_available(start: Callable[[], StreamingQuery]) -> None:
    q = start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def read_lines(spark: SparkSession, src: str) -> DataFrame:
    return read_ad_log_stream(spark, src, "text")
