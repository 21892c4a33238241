"""Jobs built from the reference's per-row date and string utilities, which
it defines but barely calls.  Each utility is a column expression here,
applied over the whole action or session table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.functions.columns import STEP_BUCKETS, in_bucket, pad2, trim_edge_commas
from shopflow.operators.sequence import consecutive_pairs, id_chunk

# --- Fixed values: field names of the packed session record ----------------
PACKED_FIELDS = [
    ("sessionid", "session_id"),
    ("searchKeywords", "search_keywords"),
    ("clickCategoryIds", "click_category_ids"),
    ("visitLength", "visit_length"),
    ("stepLength", "step_length"),
    ("startTime", "start_time"),
    ("age", "age"),
    ("professional", "professional"),
    ("sex", "sex"),
    ("city", "city"),
]
# ---------------------------------------------------------------------------

ACTION_KINDS = ["search", "click", "order", "pay", "view"]


def action_kind():
    return (F.when(F.col("search_keyword").isNotNull(), "search")
            .when(F.col("click_category_id") != -1, "click")
            .when(F.col("order_category_ids").isNotNull(), "order")
            .when(F.col("pay_category_ids").isNotNull(), "pay")
            .otherwise("view"))


def session_time_gaps(actions: DataFrame, chunk_width: int = 1 << 22) -> DataFrame:
    """Consecutive actions of a session in event-id order: seconds between
    them and whether the next one is later (before/after tests).  Per
    session with at least two actions: pairs, largest gap, steps forward and
    steps back in time."""
    t = F.col("action_time")
    pairs = (consecutive_pairs(actions, "session_id", ["event_id"],
                               id_chunk("event_id", chunk_width), ["action_time"])
             .select("session_id",
                     (F.unix_timestamp("next_action_time") - F.unix_timestamp(t)).alias("gap"),
                     (t < F.col("next_action_time")).alias("before"),
                     (t > F.col("next_action_time")).alias("after")))
    return pairs.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("pair_count"),
        F.max("gap").alias("max_gap"),
        F.count_if("before").alias("forward_steps"),
        F.count_if("after").alias("back_steps"))


def daily_activity(actions: DataFrame, as_of: str | None = None) -> DataFrame:
    """Actions per kind on ``as_of`` (today when None) and the day before,
    with yyyyMMdd day keys, the previous day parsed back from its key, and
    the difference; one conditional aggregate, zero-filled."""
    day = F.current_date() if as_of is None else F.to_date(F.lit(as_of))
    prev = F.date_sub(day, 1)
    d = F.to_date(F.col("date"))
    counts = (actions.where(d.between(prev, day))
              .groupBy(action_kind().alias("kind"))
              .agg(F.count_if(d == day).alias("day_count"),
                   F.count_if(d == prev).alias("prev_day_count")))
    kinds = actions.sparkSession.createDataFrame([(k,) for k in ACTION_KINDS], "kind string")
    prev_key = F.date_format(prev, "yyyyMMdd")
    return (kinds.join(counts, "kind", "left")
            .select("kind", F.date_format(day, "yyyyMMdd").alias("day_key"), prev_key.alias("prev_day_key"),
                    F.date_format(F.to_date(prev_key, "yyyyMMdd"), "yyyy-MM-dd").alias("prev_day"),
                    F.coalesce("day_count", F.lit(0)).alias("day_count"),
                    F.coalesce("prev_day_count", F.lit(0)).alias("prev_day_count"))
            .withColumn("diff", F.col("day_count") - F.col("prev_day_count")))


LIST_COLS = ["order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids"]


def clean_id_lists(actions: DataFrame) -> DataFrame:
    """Per action carrying an order or pay list: each list with its edge
    commas stripped, empty ids dropped, ids padded to two digits, distinct
    and sorted; plus how many raw items were removed in all."""
    out = [F.col("event_id")]
    removed = F.lit(0)
    for c in LIST_COLS:
        items = F.split(trim_edge_commas(F.col(c)), ",")
        clean = F.array_sort(F.array_distinct(F.transform(F.filter(items, lambda x: x != ""), pad2)))
        out.append(F.array_join(clean, ",").alias(c))
        removed = removed + F.coalesce(F.size(items) - F.size(clean), F.lit(0))
    has_list = F.col("order_category_ids").isNotNull() | F.col("pay_category_ids").isNotNull()
    return actions.where(has_list).select(*out, removed.cast("bigint").alias("removed_ids"))


# A value's own separators, and the sign that marks them, are percent-encoded.
ESCAPES = [("%", "%25"), ("|", "%7C"), ("=", "%3D")]


def escaped(value: Column) -> Column:
    for sign, code in ESCAPES:
        value = F.replace(value, F.lit(sign), F.lit(code))
    return value


def unescaped(value: Column) -> Column:
    for sign, code in reversed(ESCAPES):
        value = F.replace(value, F.lit(code), F.lit(sign))
    return value


def pack_session(sessions: DataFrame) -> DataFrame:
    """Session info packed as ``key=value|key=value`` (the reference's
    intermediate record), separators inside a value escaped."""
    parts = [F.concat(F.lit(f"{k}="), escaped(F.coalesce(F.col(c).cast("string"), F.lit("")))) for k, c in PACKED_FIELDS]
    return sessions.select("session_id", F.concat_ws("|", *parts).alias("packed"))


def packed_sessions(sessions: DataFrame, field: str = "stepLength") -> DataFrame:
    """Pack, unpack to typed columns (``str_to_map``), replace one field
    (``field`` gets the step bucket label) and re-pack in key order."""
    packed = pack_session(sessions).select("packed")
    m = F.str_to_map(F.col("packed"), F.lit(r"\|"), F.lit("="))
    steps = m["stepLength"].cast("bigint")
    label = None
    for name, lo, hi in STEP_BUCKETS:
        cond = in_bucket(steps, lo, hi)
        label = F.when(cond, name) if label is None else label.when(cond, name)
    label = label.otherwise("0")
    replaced = F.transform_values(m, lambda k, v: F.when(k == field, label).otherwise(v))
    repacked = F.array_join(F.transform(F.array_sort(F.map_entries(replaced)),
                                        lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    return packed.select(
        unescaped(m["sessionid"]).alias("session_id"),
        m["visitLength"].cast("bigint").alias("visit_length"),
        steps.alias("step_length"),
        m["age"].cast("int").alias("age"),
        "packed", repacked.alias("repacked"))
