"""Session statistics: roll-up, enrichment, filtering, length histograms,
ratios and the stratified sample.

Shuffle budget of the roll-up: one scan of the actions, one shuffle keyed by
(session, kind, value) after map-side partial aggregation, one shuffle keyed
by session.  A session's row count never reaches a single buffer: the
ordered keyword / category lists are built from one row per distinct value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.functions.columns import (
    STEP_BUCKETS, VISIT_BUCKETS, first_seen_join, half_up_ratio, in_bucket, int_div, order_key)
from shopflow.operators.joins import DIMENSION_MAX_ROWS, first_per_key


def actions_in_range(actions: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """Inclusive date-range scan of the actions (string dates)."""
    return actions.where(F.col("date").between(start_date, end_date))


def session_rollup(actions: DataFrame) -> DataFrame:
    """Per session: user, first/last action time, visit length (s), step
    length (actions), distinct search keywords and clicked categories in
    first-seen order (time, then event id), comma-joined ('' if none)."""
    first = order_key("action_time", "event_id")
    kinds = F.array(
        F.struct(F.lit("b").alias("kind"), F.lit(None).cast("string").alias("v")),
        F.struct(F.lit("k").alias("kind"), F.col("search_keyword").alias("v")),
        F.struct(F.lit("c").alias("kind"),
                 F.when(F.col("click_category_id") != -1, F.col("click_category_id").cast("string"))
                 .alias("v")),
    )
    per_value = (
        actions.select("session_id", "user_id", "action_time", "event_id", F.inline(kinds))
        .where((F.col("kind") == "b") | F.col("v").isNotNull())
        .groupBy("session_id", "kind", "v")
        .agg(F.min("user_id").alias("user_id"),
             F.min(first).alias("first"),
             F.min("action_time").alias("start"),
             F.max("action_time").alias("last"),
             F.count(F.lit(1)).alias("n"))
    )
    is_base = F.col("kind") == "b"
    out = per_value.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min(F.when(is_base, F.col("start"))).alias("start_time"),
        F.max(F.when(is_base, F.col("last"))).alias("end_time"),
        F.sum(F.when(is_base, F.col("n"))).alias("step_length"),
        first_seen_join(F.col("kind") == "k", F.col("first"), F.col("v")).alias("search_keywords"),
        first_seen_join(F.col("kind") == "c", F.col("first"), F.col("v")).alias("click_category_ids"),
    )
    return out.select(
        "session_id", "user_id", "start_time", "end_time",
        (F.unix_timestamp("end_time") - F.unix_timestamp("start_time")).alias("visit_length"),
        "step_length", "search_keywords", "click_category_ids")


def session_full_info(rollup: DataFrame, users: DataFrame) -> DataFrame:
    """Roll-up joined with the user table; sessions of unknown users drop
    out (inner join).  Both sides grow with the data, so the planner (AQE)
    chooses the join strategy from runtime sizes."""
    u = users.select("user_id", "age", "professional", "sex", "city")
    return rollup.join(u, "user_id").select(
        "session_id", "user_id", "start_time", "end_time", "visit_length", "step_length",
        "search_keywords", "click_category_ids", "age", "professional", "sex", "city")


def _overlap(list_col: str, values: list[str]) -> Column:
    data = F.filter(F.split(F.col(list_col), ","), lambda x: (x != "") & (x != "-1"))
    return F.coalesce(F.arrays_overlap(data, F.array(*[F.lit(str(v)) for v in values])), F.lit(False))


def session_predicate(start_age: int | None = None, end_age: int | None = None,
                      professionals: list[str] | None = None, cities: list[str] | None = None,
                      sex: str | None = None, keywords: list[str] | None = None,
                      category_ids: list[int] | None = None) -> Column:
    """The composite session filter; an absent parameter does not restrict,
    absent data fails a present parameter."""
    conds: list[Column] = []
    if start_age is not None and end_age is not None:
        conds.append(F.coalesce(F.col("age").between(start_age, end_age), F.lit(False)))
    if professionals:
        conds.append(F.coalesce(F.col("professional").isin(professionals), F.lit(False)))
    if cities:
        conds.append(F.coalesce(F.col("city").isin(cities), F.lit(False)))
    if sex:
        conds.append(F.coalesce(F.col("sex") == sex, F.lit(False)))
    if keywords:
        conds.append(_overlap("search_keywords", keywords))
    if category_ids:
        conds.append(_overlap("click_category_ids", [str(c) for c in category_ids]))
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def session_filtered(full_info: DataFrame, **params) -> DataFrame:
    return full_info.where(session_predicate(**params))


def filtered_session_actions(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Actions of the selected sessions.  A semi-join: the session set grows
    with the data, so it is shuffled (AQE splits a skewed session's
    partition) rather than broadcast."""
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def _bucket_counts(sessions: DataFrame) -> DataFrame:
    vl, sl = F.col("visit_length"), F.col("step_length")
    aggs = [F.count(F.lit(1)).alias("session_count")]
    aggs += [F.count_if(in_bucket(vl, lo, hi)).alias(f"v_{name}") for name, lo, hi in VISIT_BUCKETS]
    aggs += [F.count_if(in_bucket(sl, lo, hi)).alias(f"s_{name}") for name, lo, hi in STEP_BUCKETS]
    return sessions.agg(*aggs)


def session_length_histogram(sessions: DataFrame) -> DataFrame:
    """Rows (kind, bucket, n) for the 9 visit-length and 6 step-length
    buckets, zero-filled; one global aggregate (partial per task)."""
    counts = _bucket_counts(sessions)
    pairs = [f"'visit', '{n}', v_{n}" for n, _, _ in VISIT_BUCKETS]
    pairs += [f"'step', '{n}', s_{n}" for n, _, _ in STEP_BUCKETS]
    expr = f"stack({len(pairs)}, {', '.join(pairs)}) as (kind, bucket, n)"
    return counts.selectExpr(expr)


def session_stat(sessions: DataFrame) -> DataFrame:
    """One row: session count and the 15 bucket ratios, HALF_UP to 2
    places; the denominator is 1 when there are no sessions."""
    counts = _bucket_counts(sessions)
    d = F.greatest(F.col("session_count"), F.lit(1))
    cols = [F.col("session_count")]
    cols += [half_up_ratio(F.col(f"v_{n}"), d).alias(f"visit_length_{n}_ratio") for n, _, _ in VISIT_BUCKETS]
    cols += [half_up_ratio(F.col(f"s_{n}"), d).alias(f"step_length_{n}_ratio") for n, _, _ in STEP_BUCKETS]
    return counts.select(*cols)


def _with_start_keys(sessions: DataFrame) -> DataFrame:
    return (sessions
            .withColumn("date", F.date_format("start_time", "yyyy-MM-dd"))
            .withColumn("hour", F.date_format("start_time", "HH")))


def session_hour_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per (date, hour) of their start."""
    return (_with_start_keys(sessions).groupBy("date", "hour")
            .agg(F.count(F.lit(1)).alias("session_count")))


def session_sample_quota(sessions: DataFrame, total: int = 100) -> DataFrame:
    """Proportional stratified quotas: ``per_day = total div days``; an hour
    gets ``n * per_day div day_n``, at most its own session count.

    The (date, hour) table has at most 24 rows per day; the day count is a
    scalar subquery, not a driver round-trip."""
    hours = session_hour_counts(sessions)
    n_days = hours.select(F.count_distinct("date")).scalar()
    per_day = int_div(F.lit(total).cast("bigint"), n_days.cast("bigint"))
    day_n = F.sum("session_count").over(Window.partitionBy("date"))
    return (hours
            .withColumn("day_session_count", day_n)
            .withColumn("quota", F.least(
                F.col("session_count"),
                int_div(F.col("session_count") * per_day, F.col("day_session_count"))))
            .select("date", "hour", "session_count", "day_session_count", "quota"))


def sample_order(session_id: Column, seed: int) -> Column:
    return F.md5(F.concat(session_id, F.lit(f"_{seed}")))


def session_sample(sessions: DataFrame, total: int = 100, seed: int = 42) -> DataFrame:
    """Stratified sample without replacement: in each (date, hour) the
    first ``quota`` sessions by a seeded hash.

    Every quota is at most ``total``, so ``rn <= total`` is added as a
    literal bound: only the top ``total`` rows per stratum of each task or
    salt pass on (``first_per_key``), so a hot hour is never ranked whole in
    one task.  The quota table has at
    most 24 rows per day, a proven bound, and is broadcast."""
    quota = session_sample_quota(sessions, total).select("date", "hour", "quota")
    keyed = _with_start_keys(sessions).withColumn("h", sample_order(F.col("session_id"), seed))
    w = Window.partitionBy("date", "hour").orderBy("h", "session_id")
    few = first_per_key(keyed, ["date", "hour"], ["h", "session_id"], total)
    ranked = few.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= total)
    return (ranked.join(F.broadcast(quota), ["date", "hour"])
            .where(F.col("rn") <= F.col("quota"))
            .select("session_id", "start_time", "search_keywords", "click_category_ids"))


def session_sample_detail(actions: DataFrame, sample: DataFrame, total: int = 100) -> DataFrame:
    """Actions of the sampled sessions (the reference's SessionDetail).  The
    sample holds at most ``total`` sessions: it is broadcast when that bound
    is below the dimension limit, else the semi-join shuffles."""
    ids = sample.select("session_id")
    if total <= DIMENSION_MAX_ROWS:
        ids = F.broadcast(ids)
    return actions.join(ids, "session_id", "left_semi").select(
        "user_id", "session_id", "page_id", "action_time", "search_keyword",
        "click_category_id", "click_product_id", "order_category_ids", "order_product_ids",
        "pay_category_ids", "pay_product_ids")
