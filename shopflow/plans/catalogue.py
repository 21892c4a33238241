"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per
computed column to the name used by the DuckDB oracle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.functions.columns import render_times
from shopflow.operators import ads as D
from shopflow.operators import area as A
from shopflow.operators import category as C
from shopflow.operators import hygiene as H
from shopflow.operators import merge as M
from shopflow.operators import pageflow as G
from shopflow.operators import session as S
from shopflow.operators import sinks as K
from shopflow.plans import params as P
from shopflow.session import scratch_dir
from shopflow.sources import fixtures as X
from shopflow.sources.adlog import parse_ad_log, rejected_lines
from shopflow.sources.tables import read_day_range
from shopflow.streaming import ad_stream as R

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- shared intermediate plans ---------------------------------------------

def _actions(spark, sf):
    return X.user_visit_action(spark, sf)


def _full_info(spark, sf):
    return S.session_full_info(S.session_rollup(_actions(spark, sf)), X.user_info(spark, sf))


# --- session statistics ----------------------------------------------------

@query
def actions_in_range(spark, sf):
    acts = X.user_visit_action(spark, sf, P.RANGE_START, P.RANGE_END)
    return render_times(S.actions_in_range(acts, P.RANGE_START, P.RANGE_END))


@query
def session_rollup(spark, sf):
    return render_times(S.session_rollup(_actions(spark, sf)))


@query
def session_full_info(spark, sf):
    return render_times(_full_info(spark, sf))


@query
def session_filtered(spark, sf):
    return render_times(S.session_filtered(_full_info(spark, sf), **P.FILTER))


@query
def filtered_session_actions(spark, sf):
    sessions = S.session_filtered(_full_info(spark, sf), **P.FILTER_AGE_ONLY)
    return render_times(S.filtered_session_actions(_actions(spark, sf), sessions))


@query
def session_length_histogram(spark, sf):
    return S.session_length_histogram(_full_info(spark, sf))


@query
def session_stat(spark, sf):
    return S.session_stat(_full_info(spark, sf))


@query
def session_hour_counts(spark, sf):
    return S.session_hour_counts(_full_info(spark, sf))


@query
def session_sample_quota(spark, sf):
    return S.session_sample_quota(_full_info(spark, sf), P.SAMPLE_TOTAL)


@query
def session_sample(spark, sf):
    return render_times(S.session_sample(_full_info(spark, sf), P.SAMPLE_TOTAL, P.SAMPLE_SEED))


@query
def session_sample_detail(spark, sf):
    sample = S.session_sample(_full_info(spark, sf), P.SAMPLE_TOTAL, P.SAMPLE_SEED)
    return render_times(S.session_sample_detail(_actions(spark, sf), sample, P.SAMPLE_TOTAL))


# --- categories --------------------------------------------------------------


@query
def category_touched(spark, sf):
    return C.category_touched(_actions(spark, sf))


@query
def category_click_counts(spark, sf):
    return C.category_click_counts(_actions(spark, sf))


@query
def category_order_counts(spark, sf):
    return C.category_order_counts(_actions(spark, sf))


@query
def category_pay_counts(spark, sf):
    return C.category_pay_counts(_actions(spark, sf))


@query
def category_full_counts(spark, sf):
    return C.category_full_counts(_actions(spark, sf))


@query
def category_top10(spark, sf):
    return C.category_top(C.category_full_counts(_actions(spark, sf)), P.TOP_CATEGORIES)


def _session_category_clicks(spark, sf):
    acts = _actions(spark, sf)
    return C.session_category_clicks(acts, C.category_top(C.category_full_counts(acts), P.TOP_CATEGORIES))


@query
def session_category_clicks(spark, sf):
    return _session_category_clicks(spark, sf)


@query
def category_top10_sessions(spark, sf):
    return C.category_top_sessions(_session_category_clicks(spark, sf), P.TOP_SESSIONS)


# --- the session job's main path: filter sessions, join back, then rank ------

@query
def session_filtered_places(spark, sf):
    return render_times(S.session_filtered(_full_info(spark, sf), **P.FILTER_PLACES))


def _filtered_actions(spark, sf):
    acts = _actions(spark, sf)
    sessions = S.session_filtered(S.session_full_info(S.session_rollup(acts), X.user_info(spark, sf)), **P.FILTER)
    return S.filtered_session_actions(acts, sessions)


@query
def filtered_category_top10(spark, sf):
    return C.category_top(C.category_full_counts(_filtered_actions(spark, sf)), P.TOP_CATEGORIES)


@query
def filtered_category_top10_sessions(spark, sf):
    acts = _filtered_actions(spark, sf)
    top = C.category_top(C.category_full_counts(acts), P.TOP_CATEGORIES)
    return C.category_top_sessions(C.session_category_clicks(acts, top), P.TOP_SESSIONS)


# --- page conversion ---------------------------------------------------------


def _ranged_actions(spark, sf):
    acts = X.user_visit_action(spark, sf, P.RANGE_START, P.RANGE_END)
    return S.actions_in_range(acts, P.RANGE_START, P.RANGE_END)


@query
def page_conversion_in_range(spark, sf):
    return G.page_conversion(G.page_flow_counts(spark, _ranged_actions(spark, sf), P.PAGE_FLOW))


@query
def page_transition_counts(spark, sf):
    return G.page_transition_counts(_actions(spark, sf))


@query
def page_flow_counts(spark, sf):
    return G.page_flow_counts(spark, _actions(spark, sf), P.PAGE_FLOW)


@query
def page_conversion(spark, sf):
    return G.page_conversion(G.page_flow_counts(spark, _actions(spark, sf), P.PAGE_FLOW))


@query
def page_conversion_packed(spark, sf):
    return G.page_conversion_packed(
        G.page_conversion(G.page_flow_counts(spark, _actions(spark, sf), P.PAGE_FLOW)))


# --- area top products -------------------------------------------------------


def _area_counts(spark, sf):
    return A.area_product_counts(A.area_clicks(_actions(spark, sf), X.city_area(spark, sf)))


@query
def area_clicks(spark, sf):
    return A.area_clicks(_actions(spark, sf), X.city_area(spark, sf))


@query
def area_product_counts(spark, sf):
    return _area_counts(spark, sf)


@query
def area_product_info(spark, sf):
    return A.area_product_info(_area_counts(spark, sf), X.product_info(spark, sf))


@query
def area_top3_products(spark, sf):
    info = A.area_product_info(_area_counts(spark, sf), X.product_info(spark, sf))
    return A.area_top_products(info, P.TOP_PRODUCTS, P.AREA_LEVELS)


@query
def area_top3_in_range(spark, sf):
    counts = A.area_product_counts(A.area_clicks(_ranged_actions(spark, sf), X.city_area(spark, sf)))
    return A.area_top_products(A.area_product_info(counts, X.product_info(spark, sf)), P.TOP_PRODUCTS, P.AREA_LEVELS)


# --- ad statistics (batch) ---------------------------------------------------


def _clicks(spark, sf):
    return parse_ad_log(X.ad_log(spark, sf))


def _allowed(spark, sf):
    return D.ad_clicks_allowed(_clicks(spark, sf), P.AD_THRESHOLD)


@query
def ad_click_log(spark, sf):
    return _clicks(spark, sf).select(*D.CLICK_COLS)


@query
def ad_log_dirty_clicks(spark, sf):
    """The clicks of a log with broken lines."""
    return parse_ad_log(X.ad_log_dirty(spark, sf)).select(*D.CLICK_COLS)


@query
def ad_log_rejects(spark, sf):
    """The broken lines of that log, with the reason."""
    return rejected_lines(X.ad_log_dirty(spark, sf))


@query
def ad_user_daily_clicks(spark, sf):
    return D.ad_user_daily_clicks(_clicks(spark, sf))


@query
def ad_blacklist(spark, sf):
    return D.ad_blacklist(_clicks(spark, sf), P.AD_THRESHOLD)


@query
def ad_clicks_allowed(spark, sf):
    return _allowed(spark, sf).select(*D.CLICK_COLS)


@query
def ad_stat(spark, sf):
    return D.ad_stat(_allowed(spark, sf))


@query
def ad_province_top3(spark, sf):
    return D.ad_province_top(D.ad_stat(_allowed(spark, sf)), P.TOP_ADS)


@query
def ad_click_trend(spark, sf):
    return D.ad_click_trend(_allowed(spark, sf))


@query
def ad_recent_hour(spark, sf):
    return D.ad_recent_hour(_allowed(spark, sf), P.WINDOW_MINUTES)


@query
def ad_hourly_sliding(spark, sf):
    return D.ad_hourly_sliding(_allowed(spark, sf), P.WINDOW_MINUTES, P.SLIDE_MINUTES)


# --- keyed merges: the clicks split at a time; the early part is the stored
# table, the late part the incoming batch ------------------------------------

def _split(spark, sf):
    clicks = _clicks(spark, sf)
    split_ms = F.unix_millis(F.lit(P.SPLIT_TS).cast("timestamp"))
    return clicks.where(F.col("ts_ms") < split_ms), clicks.where(F.col("ts_ms") >= split_ms), clicks


@query
def lookup_by_key(spark, sf):
    early, late, _ = _split(spark, sf)
    batch = D.ad_user_daily_clicks(late).withColumnRenamed("click_count", "batch_count")
    return M.lookup_by_key(batch, D.ad_user_daily_clicks(early), ["date", "userid", "adid"],
                           "click_count", "stored_count")


@query
def upsert_add(spark, sf):
    early, late, _ = _split(spark, sf)
    return M.upsert_add(D.ad_user_daily_clicks(early), D.ad_user_daily_clicks(late),
                        ["date", "userid", "adid"], "click_count")


_STAT_KEYS = ["date", "province", "city", "adid"]


@query
def upsert_set(spark, sf):
    early, late, clicks = _split(spark, sf)
    touched = late.select(*_STAT_KEYS).distinct()
    updates = D.ad_stat(clicks).join(touched, _STAT_KEYS, "left_semi")
    return M.upsert_set(D.ad_stat(early), updates, _STAT_KEYS, ["click_count"])


@query
def replace_groups(spark, sf):
    early, late, clicks = _split(spark, sf)
    touched = late.select("date", "province").distinct()
    updates = D.ad_province_top(D.ad_stat(clicks), P.TOP_ADS).join(touched, ["date", "province"], "left_semi")
    return M.replace_groups(D.ad_province_top(D.ad_stat(early), P.TOP_ADS), updates, ["date", "province"])


@query
def append_distinct(spark, sf):
    early, _, clicks = _split(spark, sf)
    return M.append_distinct(D.ad_blacklist(early, P.AD_THRESHOLD), D.ad_blacklist(clicks, P.AD_THRESHOLD),
                             ["userid"])


# --- utilities as table jobs -------------------------------------------------


@query
def session_time_gaps(spark, sf):
    return H.session_time_gaps(_actions(spark, sf))


@query
def daily_activity(spark, sf):
    day = P.AS_OF_DAY
    prev = (dt.date.fromisoformat(day) - dt.timedelta(days=1)).isoformat()
    return H.daily_activity(X.user_visit_action(spark, sf, prev, day), day)


@query
def clean_id_lists(spark, sf):
    """The fixture's lists have clean edges: they are wrapped in commas here."""
    wrapped = {c: F.concat(F.lit(","), F.col(c), F.lit(",")) for c in H.LIST_COLS}
    return H.clean_id_lists(_actions(spark, sf).withColumns(wrapped))


@query
def packed_sessions(spark, sf):
    return H.packed_sessions(render_times(_full_info(spark, sf)))


# --- sinks -------------------------------------------------------------------

@query
def sink_append(spark, sf):
    """The top categories appended twice under two run ids, read back."""
    path = scratch_dir(spark, "sink-append")
    top = category_top10(spark, sf)
    K.append_result(top, path, "run-1")
    K.append_result(top, path, "run-2")
    return K.read_back(spark, path)


@query
def actions_partitioned_range(spark, sf):
    """The actions stored partitioned by day, then a day range read back
    with partition pruning (same rows as ``actions_in_range``)."""
    path = scratch_dir(spark, "actions-by-day")
    acts = _actions(spark, sf)
    K.write_partitioned(acts, path, "date")
    back = read_day_range(spark, path, P.RANGE_START, P.RANGE_END, schema=acts.schema)
    return render_times(back.select(*acts.columns))


@query
def sink_overwrite_table(spark, sf):
    """The area top products saved as a table twice (drop and recreate)."""
    path = scratch_dir(spark, "sink-table")
    name = "area_top3_" + path.rsplit("-", 1)[-1]
    top = area_top3_products(spark, sf)
    K.overwrite_table(top, name, path)
    K.overwrite_table(top, name, path)
    return spark.table(name)


# --- streams: the ad log replayed in event-id order, one arrival per batch,
# the stream restarted from its checkpoint after each (availableNow) ---------

_AVAILABLE = {"availableNow": True}


def _state_partitions(spark):
    return max(8, spark.sparkContext.defaultParallelism)


def _slots(spark):
    """Several slots to a partition, which even out what the partitions get."""
    return 8 * _state_partitions(spark)


def _replay(spark, sf, start):
    root = scratch_dir(spark, "stream")
    src, ckpt, out = f"{root}/feed", f"{root}/checkpoint", f"{root}/out"

    def arrival(_i):
        R.run_available(lambda: start(R.read_lines(spark, src), out, ckpt))

    R.replay_feed(spark, X.ad_log(spark, sf), src, P.STREAM_BATCHES, arrival)
    return out


@query
def stream_ad_stat(spark, sf):
    out = _replay(spark, sf, lambda lines, o, c: R.ad_stat_stream(
        spark, lines, o, c, P.TOP_ADS, trigger=_AVAILABLE, state_partitions=_state_partitions(spark),
        slots=_slots(spark)))
    return R.result(spark, out, "ad_stat")


@query
def stream_province_top3(spark, sf):
    out = _replay(spark, sf, lambda lines, o, c: R.ad_stat_stream(
        spark, lines, o, c, P.TOP_ADS, trigger=_AVAILABLE, state_partitions=_state_partitions(spark),
        slots=_slots(spark)))
    return R.result(spark, out, "province_top")


@query
def stream_click_trend(spark, sf):
    out = _replay(spark, sf, lambda lines, o, c: R.click_trend_stream(
        spark, lines, o, c, trigger=_AVAILABLE, state_partitions=_state_partitions(spark)))
    return R.result(spark, out, "click_trend")


@query
def stream_hourly_sliding(spark, sf):
    out = _replay(spark, sf, lambda lines, o, c: R.hourly_sliding_stream(
        spark, lines, o, c, P.WINDOW_MINUTES, P.SLIDE_MINUTES, trigger=_AVAILABLE,
        state_partitions=_state_partitions(spark)))
    return R.result(spark, out, "hourly_sliding").drop("date")


@query
def stream_blacklist(spark, sf):
    out = _replay(spark, sf, lambda lines, o, c: R.blacklist_stream(
        spark, lines, o, c, P.AD_THRESHOLD, trigger=_AVAILABLE, state_partitions=_state_partitions(spark),
        slots=_slots(spark)))
    return R.result(spark, out, "blacklist")


def _filtered(spark, sf, table):
    out = _replay(spark, sf, lambda lines, o, c: R.filtered_ad_stream(
        spark, lines, o, c, P.AD_THRESHOLD, P.TOP_ADS, trigger=_AVAILABLE, state_partitions=_state_partitions(spark),
        slots=_slots(spark)))
    return R.result(spark, out, table)


@query
def stream_filtered_ad_stat(spark, sf):
    """Running totals over the clicks the per-batch blacklist lets through."""
    return _filtered(spark, sf, "ad_stat")


@query
def stream_filtered_province_top3(spark, sf):
    return _filtered(spark, sf, "province_top")


@query
def stream_filtered_click_trend(spark, sf):
    return _filtered(spark, sf, "click_trend")
