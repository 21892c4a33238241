"""The reference's four applications as callable jobs.

Each takes the input tables as DataFrames (any source: Hive tables, parquet,
the fixture views) and the task parameters as keyword arguments, and appends
its results, tagged with ``task_id``, under ``out`` (one directory per result
table, named like the reference's result tables).  An action table in the
reference's own format (text times, no event id) is normalized by
``sources.tables.normalize_actions``.  The ad stream returns its running
``StreamingQuery``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shopflow.functions.columns import render_times
from shopflow.operators import area as A
from shopflow.operators import category as C
from shopflow.operators import pageflow as G
from shopflow.operators import session as S
from shopflow.operators.sinks import append_result
from shopflow.session import checkpoint_root, use_utc
from shopflow.sources.adlog import read_ad_log_stream
from shopflow.sources.tables import normalize_actions
from shopflow.streaming import ad_stream as R


def _task(spark: SparkSession, task_id: str | None) -> str:
    use_utc(spark)  # every date key and epoch conversion is defined in UTC
    return task_id or uuid.uuid4().hex


def session_statistics(spark: SparkSession, actions: DataFrame, users: DataFrame, out: str,
                       start_date: str, end_date: str, task_id: str | None = None,
                       sample_total: int = 100, seed: int = 42, top_categories: int = 10,
                       top_sessions: int = 10, **filters) -> str:
    """Session roll-up → filter → ratios, stratified sample (+ its actions),
    top categories of the filtered sessions' actions, top sessions per top
    category.  ``filters`` are the keyword arguments of
    ``session.session_predicate``.

    The filtered sessions feed five results; they are checkpointed once
    (reliable checkpoint in the shared ``spark.checkpoint.dir``), which cuts
    the lineage so a lost executor never re-runs the roll-up."""
    task = _task(spark, task_id)
    checkpoint_root(spark)
    acts = S.actions_in_range(normalize_actions(actions), start_date, end_date)
    sessions = S.session_filtered(S.session_full_info(S.session_rollup(acts), users), **filters).checkpoint()
    append_result(S.session_stat(sessions), f"{out}/session_stat", task)
    sample = S.session_sample(sessions, sample_total, seed)
    append_result(render_times(sample), f"{out}/session_extract", task)
    append_result(render_times(S.session_sample_detail(acts, sample, sample_total)), f"{out}/session_detail", task)
    session_acts = S.filtered_session_actions(acts, sessions)
    top = C.category_top(C.category_full_counts(session_acts), top_categories)
    append_result(top, f"{out}/top10_category", task)
    clicks = C.session_category_clicks(session_acts, top)
    append_result(C.category_top_sessions(clicks, top_sessions), f"{out}/top10_session", task)
    return task


def page_conversion(spark: SparkSession, actions: DataFrame, out: str, start_date: str, end_date: str,
                    target_page_flow: str, task_id: str | None = None) -> str:
    """Step conversion rates along ``target_page_flow`` ("1,2,3,…"): the
    per-step table and the packed ``a_b=rate|…`` string."""
    task = _task(spark, task_id)
    acts = S.actions_in_range(normalize_actions(actions), start_date, end_date)
    conversion = G.page_conversion(G.page_flow_counts(spark, acts, target_page_flow))
    append_result(conversion, f"{out}/page_split_convert_rate_steps", task)
    append_result(G.page_conversion_packed(conversion), f"{out}/page_split_convert_rate", task)
    return task


def area_top_products(spark: SparkSession, actions: DataFrame, city_dim: DataFrame, products: DataFrame,
                      out: str, start_date: str, end_date: str, task_id: str | None = None, n: int = 3,
                      levels: dict[str, str] = A.REFERENCE_AREA_LEVELS) -> str:
    """The ``n`` most clicked products per area with city list, product
    status and area level."""
    task = _task(spark, task_id)
    acts = S.actions_in_range(normalize_actions(actions), start_date, end_date)
    counts = A.area_product_counts(A.area_clicks(acts, city_dim))
    top = A.area_top_products(A.area_product_info(counts, products), n, levels)
    append_result(top, f"{out}/area_top3_product", task)
    return task


def ad_statistics(spark: SparkSession, out: str, checkpoint: str, source: str = "kafka",
                  path: str | None = None, threshold: int = 100, top_n: int = 3,
                  trigger: dict | None = None, state_partitions: int | None = None,
                  **source_options: str) -> StreamingQuery:
    """The ad-click stream: blacklist loop and, over the clicks it lets
    through, running totals, top ads per province and the per-minute trend
    (``streaming.ad_stream.filtered_ad_stream``); 5-second micro-batches by
    default.  ``source="kafka"`` takes ``kafka.bootstrap.servers`` /
    ``subscribe`` options; ``source="text"`` reads log files under ``path``."""
    lines = read_ad_log_stream(spark, path or "", source, **source_options)
    return R.filtered_ad_stream(spark, lines, out, checkpoint, threshold, top_n,
                                trigger=trigger or {"processingTime": "5 seconds"},
                                state_partitions=state_partitions)
