"""Physical-plan properties that matter at scale."""

import pytest

import __spark_entry__ as E
from shopflow.plans.catalogue import QUERIES
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_range_reaches_the_scan(spark):
    p = plan(E.queries()["actions_in_range"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    assert "LessThan(ts," in p


@pytest.mark.parametrize("key", ["category_top10_sessions", "area_top3_products", "ad_province_top3",
                                 "session_sample"])
def test_top_n_is_cut_before_the_shuffle(spark, key):
    p = E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in p or key == "session_sample" and "_salt" in p  # 3000 per hour: ranked in salts


def test_blacklist_ranks_only_threshold_plus_one_clicks(spark):
    from shopflow.operators.ads import ad_blocked_at
    from shopflow.plans.catalogue import _clicks
    p = ad_blocked_at(_clicks(spark, SF_SMALL), 2)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in p and ", 3, Partial" in p


def test_no_job_runs_while_a_plan_is_built(spark):
    from shopflow.operators import ads, hygiene, pageflow
    from shopflow.plans.catalogue import _actions, _clicks
    acts, clicks = _actions(spark, SF_SMALL), _clicks(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("build", "plans only")
    try:
        ads.ad_clicks_allowed(clicks)
        pageflow.page_transition_counts(acts)
        pageflow.page_flow_counts(spark, acts, "1,2,3")
        hygiene.session_time_gaps(acts)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_blacklist_rank_is_salted_beyond_the_group_limit(spark):
    from pyspark.sql import functions as F

    from shopflow.operators.ads import ad_blocked_at
    from shopflow.plans.catalogue import _clicks
    hot = spark.range(30_000).select(F.lit("d").alias("date"), F.lit(1).cast("bigint").alias("userid"),
                                     F.lit(1).cast("bigint").alias("adid"), F.col("id").alias("ts_ms"))
    assert [tuple(r) for r in ad_blocked_at(hot, 1500).collect()] == [(1, 1500)]
    assert "_salt" in ad_blocked_at(_clicks(spark, SF_SMALL), 1500)._jdf.queryExecution().optimizedPlan().toString()


def test_kind_counts_read_one_column_of_a_stored_action_table(spark):
    from shopflow.operators import category as C
    from shopflow.session import scratch_dir
    from shopflow.sources.fixtures import user_visit_action
    path = scratch_dir(spark, "kinds")
    user_visit_action(spark, SF_SMALL).write.parquet(path)
    acts = spark.read.parquet(path)
    for fn, column in ((C.category_click_counts, "click_category_id:bigint"), (C.category_order_counts, "order_category_ids:string"),
                       (C.category_pay_counts, "pay_category_ids:string")):
        assert f"ReadSchema: struct<{column}>" in plan(fn(acts))


def test_page_flow_reads_the_actions_twice(spark):
    # once to count rows per session, once for the transitions; start pages come with them
    p = E.queries()["page_flow_counts"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Relation ") <= 4  # two scans in each branch of the union: inside chunks and across them


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if not k.startswith(("stream_", "sink_"))))
def test_no_cartesian_and_no_python_in_batch_plans(spark, key):
    p = E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "SortAggregate"):
        assert bad not in p, bad


def test_projection_is_pruned(spark):
    p = plan(E.queries()["category_touched"](spark, SF_SMALL))
    # only the two columns the category ids derive from are read
    assert "ReadSchema: struct<event_type:string,props:string>" in p


def test_day_partitioned_store_prunes_directories(spark):
    from shopflow.operators.sinks import write_partitioned
    from shopflow.session import scratch_dir
    from shopflow.sources.fixtures import user_visit_action
    from shopflow.sources.tables import read_day_range
    path = scratch_dir(spark, "pruning")
    write_partitioned(user_visit_action(spark, SF_SMALL), path)
    p = plan(read_day_range(spark, path, "2024-01-05", "2024-01-06"))
    assert "PartitionFilters: [isnotnull(date" in p and "2024-01-05" in p


def test_hot_groups_are_broadcast_not_joined_by_shuffle(spark):
    # the rows cross the network once, for the window; the list of hot
    # sessions is broadcast under its proven bound
    p = plan(E.queries()["page_transition_counts"](spark, SF_SMALL))
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p
