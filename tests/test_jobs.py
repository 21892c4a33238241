"""The four applications end to end on the smallest tables: their stored
results equal the catalogue queries with the same parameters."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from shopflow import jobs
from shopflow.plans import params as P
from shopflow.session import scratch_dir
from shopflow.sources import fixtures as X
from shopflow.streaming import ad_stream as R
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_session_statistics_job(spark):
    out = scratch_dir(spark, "job-session")
    acts = X.user_visit_action(spark, SF_SMALL)
    task = jobs.session_statistics(spark, acts, X.user_info(spark, SF_SMALL), out, "2024-01-01", "2024-01-31",
                                   task_id="t1", sample_total=P.SAMPLE_TOTAL, seed=P.SAMPLE_SEED)
    assert task == "t1"
    stat = spark.read.parquet(f"{out}/session_stat")
    assert rows(stat.drop("task_id")) == rows(E.queries()["session_stat"](spark, SF_SMALL))
    sample = spark.read.parquet(f"{out}/session_extract").drop("task_id")
    assert rows(sample) == rows(E.queries()["session_sample"](spark, SF_SMALL))
    # top categories are over the (unfiltered here) sessions' actions
    top = spark.read.parquet(f"{out}/top10_category").drop("task_id")
    assert rows(top) == rows(E.queries()["category_top10"](spark, SF_SMALL))
    assert spark.read.parquet(f"{out}/top10_session").where(F.col("task_id") == "t1").count() > 0


def test_page_and_area_jobs(spark):
    out = scratch_dir(spark, "job-page")
    acts = X.user_visit_action(spark, SF_SMALL)
    jobs.page_conversion(spark, acts, out, "2024-01-01", "2024-01-31", P.PAGE_FLOW, task_id="p")
    packed = spark.read.parquet(f"{out}/page_split_convert_rate").drop("task_id")
    assert rows(packed) == rows(E.queries()["page_conversion_packed"](spark, SF_SMALL))
    jobs.area_top_products(spark, acts, X.city_area(spark, SF_SMALL), X.product_info(spark, SF_SMALL), out,
                           "2024-01-01", "2024-01-31", task_id="a", levels=P.AREA_LEVELS)
    top = spark.read.parquet(f"{out}/area_top3_product").drop("task_id")
    assert rows(top) == rows(E.queries()["area_top3_products"](spark, SF_SMALL))


def test_ad_statistics_job_on_text_source(spark):
    root = scratch_dir(spark, "job-ads")
    src, out, ckpt = f"{root}/feed", f"{root}/out", f"{root}/ckpt"
    X.ad_log(spark, SF_SMALL).select("value").write.text(src)
    q = jobs.ad_statistics(spark, out, ckpt, source="text", path=src, threshold=P.AD_THRESHOLD,
                           trigger={"availableNow": True})
    q.awaitTermination()
    # one micro-batch over everything: the blacklist filters nothing yet
    got = R.result(spark, out, "ad_stat")
    assert rows(got) == rows(E.queries()["stream_ad_stat"](spark, SF_SMALL))
    assert rows(R.result(spark, out, "blacklist")) == rows(E.queries()["ad_blacklist"](spark, SF_SMALL))


def test_session_statistics_job_ranks_the_filtered_sessions(spark):
    out = scratch_dir(spark, "job-filtered")
    acts = X.user_visit_action(spark, SF_SMALL)
    for _ in range(2):  # a rerun of the task replaces its rows
        jobs.session_statistics(spark, acts, X.user_info(spark, SF_SMALL), out, "2024-01-01", "2024-01-31",
                                task_id="f", **P.FILTER)
    top = rows(spark.read.parquet(f"{out}/top10_category").drop("task_id"))
    assert top and top == rows(E.queries()["filtered_category_top10"](spark, SF_SMALL))
    sessions = rows(spark.read.parquet(f"{out}/top10_session").drop("task_id"))
    assert sessions and sessions == rows(E.queries()["filtered_category_top10_sessions"](spark, SF_SMALL))


def test_jobs_accept_the_reference_action_format(spark):
    # action_time as text and no event id, as the reference's table stores it;
    # one action per second of a session, so that no tie-break matters
    acts = X.user_visit_action(spark, SF_SMALL)
    first = acts.groupBy("session_id", "action_time").agg(F.min("event_id").alias("event_id")).select("event_id")
    acts = acts.join(first, "event_id", "left_semi")
    raw = acts.withColumn("action_time", F.date_format("action_time", "yyyy-MM-dd HH:mm:ss")).drop("event_id")
    out = scratch_dir(spark, "job-raw")
    flow = "1,2,3,4,5"
    jobs.page_conversion(spark, raw, out, "2024-01-01", "2024-01-31", flow, task_id="r")
    steps = spark.read.parquet(f"{out}/page_split_convert_rate_steps").drop("task_id")
    pages = {}
    for r in acts.select("session_id", "action_time", "page_id").collect():
        pages.setdefault(r.session_id, []).append((r.action_time, r.page_id))
    pairs = [(a, b) for v in pages.values() for (_, a), (_, b) in zip(sorted(v), sorted(v)[1:])]
    want = {"1": sum(p == 1 for v in pages.values() for _, p in v)}
    want.update({f"{a}_{a + 1}": pairs.count((a, a + 1)) for a in range(1, 5)})
    got = {r.page_pair: (r.pair_count, r.prev_count) for r in steps.collect()}
    before = {"1_2": "1", "2_3": "1_2", "3_4": "2_3", "4_5": "3_4"}
    assert got == {p: (want[p], want[q]) for p, q in before.items()} and sum(want.values()) > want["1"]
