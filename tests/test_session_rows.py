
import datetime as dt

from pyspark.sql import functions as F

from shopflow.functions.columns import STEP_BUCKETS, VISIT_BUCKETS, half_up_ratio, half_up_text
from shopflow.operators import session as S

ACTION_SCHEMA = ("date string, user_id bigint, session_id string, event_id bigint, page_id bigint, "
                 "action_time timestamp, search_keyword string, click_category_id bigint, "
                 "click_product_id bigint, order_category_ids string, order_product_ids string, "
                 "pay_category_ids string, pay_product_ids string, city_id bigint")
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def action(sid, eid, secs, kw=None, cat=-1, user=1, page=1, day="2024-01-01", orders=None, pays=None):
    t = dt.datetime.fromisoformat(day + " 10:00:00") + dt.timedelta(seconds=secs)
    return (day, user, sid, eid, page, t, kw, cat, -1 if cat == -1 else 7, orders, None, pays, None, 0)


def sessions_with_lengths(spark, lengths):
    rows = []
    eid = 0
    for i, secs in enumerate(lengths):
        rows.append(action(f"s{i}", eid, 0)); eid += 1
        rows.append(action(f"s{i}", eid, secs)); eid += 1
    return S.session_rollup(spark.createDataFrame(rows, ACTION_SCHEMA))


def test_visit_bucket_edges(spark):
    edges = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    hist = {(r.kind, r.bucket): r.n for r in S.session_length_histogram(sessions_with_lengths(spark, edges)).collect()}
    expect = {"1s_3s": 2, "4s_6s": 2, "7s_9s": 2, "10s_30s": 2, "30s_60s": 2, "1m_3m": 2,
              "3m_10m": 2, "10m_30m": 2, "30m": 1}
    assert {b: hist[("visit", b)] for b, _, _ in VISIT_BUCKETS} == expect  # 0 s is in no bucket
    assert hist[("step", "1_3")] == len(edges)


def test_step_bucket_edges(spark):
    rows, eid = [], 0
    for i, n in enumerate([1, 3, 4, 60, 61]):
        for j in range(n):
            rows.append(action(f"s{i}", eid, j)); eid += 1
    rollup = S.session_rollup(spark.createDataFrame(rows, ACTION_SCHEMA))
    hist = {r.bucket: r.n for r in S.session_length_histogram(rollup).collect() if r.kind == "step"}
    assert hist == {"1_3": 2, "4_6": 1, "7_9": 0, "10_30": 0, "30_60": 1, "60": 1}
    assert [b for b, _, _ in STEP_BUCKETS] == list(hist)


def test_keywords_first_seen_exact_distinct(spark):
    # "kw1" is contained in "kw12": both must survive (the reference's
    # substring test would drop one); order is first occurrence by time,
    # then event id on equal times.
    rows = [action("s", 3, 5, kw="kw12"), action("s", 1, 9, kw="kw1"), action("s", 2, 5, kw="kw3"),
            action("s", 4, 20, kw="kw12"), action("s", 5, 1, cat=42), action("s", 6, 2, cat=4),
            action("s", 7, 3, cat=42)]
    r = S.session_rollup(spark.createDataFrame(rows, ACTION_SCHEMA)).collect()[0]
    assert r.search_keywords == "kw3,kw12,kw1"
    assert r.click_category_ids == "42,4"
    assert r.step_length == 7 and r.visit_length == 19


def test_session_without_keywords_is_empty_string(spark):
    r = S.session_rollup(spark.createDataFrame([action("s", 1, 0)], ACTION_SCHEMA)).collect()[0]
    assert r.search_keywords == "" and r.click_category_ids == ""


def test_unknown_user_drops_out(spark):
    rollup = S.session_rollup(spark.createDataFrame([action("a", 1, 0, user=1), action("b", 2, 0, user=2)],
                                                    ACTION_SCHEMA))
    users = spark.createDataFrame([(1, 30, "p", "m", "c")], "user_id bigint, age int, professional string, "
                                  "sex string, city string")
    assert [r.session_id for r in S.session_full_info(rollup, users).collect()] == ["a"]


INFO_SCHEMA = "session_id string, age int, professional string, sex string, city string, " \
              "search_keywords string, click_category_ids string"


def test_predicates_missing_parameter_data_and_sentinel(spark):
    df = spark.createDataFrame([
        ("a", 30, "x", "male", "c1", "kw1,kw2", "1,2"),
        ("b", None, "x", "male", "c1", "", "-1"),
        ("c", 70, None, None, None, "kw9", ""),
    ], INFO_SCHEMA)

    def ids(**p):
        return sorted(r.session_id for r in S.session_filtered(df, **p).collect())

    assert ids() == ["a", "b", "c"]                       # no parameter: all pass
    assert ids(start_age=20, end_age=50) == ["a"]          # missing data fails
    assert ids(professionals=["x"]) == ["a", "b"]
    assert ids(sex="male", cities=["c1"]) == ["a", "b"]
    assert ids(keywords=["kw2", "kw7"]) == ["a"]
    assert ids(category_ids=[2]) == ["a"]
    assert ids(category_ids=[-1]) == []                    # "-1" data never matches


def test_half_up_rounding_from_integers(spark):
    df = spark.createDataFrame([(113, 200), (1, 8), (5, 1000), (2, 3), (0, 7)], "n bigint, d bigint")
    got = df.select(half_up_ratio(F.col("n"), F.col("d")).alias("r"),
                    half_up_text(F.col("n"), F.col("d"), 4).alias("t")).collect()
    assert [r.r for r in got] == [0.57, 0.13, 0.01, 0.67, 0.0]
    assert [r.t for r in got] == ["0.5650", "0.1250", "0.0050", "0.6667", "0.0000"]


def test_session_stat_with_no_sessions(spark):
    empty = sessions_with_lengths(spark, []).limit(0)
    r = S.session_stat(empty).collect()[0]
    assert r.session_count == 0 and r.visit_length_1s_3s_ratio == 0.0


def test_multi_day_sample_quota_and_determinism(spark):
    rows, eid = [], 0
    for day, n in (("2024-01-01", 30), ("2024-01-02", 10)):
        for i in range(n):
            rows.append(action(f"{day}-{i}", eid, i * 120, day=day)); eid += 1
    sessions = S.session_rollup(spark.createDataFrame(rows, ACTION_SCHEMA))
    quota = S.session_sample_quota(sessions, total=10).collect()
    # per_day = 10 div 2 = 5; every hour gets n * 5 div day_n, at most n
    for q in quota:
        assert q.quota == min(q.session_count, q.session_count * 5 // q.day_session_count)
    a = sorted(r.session_id for r in S.session_sample(sessions, total=10, seed=7).collect())
    b = sorted(r.session_id for r in S.session_sample(sessions, total=10, seed=7).collect())
    assert a == b and len(a) == sum(q.quota for q in quota)
    assert len({s[:10] for s in a}) == 2  # both days sampled in one pass


def test_order_key_orders_like_the_pair(spark):
    from shopflow.functions.columns import order_key
    t1, t2 = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10, 0, 0, 1)
    ids = [-(2 ** 63), -5, 0, 7, 2 ** 63 - 1]
    rows = [(t, i) for t in (t1, t2) for i in ids]
    df = spark.createDataFrame(rows, "t timestamp, id bigint").withColumn("k", order_key("t", "id"))
    got = [(r.t, r.id) for r in df.orderBy("k").collect()]
    assert got == sorted(rows)


def test_integer_division_is_exact_beyond_double_precision(spark):
    from shopflow.functions.columns import int_div
    a, b = 2 ** 62 + 7, 3
    r = spark.createDataFrame([(a, b)], "a bigint, b bigint").select(int_div(F.col("a"), F.col("b")).alias("q")).first()
    assert r.q == a // b
