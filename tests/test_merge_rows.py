"""Keyed merges and the event-exact blacklist."""


from shopflow.operators import ads as D
from shopflow.operators import merge as M
from shopflow.operators.sinks import append_result, read_back
from shopflow.session import scratch_dir

KV = "k string, v bigint"
CLICKS = "ts_ms bigint, date string, userid bigint, adid bigint"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_add_and_set(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], KV)
    u = spark.createDataFrame([("b", 5), ("c", 7)], KV)
    assert rows(M.upsert_add(t, u, ["k"], "v"), "k", "v", "action") == [
        ("a", 1, "kept"), ("b", 7, "updated"), ("c", 7, "inserted")]
    assert rows(M.upsert_set(t, u, ["k"], ["v"]), "k", "v", "action") == [
        ("a", 1, "kept"), ("b", 5, "updated"), ("c", 7, "inserted")]


def test_replace_groups_and_append_distinct(spark):
    t = spark.createDataFrame([("g1", 1), ("g1", 2), ("g2", 3)], "g string, v bigint")
    u = spark.createDataFrame([("g1", 9), ("g3", 4)], "g string, v bigint")
    assert rows(M.replace_groups(t, u, ["g"]), "g", "v", "action") == [
        ("g1", 9, "replaced"), ("g2", 3, "kept"), ("g3", 4, "inserted")]
    a = spark.createDataFrame([(1,), (2,)], "userid bigint")
    b = spark.createDataFrame([(2,), (3,), (3,)], "userid bigint")
    assert rows(M.append_distinct(a, b, ["userid"]), "userid", "action") == [
        (1, "kept"), (2, "kept"), (3, "inserted")]


def test_lookup_defaults_to_zero(spark):
    batch = spark.createDataFrame([("a",), ("z",)], "k string")
    stored = spark.createDataFrame([("a", 4)], KV)
    assert rows(M.lookup_by_key(batch, stored, ["k"], "v", "stored"), "k", "stored") == [("a", 4), ("z", 0)]


def test_event_exact_blacklist_keeps_clicks_until_listed(spark):
    clicks = spark.createDataFrame(
        [(1, "d", 1, 1), (2, "d", 1, 1), (3, "d", 1, 1), (4, "d", 1, 2), (5, "e", 1, 1),
         (1, "d", 2, 1), (9, "d", 2, 1)], CLICKS)
    # user 1's third click on ad 1 (ts 3) takes the count over 2: kept, later ones dropped
    allowed = rows(D.ad_clicks_allowed(clicks, threshold=2), "userid", "ts_ms")
    assert allowed == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 9)]
    assert rows(D.ad_blacklist(clicks, threshold=2), "userid") == [(1,)]


def test_append_distinct_keeps_all_columns(spark):
    a = spark.createDataFrame([(1, "old")], "userid bigint, note string")
    b = spark.createDataFrame([(1, "new"), (2, "z"), (2, "y")], "userid bigint, note string")
    assert rows(M.append_distinct(a, b, ["userid"]), "userid", "note", "action") == [(1, "old", "kept"), (2, "y", "inserted")]


def test_rerun_of_a_task_replaces_its_rows(spark):
    path = scratch_dir(spark, "test-task")
    for task, v in (("007", 1), ("b", 2), ("007", 3)):
        append_result(spark.createDataFrame([("a", v)], KV), path, task)
    assert rows(read_back(spark, path), "k", "v", "task_id") == [("a", 2, "b"), ("a", 3, "007")]
