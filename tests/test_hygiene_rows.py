"""Hand-made rows for the utility jobs: id lists, packed records, time gaps,
daily activity."""

from shopflow.operators import hygiene as H
from tests.test_session_rows import ACTION_SCHEMA, action


def test_clean_id_lists_edges(spark):
    rows = [action("s", 1, 0, orders=",,1,,"), action("s", 2, 0, orders="7,07,7"), action("s", 3, 0, pays=""),
            action("s", 4, 0, orders="123"), action("s", 5, 0)]
    got = {r.event_id: (r.order_category_ids, r.pay_category_ids, r.removed_ids)
           for r in H.clean_id_lists(spark.createDataFrame(rows, ACTION_SCHEMA)).collect()}
    # ",,1,," → items ['', '1', ''] after the edge trim
    assert got[1] == ("01", None, 2)        # an absent list stays absent (null)
    assert got[2] == ("07", None, 2)        # padding makes 7 and 07 the same id
    assert got[3][1] == ""                   # an empty list stays empty
    assert got[4][0] == "123"                # longer ids are never cut
    assert 5 not in got                      # actions without lists are not listed


def test_packed_session_round_trip(spark):
    sessions = spark.createDataFrame(
        [("s1", "kw1,kw2", "3", 65, 4, "2024-01-01 10:00:00", 30, "p", "male", "c")],
        "session_id string, search_keywords string, click_category_ids string, visit_length bigint, "
        "step_length bigint, start_time string, age int, professional string, sex string, city string")
    r = H.packed_sessions(sessions).first()
    assert r.packed.startswith("sessionid=s1|searchKeywords=kw1,kw2|clickCategoryIds=3|visitLength=65|stepLength=4")
    assert (r.session_id, r.visit_length, r.step_length, r.age) == ("s1", 65, 4, 30)
    keys = [kv.split("=")[0] for kv in r.repacked.split("|")]
    assert keys == sorted(keys) and "stepLength=4_6" in r.repacked


def test_packed_session_escapes_its_separators(spark):
    sessions = spark.createDataFrame(
        [("s=1|x%7C", "red|age=5", "3", 65, 4, "2024-01-01 10:00:00", 30, "p", "male", "c")],
        "session_id string, search_keywords string, click_category_ids string, visit_length bigint, "
        "step_length bigint, start_time string, age int, professional string, sex string, city string")
    r = H.packed_sessions(sessions).first()
    assert (r.session_id, r.age) == ("s=1|x%7C", 30) and "searchKeywords=red%7Cage%3D5" in r.packed


def test_time_gaps_forward_and_back(spark):
    rows = [action("s", 1, 10), action("s", 2, 4), action("s", 3, 30), action("t", 9, 0)]
    r = {x.session_id: x for x in H.session_time_gaps(spark.createDataFrame(rows, ACTION_SCHEMA)).collect()}
    assert (r["s"].pair_count, r["s"].max_gap, r["s"].forward_steps, r["s"].back_steps) == (2, 26, 1, 1)
    assert "t" not in r  # one action: no pair


def test_daily_activity_zero_fills_kinds(spark):
    rows = [action("s", 1, 0, kw="kw1", day="2024-01-15"), action("s", 2, 0, cat=3, day="2024-01-14"),
            action("s", 3, 0, day="2024-01-13")]
    got = {r.kind: (r.day_count, r.prev_day_count, r.diff, r.day_key, r.prev_day_key, r.prev_day)
           for r in H.daily_activity(spark.createDataFrame(rows, ACTION_SCHEMA), "2024-01-15").collect()}
    assert got["search"] == (1, 0, 1, "20240115", "20240114", "2024-01-14")
    assert got["click"][:3] == (0, 1, -1)
    assert got["pay"][:3] == (0, 0, 0) and got["view"][:3] == (0, 0, 0)
