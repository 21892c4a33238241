"""Hand-made rows for categories, page conversion and area ranking."""

import datetime as dt

from shopflow.operators import area as A
from shopflow.operators import category as C
from shopflow.operators import pageflow as G
from tests.test_session_rows import ACTION_SCHEMA, action


def test_category_counts_union_of_kinds_and_ties(spark):
    rows = [action("s1", 1, 0, cat=5), action("s1", 2, 1, cat=6), action("s2", 3, 0, orders="5,6,,7"),
            action("s2", 4, 1, pays="6"), action("s3", 5, 0, cat=7)]
    acts = spark.createDataFrame(rows, ACTION_SCHEMA)
    full = {r.category_id: (r.click_count, r.order_count, r.pay_count)
            for r in C.category_full_counts(acts).collect()}
    assert full == {5: (1, 1, 0), 6: (1, 1, 1), 7: (1, 1, 0)}
    # ties on (click, order, pay) fall back to id ascending
    assert [r.category_id for r in C.category_top(C.category_full_counts(acts), 2).collect()] == [6, 5]


def test_top_sessions_per_category_tie_break(spark):
    df = spark.createDataFrame([(1, "b", 3), (1, "a", 3), (1, "c", 1), (2, "z", 1)],
                               "category_id bigint, session_id string, click_count bigint")
    got = [(r.category_id, r.session_id) for r in C.category_top_sessions(df, 2).orderBy("category_id", "session_id").collect()]
    assert got == [(1, "a"), (1, "b"), (2, "z")]


def test_missing_funnel_step_counts_zero_and_ratio_null(spark):
    rows = []
    for i, pages in enumerate([[1, 2, 3], [1, 2], [1, 3]]):
        for j, p in enumerate(pages):
            rows.append(action(f"s{i}", i * 10 + j, j, page=p))
    acts = spark.createDataFrame(rows, ACTION_SCHEMA)
    counts = {r.step: (r.page_pair, r.pair_count) for r in G.page_flow_counts(spark, acts, "1,2,3,4,5").collect()}
    assert counts == {0: ("1", 3), 1: ("1_2", 2), 2: ("2_3", 1), 3: ("3_4", 0), 4: ("4_5", 0)}
    conv = {r.step: r.convert_rate for r in G.page_conversion(G.page_flow_counts(spark, acts, "1,2,3,4,5")).collect()}
    assert conv[1] == 2 / 3 and conv[2] == 0.5 and conv[3] == 0.0 and conv[4] is None
    packed = G.page_conversion_packed(G.page_conversion(G.page_flow_counts(spark, acts, "1,2,3,4,5"))).first()
    assert packed.convert_rate == "1_2=0.6667|2_3=0.5000|3_4=0.0000|4_5=null"


def test_transitions_follow_time_then_event_id(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [("2024-01-01", 1, "s", 3, 9, t, None, -1, -1, None, None, None, None, 0),
            ("2024-01-01", 1, "s", 1, 8, t, None, -1, -1, None, None, None, None, 0),
            ("2024-01-01", 1, "s", 2, 7, t - dt.timedelta(seconds=1), None, -1, -1, None, None, None, None, 0)]
    got = sorted((r.from_page, r.to_page) for r in G.page_transitions(spark.createDataFrame(rows, ACTION_SCHEMA)).collect())
    assert got == [(7, 8), (8, 9)]


def test_area_top_products_ties_levels_and_city_list(spark):
    clicks = spark.createDataFrame(
        [(2, "B", "north", 10), (1, "A", "north", 10), (1, "A", "north", 11), (1, "A", "north", 11),
         (3, "C", "south", 12)], "city_id bigint, city_name string, area string, pid bigint")
    counts = A.area_product_counts(clicks)
    ci = {(r.area, r.pid): (r.click_count, r.city_infos) for r in counts.collect()}
    assert ci[("north", 10)] == (2, "1:A,2:B")
    products = spark.createDataFrame([(10, "p10", '{"product_status": 0}'), (11, "p11", '{"product_status": 1}'),
                                      (12, "p12", '{"product_status": 1}')],
                                     "product_id bigint, product_name string, extend_info string")
    top = A.area_top_products(A.area_product_info(counts, products), 1, {"north": "A_Level"}).collect()
    got = sorted((r.area, r.pid, r.area_level, r.product_status) for r in top)
    # north: 10 and 11 tie on 2 clicks → lower pid wins
    assert got == [("north", 10, "A_Level", "Self"), ("south", 12, "D_Level", "Third Party")]


def test_product_status_of_any_document(spark):
    docs = {1: '{"product_status": 0}', 2: '{"product_status": "0"}', 3: '{"product_status": 1}', 4: None, 5: "", 6: "{broken",
            7: '{"product_status": {"product_status": 0}}', 8: '{"product_status": [0]}', 9: '{"a": {"product_status": 0}}',
            10: '{"product_status": null}', 11: "[0]", 12: '{"product_status": 0, "b": [1, {"c": 2}]}', 13: '{"product_status": 0} trailing',
            14: '{"product_status": "00"}', 15: "0"}
    products = spark.createDataFrame([(i, f"p{i}", d) for i, d in docs.items()], "product_id bigint, product_name string, extend_info string")
    counts = spark.createDataFrame([("A", i, 1, "c") for i in docs], "area string, pid bigint, click_count bigint, city_infos string")
    got = {r.pid: r.product_status for r in A.area_product_info(counts, products).collect()}
    assert {i for i, s in got.items() if s == "Self"} == {1, 2, 12, 13} and set(got) == set(docs) and set(got.values()) == {"Self", "Third Party"}
