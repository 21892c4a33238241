"""Sliding totals by sweep and the log parser, on hand-made rows."""

import random

from pyspark.sql import functions as F

from shopflow.operators import ads as D
from shopflow.sources.adlog import parse_ad_log, rejected_lines

EPOCH = 28_000_000  # a minute in 2023


def test_sliding_totals_equal_a_count_per_window(spark):
    rng = random.Random(4)
    minutes = [EPOCH + m for m in (0, 0, 1439, 1440, 1441, 2879, 2880, 9000)] + [EPOCH + rng.randrange(6000) for _ in range(60)]
    clicks = [(60_000 * m + rng.randrange(60_000), rng.choice([1, 2])) for m in minutes]
    df = spark.createDataFrame(clicks, "ts_ms bigint, adid bigint")
    for window, slide in ((60, 1), (60, 7), (5, 15), (3000, 60)):
        want = {}
        for ms, ad in clicks:
            m = ms // 60_000
            for s in range(m - window + 1, m + 1):
                if s % slide == 0:
                    want[ad, s] = want.get((ad, s), 0) + 1
        got = D.ad_hourly_sliding(df, window, slide).select(
            "adid", (F.unix_timestamp("window_start") / 60).cast("bigint"), "click_count",
            ((F.unix_timestamp("window_end") - F.unix_timestamp("window_start")) / 60).cast("int")).collect()
        assert {(a, s): n for a, s, n, _ in got} == want and len(got) == len(want) and {w for *_, w in got} == {window}


def test_sliding_totals_of_no_clicks(spark):
    assert D.ad_hourly_sliding(spark.createDataFrame([], "ts_ms bigint, adid bigint")).collect() == []


def test_a_line_is_split_once(spark, capsys):
    lines = spark.createDataFrame([("1 P C 2 3",), (None,), ("x P C 2 3",), ("1 P C 2",), ("1 P C 2 y",)], "value string")
    assert [tuple(r) for r in parse_ad_log(lines).select("ts_ms", "province", "city", "userid", "adid").collect()] == [(1, "P", "C", 2, 3)]
    assert sorted(r.reason for r in rejected_lines(lines).collect()) == ["bad time", "bad user or ad", "not five fields", "null line"]
    parse_ad_log(spark.read.text(__file__)).explain()
    assert capsys.readouterr().out.count("split(") == 1
