
import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shopflow.session import scratch_dir
from shopflow.sources import fixtures as X
from shopflow.streaming import ad_stream as R
from shopflow.streaming import state
from shopflow.streaming.state import ClickFilter, Parts
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def _arrivals(spark, n):
    log = X.ad_log(spark, SF_SMALL)
    b = log.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    step = (b["hi"] - b["lo"]) // n + 1
    return [log.where((F.col("event_id") >= b["lo"] + i * step) & (F.col("event_id") < b["lo"] + (i + 1) * step))
            .select("value") for i in range(n)]


AVAILABLE = {"availableNow": True}


def _filtered(spark, src, out, ckpt, threshold=1, **kw):
    R.run_available(lambda: R.filtered_ad_stream(spark, R.read_lines(spark, src), out, ckpt, threshold,
                                                 trigger=AVAILABLE, state_partitions=2, slots=4, **kw))


def test_a_batch_written_again_changes_nothing(spark):
    # rows of a batch are absolute: the sink run again, as after a failure
    out = scratch_dir(spark, "again")
    sink = R._write(out)
    stat = lambda n: ("stat", "20240101", "P", "C", 3, n)
    batches = [[stat(2), ("top", "20240101", "P", None, 3, 2), ("black", "", "7", None, None, None), ("reject", "", "bad time", "x", None, None)],
               [stat(5), ("stat", "20240102", "P", "C", 3, 1), ("top", "20240101", "P", None, 4, 9), ("trend", "20240101", "3", "", 723, 4)]]
    for i, rows_ in enumerate(batches):
        for _ in range(2):
            sink(spark.createDataFrame(rows_, R.OUT_SCHEMA), i)
    assert rows(R.result(spark, out, "ad_stat")) == [("20240101", "P", "C", 3, 5), ("20240102", "P", "C", 3, 1)]
    assert rows(R.result(spark, out, "province_top")) == [("20240101", "P", 4, 9)]
    assert rows(R.result(spark, out, "click_trend")) == [("20240101", "12", "03", 3, 4)]
    assert rows(R.result(spark, out, "blacklist")) == [(7,)]
    assert rows(R.result(spark, out, "rejects")) == [("x", "bad time")]


def test_blacklist_set_does_not_depend_on_batch_split(spark):
    results = []
    for n in (1, 4):
        root = scratch_dir(spark, f"split{n}")
        for p in _arrivals(spark, n):
            p.write.mode("append").text(f"{root}/feed")
            R.run_available(lambda: R.blacklist_stream(spark, R.read_lines(spark, f"{root}/feed"), f"{root}/out", f"{root}/ckpt", 1,
                                                       trigger=AVAILABLE, state_partitions=2, slots=4))
        results.append(rows(R.result(spark, f"{root}/out", "blacklist")))
    assert results[0] == results[1] and len(results[0]) > 0


def test_a_listed_user_is_filtered_from_the_next_batch_on(spark):
    root = scratch_dir(spark, "loop")
    t0 = dt.datetime(2024, 1, 1, 12, 0, 30)
    batches = [[_line(t0)] * 2 + [_line(t0, user=2)], [_line(t0), _line(t0, user=2)], [_line(t0), _line(t0, user=3)]]
    want = [3, 4, 5]  # user 1 is listed by the first batch (2 > 1), user 2 by the second
    for lines, n in zip(batches, want):
        _write(spark, f"{root}/feed", lines)
        _filtered(spark, f"{root}/feed", f"{root}/out", f"{root}/ckpt")
        assert [r.click_count for r in R.result(spark, f"{root}/out", "ad_stat").collect()] == [n]
    assert rows(R.result(spark, f"{root}/out", "blacklist")) == [(1,), (2,)]
    assert [r.click_count for r in R.result(spark, f"{root}/out", "click_trend").collect()] == [5]


def test_top_ads_change_only_with_their_group(spark):
    root = scratch_dir(spark, "tops")
    t0 = dt.datetime(2024, 1, 1, 12, 0, 30)
    for lines in ([_line(t0, ad=a) for a in (1, 1, 2, 2, 3, 4)], [_line(t0, ad=4)] * 2, [_line(t0 + dt.timedelta(days=1), ad=9)]):
        _write(spark, f"{root}/feed", lines)
        R.run_available(lambda: R.ad_stat_stream(spark, R.read_lines(spark, f"{root}/feed"), f"{root}/out", f"{root}/ckpt", 2,
                                                 trigger=AVAILABLE, state_partitions=2, slots=4))
    assert rows(R.result(spark, f"{root}/out", "province_top")) == [("20240101", "P", 1, 2), ("20240101", "P", 4, 3), ("20240102", "P", 9, 1)]


def test_counts_of_a_stopped_query_are_read_from_its_checkpoint(spark):
    from shopflow.operators import ads as D
    from shopflow.sources.adlog import parse_ad_log
    from shopflow.streaming.tables import totals_in_state
    root = scratch_dir(spark, "state")
    for p in _arrivals(spark, 2):
        p.write.mode("append").text(f"{root}/feed")
        R.run_available(lambda: R.ad_stat_stream(spark, R.read_lines(spark, f"{root}/feed"), f"{root}/out", f"{root}/ckpt",
                                                 trigger=AVAILABLE, state_partitions=2, slots=4))
    state = totals_in_state(spark, f"{root}/ckpt").select("date", F.col("g").alias("province"), F.col("a").alias("city"), F.col("item").alias("adid"), "click_count")
    assert rows(state) == rows(D.ad_stat(parse_ad_log(X.ad_log(spark, SF_SMALL))))
    meta = spark.read.format("state-metadata").load(f"{root}/ckpt").collect()
    assert {r.operatorName for r in meta} == {"transformWithStateInPandasExec"} and {r.numPartitions for r in meta} == {2}


def test_state_behind_the_lateness_is_dropped(spark):
    root = scratch_dir(spark, "expire")
    t0 = dt.datetime(2024, 1, 1, 12, 0, 30)
    from shopflow.streaming.tables import totals_in_state
    for lines in ([_line(t0)], [_line(t0 + dt.timedelta(days=5))], [_line(t0 + dt.timedelta(days=5))], [_line(t0)]):
        _write(spark, f"{root}/feed", lines)
        R.run_available(lambda: R.ad_stat_stream(spark, R.read_lines(spark, f"{root}/feed"), f"{root}/out", f"{root}/ckpt",
                                                 lateness="1 day", trigger=AVAILABLE, state_partitions=2, slots=4))
    assert {r.date for r in totals_in_state(spark, f"{root}/ckpt").collect()} == {"20240106"}
    assert rows(R.result(spark, f"{root}/out", "ad_stat")) == [("20240101", "P", "C", 3, 1), ("20240106", "P", "C", 3, 2)]


def test_sliding_totals_count_late_clicks_and_gaps():
    import numpy as np
    import pandas as pd

    from shopflow.streaming.state import SlidingTotals

    class Map(dict):
        getValue, updateValue = dict.get, dict.__setitem__

    rng = np.random.default_rng(2)
    for window, slide in ((60, 1), (60, 15), (90, 7), (5, 1), (130, 10)):
        p = SlidingTotals(window, slide)
        p.days = Map()
        clicks, last = {}, {}
        for _ in range(6):
            minutes = np.concatenate([rng.integers(0, 400, 30), rng.integers(5000, 5100, 5)])
            for m in minutes.tolist():
                clicks[m] = clicks.get(m, 0) + 1
            for f in p.handleInputRows((9,), iter([pd.DataFrame({"minute": minutes, "n": 1})]), None):
                last.update(zip(f["start"].tolist(), f["click_count"].tolist()))
        starts = {s for m in clicks for s in range(m - window + 1, m + 1) if s % slide == 0}
        assert last == {s: sum(n for m, n in clicks.items() if s <= m < s + window) for s in starts}


class _States:
    """State in dictionaries, which counts the calls."""

    def __init__(self):
        self.calls, self.maps = 0, {}

    def getMapState(self, name, key, value, ttl_ms=None):
        owner = self

        class Map(dict):
            def getValue(self, k):
                owner.calls += 1
                return self.get(k)

            def updateValue(self, k, v):
                owner.calls += 1
                self[k] = v

        return self.maps.setdefault(name, Map())


def _filtered_by(p, frame, ms=0):
    class Now:
        def getCurrentProcessingTimeInMs(self):
            return ms

    cuts = range(0, len(frame), 500)
    return pd.concat([f for f in p.handleInputRows((1,), iter([frame[i:i + 500] for i in cuts]), Now()) if len(f)] or [pd.DataFrame({"kind": []})])


def test_the_click_filter_calls_the_state_per_entry_not_per_user():
    p, states = ClickFilter(3, True), _States()
    p.init(states)
    users = np.arange(20_000) * 7919 - 3_000_000
    frame = pd.DataFrame({"userid": users, "date": "20240101", "adid": 1, "n": 1})
    for _ in range(3):
        assert not len(_filtered_by(p, frame))
    assert states.calls < 3 * len(users) / 20
    rows = [len(v[0]) for v in states.maps["daily"].values()]
    assert sum(rows) == len(users) and max(rows) < 2 * Parts.ROWS
    assert set(_filtered_by(p, frame)["g"]) == set(map(str, users.tolist()))


def test_the_click_filter_equals_counting_by_user_as_its_parts_grow(monkeypatch):
    monkeypatch.setattr(Parts, "ROWS", 8)
    monkeypatch.setattr(state, "CHUNK", 700)
    rng = np.random.default_rng(5)
    for ttl in (None, 100):
        p = ClickFilter(4, False, ttl)
        p.init(_States())
        total, changed, listed, ms = {}, {}, set(), 1000
        for batch in range(8):
            n, ms = 1500 if batch < 6 else 40, ms + (150 if batch in (3, 6) else 40)
            frame = pd.DataFrame({"userid": rng.integers(-(1 << 62), 1 << 62, 300)[rng.integers(0, 300, n)] if batch == 2 else rng.integers(0, 60 * (batch + 1), n),
                                  "date": rng.choice(["20240101", "20240102"], n), "adid": rng.integers(0, 3, n), "province": rng.choice(["P", "Q"], n),
                                  "city": "C", "minute": rng.integers(0, 5, n), "n": rng.integers(1, 3, n)})
            found = _filtered_by(p, frame, ms)
            kept, new = frame[~frame["userid"].isin(listed)], set()
            days = set(zip(kept["userid"], kept["date"]))
            for key in [k for k in total if ttl and changed[k[:2]] + ttl <= ms]:
                del total[key]
            for u, d, a, k in zip(kept["userid"], kept["date"], kept["adid"], kept["n"]):
                total[u, d, a] = total.get((u, d, a), 0) + k
            changed.update(dict.fromkeys(days, ms))
            new = {u for (u, d, a), k in total.items() if (u, d) in days and k > 4}
            assert {int(u) for u in found[found["kind"] == "black"]["g"]} == new
            for kind, keys in (("stat", ["date", "province", "city", "adid"]), ("trend", ["date", "adid", "minute"])):
                mine = found[found["kind"] == kind]
                mine = mine.assign(g=mine["g"].astype(int)) if kind == "trend" else mine
                cols = ["date", "g", "a", "item"] if kind == "stat" else ["date", "g", "item"]
                assert mine.groupby(cols)["click_count"].sum().to_dict() == kept.groupby(keys)["n"].sum().to_dict()
            listed |= new
        assert listed


def test_running_totals_give_a_key_once_however_many_rows_a_batch_has(monkeypatch):
    monkeypatch.setattr(state, "CHUNK", 100)
    p = state.RunningTotals(2)
    p.init(_States())
    rng = np.random.default_rng(6)
    frames = [pd.DataFrame({"kind": "stat", "date": "20240101", "g": "P", "a": "C", "item": rng.integers(0, 400, 60), "click_count": 1}) for _ in range(30)]
    found = pd.concat(p.handleInputRows((1,), iter(frames), None))
    want = pd.concat(frames).groupby("item")["click_count"].sum().to_dict()
    got = found[found["kind"] == "stat"]
    assert not got["item"].duplicated().any() and dict(zip(got["item"], got["click_count"])) == want
    assert list(found[found["kind"] == "top"]["item"]) == sorted(want, key=lambda i: (-want[i], i))[:2]


def _line(ts, user=1, ad=3):
    ms = int(ts.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    return f"{ms} P C {user} {ad}"


def _write(spark, src, lines):
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.mode("append").text(src)


def test_late_rows_count_and_a_restart_adds_nothing(spark):
    root = scratch_dir(spark, "late")
    src, ckpt, out = f"{root}/feed", f"{root}/ckpt", f"{root}/out"
    t0 = dt.datetime(2024, 1, 1, 12, 0, 30)

    def run():
        R.run_available(lambda: R.click_trend_stream(spark, R.read_lines(spark, src), out, ckpt,
                                                     trigger={"availableNow": True}, state_partitions=2))

    _write(spark, src, [_line(t0), _line(t0 + dt.timedelta(hours=3))])
    run()
    _write(spark, src, [_line(t0 + dt.timedelta(seconds=5)),            # 3 h late
                        _line(t0 + dt.timedelta(hours=3, seconds=1))])  # on time
    run()
    run()  # restart with no new input
    got = {(r.hour, r.minute): r.click_count for r in R.result(spark, out, "click_trend").collect()}
    assert got == {("12", "00"): 2, ("15", "00"): 2}


def test_out_of_order_arrivals_equal_the_batch_forms(spark):
    from shopflow.operators import ads as D
    from shopflow.sources.adlog import parse_ad_log
    root = scratch_dir(spark, "disorder")
    src, out = f"{root}/feed", f"{root}/out"
    parts = _arrivals(spark, 4)
    for i in (3, 1, 0, 2):
        parts[i].write.mode("append").text(src)
        lines = R.read_lines(spark, src)
        R.run_available(lambda: R.ad_stat_stream(spark, lines, f"{out}/a", f"{root}/c1", trigger={"availableNow": True},
                                                 state_partitions=2))
        R.run_available(lambda: R.hourly_sliding_stream(spark, lines, f"{out}/b", f"{root}/c2", trigger={"availableNow": True},
                                                        state_partitions=2))
    clicks = parse_ad_log(X.ad_log(spark, SF_SMALL))
    assert rows(R.result(spark, f"{out}/a", "ad_stat")) == rows(D.ad_stat(clicks))
    assert rows(R.result(spark, f"{out}/b", "hourly_sliding").drop("date")) == rows(D.ad_hourly_sliding(clicks))


def test_a_bad_line_is_kept_as_a_reject_and_stops_nothing(spark):
    root = scratch_dir(spark, "bad")
    src, ckpt, out = f"{root}/feed", f"{root}/ckpt", f"{root}/out"
    t0 = dt.datetime(2024, 1, 1, 12, 0, 30)
    good = _line(t0)
    ms = good.split(" ")[0]
    bad = ["oops P C 1 2", "1 2 3", f"{ms} New York C 1 2", f"{ms} P C x 2", ""]
    _write(spark, src, [good, *bad, _line(t0 + dt.timedelta(seconds=1))])
    R.run_available(lambda: R.filtered_ad_stream(spark, R.read_lines(spark, src), out, ckpt, trigger={"availableNow": True}))
    assert [r.click_count for r in R.result(spark, out, "ad_stat").collect()] == [2]
    assert sorted(r.value for r in R.result(spark, out, "rejects").collect()) == sorted(bad)
    R.run_available(lambda: R.reject_stream(spark, R.read_lines(spark, src), f"{out}/2", f"{root}/ckpt2", trigger={"availableNow": True}))
    assert R.result(spark, f"{out}/2", "rejects").count() == len(bad)


def test_scratch_needs_a_shared_folder_off_a_local_master():
    import pytest

    from shopflow.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_stream_day_keys_are_utc_whatever_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        root = scratch_dir(spark, "tz")
        src, ckpt, out = f"{root}/feed", f"{root}/ckpt", f"{root}/out"
        _write(spark, src, [_line(dt.datetime(2024, 1, 2, 1, 30))])  # 01:30 UTC = previous day in New York
        R.run_available(lambda: R.click_trend_stream(spark, R.read_lines(spark, src), out, ckpt,
                                                     trigger={"availableNow": True}, state_partitions=2))
        r = R.result(spark, out, "click_trend").first()
        assert (r.date, r.hour, r.minute) == ("20240102", "01", "30")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
