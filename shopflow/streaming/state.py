"""Stateful operators of the ad stream: Spark keeps their state (RocksDB) and
its checkpoints; nothing is read back from a result table.

All take rows that ``combine`` has counted within each task, so a hot user, ad
or province sends one row per distinct key and task into the state shuffle.
Users and groups are dealt into hash slots, the grouping keys: a slot handles
all its groups of a micro-batch in one call and touches their state entries
alone.  The number of slots bounds the tasks and is fixed with the checkpoint.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUT_SCHEMA = "kind string, date string, g string, a string, item bigint, click_count bigint"
OUT = ["kind", "date", "g", "a", "item", "click_count"]
SLOTS = 256
CHUNK = 200_000
DAY = 24 * 60


def slot(n: int, *cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int").alias("slot")


def combine(rows: DataFrame, keys: list[str], count: str = "n") -> DataFrame:
    """``rows`` counted by ``keys`` within each Arrow batch: the map-side half
    of a count, in front of an operator that sums."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                found = pa.Table.from_batches([batch]).group_by(keys).aggregate([([], "count_all")])
                yield from found.rename_columns([*keys, count]).to_batches()

    kinds = dict(rows.dtypes)
    return rows.select(*keys).mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", `{count}` bigint")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=OUT).astype({"item": "Int64", "click_count": "Int64"})


def _summed(frames: Iterator[pd.DataFrame], keys: list[str], count: str, whole: bool = False) -> Iterator[pd.DataFrame]:
    """Sums of ``count`` by ``keys`` over many frames at a time, so that each
    state entry is met once: about CHUNK rows in a result, or with ``whole`` one
    result with each key once."""
    held, n, limit = [], 0, CHUNK
    for frame in frames:
        held.append(frame[[*keys, count]])
        n += len(frame)
        if n >= limit:
            held = [pd.concat(held).groupby(keys)[count].sum().reset_index()]
            n = len(held[0])
            if whole:
                limit = max(CHUNK, 2 * n)
            elif 2 * n > CHUNK:
                yield held[0]
                held, n = [], 0
    if n:
        yield pd.concat(held).groupby(keys)[count].sum().reset_index()


class Parts:
    """Rows of bigints by user, the first column, in state entries of about
    ROWS rows.  The users of a group (``of``) are dealt into parts by hash; the
    number of parts grows with the group, so an entry stays small however many
    users there are, and a batch makes a call per entry, not per user."""

    ROWS = 512

    def __init__(self, handle: StatefulProcessorHandle, name: str, columns: list[str], ttl_ms: int | None = None):
        self.width = len(columns)
        self.entries = handle.getMapState(name, "of string, part bigint", ", ".join(f"{c} array<bigint>" for c in columns), ttl_ms)
        self.sizes = handle.getMapState(f"{name}_sizes", "of string", "parts bigint, held bigint", ttl_ms)

    def _read(self, of: str, part: int) -> np.ndarray:
        held = self.entries.getValue((of, part))
        return np.array(list(held), dtype=np.int64) if held else np.empty((self.width, 0), dtype=np.int64)

    def _write(self, of: str, part: int, rows: np.ndarray) -> None:
        self.entries.updateValue((of, part), tuple(rows.tolist()))

    @staticmethod
    def _dealt(rows: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
        x = rows[0].astype(np.uint64)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        at = ((x ^ (x >> np.uint64(33))) & np.uint64(parts - 1)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        found, starts = np.unique(at[order], return_index=True)
        return zip(found.tolist(), np.split(rows[:, order], starts[1:], axis=1))

    def of_users(self, of: str, users: np.ndarray) -> np.ndarray:
        """The rows held of these users."""
        size = self.sizes.getValue((of,))
        some = [self._read(of, part) for part, _ in self._dealt(users[None, :], size[0])] if size else []
        some = [rows[:, np.isin(rows[0], users)] for rows in some]
        return np.concatenate(some, axis=1) if some else np.empty((self.width, 0), dtype=np.int64)

    def update(self, of: str, rows: np.ndarray, merge: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> None:
        """Each part's rows become ``merge(held, new)``."""
        parts, held = self.sizes.getValue((of,)) or (1, 0)
        before, wanted = parts, held + rows.shape[1]
        while wanted > parts * self.ROWS:
            parts *= 2
        if held and parts > before:
            for part in range(before):
                cut = dict(self._dealt(self._read(of, part), parts))
                for to, some in ({part: np.empty((self.width, 0), dtype=np.int64)} | cut).items():
                    self._write(of, to, some)
        for part, new in self._dealt(rows, parts):
            old = self._read(of, part)
            now = merge(old, new)
            held += now.shape[1] - old.shape[1]
            self._write(of, part, now)
        self.sizes.updateValue((of,), (parts, held))


class ClickFilter(StatefulProcessor):
    """Keyed by user slot: the listed users, and per day the counts per user
    and ad, many users to a state entry (``Parts``).

    A user listed in an earlier micro-batch loses all clicks; any other keeps
    them, and is listed when a (day, ad) total passes ``threshold``, which the
    next micro-batch applies.  Gives a ``black`` row for a user when listed and
    the kept counts as ``stat`` (g: province, a: city, item: ad) and ``trend``
    rows (g: ad, item: minute of the day).  With ``ttl_ms`` a user's daily counts
    expire that long after their last change; the flag stays."""

    def __init__(self, threshold: int, only_list: bool = False, ttl_ms: int | None = None):
        self.threshold, self.only_list, self.ttl_ms = threshold, only_list, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.listed = Parts(handle, "listed", ["users"])
        self.daily = Parts(handle, "daily", ["users", "ads", "counts", *(["changed"] if self.ttl_ms else [])], self.ttl_ms)

    def _counted(self, date: str, mine: pd.DataFrame, ms: int) -> set[int]:
        """Adds to a day; the users among ``mine`` with a total over the
        threshold."""
        over = set()

        def merge(held: np.ndarray, new: np.ndarray) -> np.ndarray:
            if self.ttl_ms:
                held = held[:, held[3] + self.ttl_ms > ms]
            every = np.concatenate([held, new], axis=1)
            every = every[:, np.lexsort((every[1], every[0]))]
            starts = np.flatnonzero(np.append(True, (every[:2, 1:] != every[:2, :-1]).any(axis=0)))
            out = every[:, starts]
            out[2] = np.add.reduceat(every[2], starts)
            met = np.isin(out[0], new[0])
            if self.ttl_ms:
                out[3, met] = ms
            over.update(out[0, met & (out[2] > self.threshold)].tolist())
            return out

        columns = [mine["userid"], mine["adid"], mine["n"], *([np.full(len(mine), ms)] if self.ttl_ms else [])]
        self.daily.update(date, np.array(columns, dtype=np.int64), merge)
        return over

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now: set[int] = set()  # written at the end: they were not listed before this micro-batch
        ms = int(timerValues.getCurrentProcessingTimeInMs()) if self.ttl_ms else 0
        keys = ["userid", "date", "adid", *([] if self.only_list else ["province", "city", "minute"])]
        for part in _summed(rows, keys, "n"):
            was = self.listed.of_users("", part["userid"].unique().astype(np.int64))[0]
            part = part[~part["userid"].isin(was)]
            sums = part.groupby(["date", "userid", "adid"])["n"].sum().reset_index()
            for date, mine in sums.groupby("date"):
                now |= self._counted(date, mine, ms)
            if not self.only_list and len(part):
                stat = part.groupby(["date", "province", "city", "adid"])["n"].sum().reset_index()
                trend = part.groupby(["date", "adid", "minute"])["n"].sum().reset_index()
                for kind, of, g, a, item in (("stat", stat, stat["province"], stat["city"], stat["adid"]),
                                             ("trend", trend, trend["adid"].astype(str), "", trend["minute"])):
                    yield pd.DataFrame({"kind": kind, "date": of["date"], "g": g, "a": a, "item": item, "click_count": of["n"]})
        if now:
            self.listed.update("", np.array([sorted(now)], dtype=np.int64), lambda held, new: np.union1d(held, new)[None, :])
            yield _frame([("black", "", str(user), None, None, None) for user in sorted(now)])

    def close(self) -> None:
        pass


class RunningTotals(StatefulProcessor):
    """Keyed by group slot: running totals per (kind, date, g) and in it per
    (a, item), and for ``stat`` groups the ``top_n`` items of the group.

    Gives the totals that changed, as absolute numbers, and the whole top
    (``top`` rows) when it changed.  Totals only grow, so the new top lies in
    the old one and the items just touched: no scan of the group.  A state
    entry holds at most 2**BLOCK items.  Rows of other kinds pass.  With
    ``expire`` (event time), a day's entries go when the watermark has passed
    its end."""

    BLOCK = 11  # a day's minutes fit one entry

    def __init__(self, top_n: int, expire: bool = False):
        self.top_n, self.expire = top_n, expire

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getMapState("totals", "kind string, date string, g string, block bigint",
                                         "a array<string>, items array<bigint>, counts array<bigint>")
        self.top = handle.getMapState("top", "date string, g string", "items array<bigint>, counts array<bigint>")

    def _add(self, at: tuple, mine: pd.DataFrame) -> tuple[list[tuple], dict[int, int]]:
        """((a, item, total) of the touched, totals of their items over all a)."""
        held = self.totals.getValue(at)
        total = {(a, i): n for a, i, n in zip(*held)} if held else {}
        touched = list(zip(mine["a"].tolist(), mine["item"].tolist()))
        for k, n in zip(touched, mine["click_count"].tolist()):
            total[k] = total.get(k, 0) + int(n)
        self.totals.updateValue(at, ([a for a, _ in total], [i for _, i in total], list(total.values())))
        items = dict.fromkeys((i for _, i in touched), 0)
        if at[0] == "stat":
            for (_, i), n in total.items():
                if i in items:
                    items[i] += n
        return [(a, i, total[a, i]) for a, i in touched], items

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        others = []

        def counted() -> Iterator[pd.DataFrame]:
            for part in rows:
                mine = part["kind"].isin(["stat", "trend"])
                if not mine.all():
                    others.append(part[~mine][OUT])
                yield part[mine]

        found = list(_summed(counted(), ["kind", "date", "g", "a", "item"], "click_count", whole=True))
        yield from others
        if not found or not len(found[0]):
            return
        sums = found[0]
        sums = sums.astype({"item": "int64", "click_count": "int64"})  # floats where rows without them came along
        if self.expire:
            for date in sums["date"].unique():
                end = dt.datetime.strptime(date, "%Y%m%d").replace(tzinfo=dt.timezone.utc) + dt.timedelta(days=1)
                self.handle.registerTimer(int(end.timestamp() * 1000))
        out, best = [], {}
        for (kind, date, g, block), mine in sums.groupby(["kind", "date", "g", sums["item"] // (1 << self.BLOCK)]):
            changed, items = self._add((kind, date, g, int(block)), mine)
            out += [(kind, date, g, a, i, n) for a, i, n in changed]
            if kind == "stat" and self.top_n:
                best.setdefault((date, g), {}).update(items)
        for (date, g), items in best.items():
            held = self.top.getValue((date, g))
            before = list(zip(*held)) if held else []
            now = sorted({**dict(before), **items}.items(), key=lambda x: (-x[1], x[0]))[:self.top_n]
            if now != before:
                self.top.updateValue((date, g), ([i for i, _ in now], [n for _, n in now]))
                out += [("top", date, g, None, i, n) for i, n in now]
        yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ended = dt.datetime.fromtimestamp(expiredTimerInfo.getExpiryTimeInMs() / 1000, dt.timezone.utc) - dt.timedelta(days=1)
        date = ended.strftime("%Y%m%d")
        for state, at in ((self.totals, 1), (self.top, 0)):
            for k in [k for k in state.keys() if k[at] == date]:
                state.removeKey(k)
        yield from ()

    def close(self) -> None:
        pass


class SlidingTotals(StatefulProcessor):
    """Keyed by ad: clicks per minute, a day to an entry of the state.

    Gives the total of every window that holds a minute of this micro-batch
    (window starts in minutes since the epoch), late and open windows
    included: running sums over the stretches of days around the touched
    ones."""

    def __init__(self, window: int, slide: int, ttl_ms: int | None = None):
        self.window, self.slide, self.ttl_ms = window, slide, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getMapState("days", "day bigint", "n array<bigint>", self.ttl_ms)

    def _day(self, day: int) -> np.ndarray:
        held = self.days.getValue((day,))
        return np.array(held[0] if held else [0] * DAY, dtype=np.int64)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        sums = pd.concat([part[["minute", "n"]] for part in rows]).groupby("minute")["n"].sum()
        minutes, counts = sums.index.to_numpy(dtype=np.int64), sums.to_numpy(dtype=np.int64)
        reach = -(-self.window // DAY)
        touched = np.unique(minutes // DAY)
        near = np.unique(touched[:, None] + np.arange(-reach, reach + 1)).tolist()
        held = {d: self._day(d) for d in near}
        for m, n in zip(minutes.tolist(), counts.tolist()):
            held[m // DAY][m % DAY] += n
        for d in touched.tolist():
            self.days.updateValue((d,), (held[d].tolist(),))
        for run in np.split(np.array(near), np.flatnonzero(np.diff(near) > 1) + 1):
            first = int(run[0]) * DAY
            of = np.concatenate([held[d] for d in run.tolist()])
            new = np.zeros(len(of), dtype=np.int64)
            new[minutes[(minutes >= first) & (minutes < first + len(of))] - first] = 1
            starts = np.arange(-(-first // self.slide) * self.slide - first, len(of), self.slide)
            total, hit = (np.append(0, np.cumsum(x)) for x in (of, new))
            ends = np.minimum(starts + self.window, len(of))
            at = hit[ends] > hit[starts]
            yield pd.DataFrame({"start": first + starts[at], "adid": int(key[0]), "click_count": (total[ends] - total[starts])[at]})

    def close(self) -> None:
        pass
