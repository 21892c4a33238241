"""Best-fit packing through the configuration linear program.

Documents become pieces (a document over the capacity is cut into full
pieces; its first piece may be shorter).  Only the histogram of piece lengths,
at most ``capacity`` numbers whatever the corpus, goes to the driver.  There
the covering program  min sum x_p,  sum_p a_lp x_p >= n_l  over fill patterns
p is solved by multiplicative weights: uncovered lengths gain price, a
knapsack dynamic program over the capacity finds the patterns of most price,
and each is raised by a small step.  Rounding takes whole copies of a share of them; a
best-fit pass over the remaining counts fills what is left, and the share that
gives the fewest sequences is taken.
The solution is a list of (pattern, copies) whose length depends on the
capacity and the rounds only.  Pieces get their places by rank among the
pieces of equal length, so all row work stays on the executors.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import BATCH, gapless_rank, written
from shopflow.llm.tokens import chunk_tokenizer, default_tokenizer_path

CAPACITY = 2048
CACHE = 500_000
EPS = 0.3
ROUNDS = 60
NOISE = 1e-5
SHARES = (1, 1 / 2, 1 / 4, 1 / 8, 0)


def knapsack(prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack over lengths 1..capacity (``prices[l-1]``): best
    price per capacity and the length taken there (0: leave one unit)."""
    best = np.zeros(capacity + 1)
    take = np.zeros(capacity + 1, dtype=np.int64)
    lens = np.flatnonzero(prices > 0) + 1
    price = prices[lens - 1]
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        k = np.searchsorted(lens, c, side="right")
        if k:
            value = best[c - lens[:k]] + price[:k]
            j = k - 1 - int(value[::-1].argmax())  # of equal prices the longest
            if value[j] > best[c]:
                best[c], take[c] = value[j], lens[j]
    return best, take


def _pattern(take: np.ndarray, c: int) -> list[int]:
    out = []
    while c > 0:
        if take[c]:
            out.append(int(take[c]))
            c -= int(take[c])
        else:
            c -= 1
    return out


def fractional_patterns(counts: np.ndarray, capacity: int, eps: float = EPS,
                        rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Multiplicative weights for the covering program.  Every round prices
    the lengths by length * exp(-cover / eps) (tokens weigh alike at first; a
    little fixed-seed noise breaks ties another way each time), and
    raises the best pattern through each uncovered length whose price is near
    the best, in order of price; no length gains more than ``eps`` of its
    demand a round."""
    need = counts.astype(float)
    noise = np.random.default_rng(0)
    cover = np.zeros(capacity)
    x: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        open_ = (need > 0) & (cover < 1)
        if not open_.any():
            break
        prices = np.zeros(capacity)
        prices[open_] = (np.flatnonzero(open_) + 1) * np.exp(-(cover[open_] - cover[open_].min()) / eps)
        prices[open_] *= 1 + NOISE * noise.random(int(open_.sum()))
        best, take = knapsack(prices, capacity)
        lens = np.flatnonzero(open_) + 1
        value = prices[lens - 1] + best[capacity - lens]
        gained = np.zeros(capacity)
        for j in np.lexsort((-lens, -value)):
            length = int(lens[j])
            if gained[length - 1] >= eps:
                continue
            pattern = tuple(sorted([length, *_pattern(take, capacity - length)], reverse=True))
            ls, a = np.unique(pattern, return_counts=True)
            room = (eps - gained[ls - 1]) * need[ls - 1] / a
            step = float(room.min())
            if step <= 0 or value[j] < value.max() * (1 - eps):
                continue
            x[pattern] = x.get(pattern, 0.0) + step
            gained[ls - 1] += a * step / need[ls - 1]
        cover += gained
    return x


def _best_fit(bins: list[tuple[tuple[int, ...], int]], left: np.ndarray, capacity: int):
    """Best fit, longest first, on counts: equal bins move together."""
    space: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    has = np.zeros(capacity + 1, dtype=bool)
    for pattern, n in bins:
        free = capacity - sum(pattern)
        space[free].append((pattern, n))
        has[free] = True
    for length in range(capacity, 0, -1):
        n = int(left[length - 1])
        while n > 0:
            at = int(has[length:].argmax()) + length
            if has[at]:
                pattern, c = space[at].pop()
                k = min(n, c)
                if c > k:
                    space[at].append((pattern, c - k))
                has[at] = bool(space[at])
                space[at - length].append(((*pattern, length), k))
                has[at - length] = True
                n -= k
                continue
            per = capacity // length
            if n // per:
                space[capacity - per * length].append(((length,) * per, n // per))
                has[capacity - per * length] = True
            if n % per:
                space[capacity - (n % per) * length].append(((length,) * (n % per), 1))
                has[capacity - (n % per) * length] = True
            n = 0
    return [group for at in space for group in at]


def _rounded(x: dict[tuple[int, ...], float], counts: np.ndarray, capacity: int, share: float) -> list[tuple[tuple[int, ...], int]]:
    """``share`` of the program's copies of the patterns that fill a sequence,
    whole ones; at the full share then one more each while their lengths last.
    Best fit places the rest."""
    left = counts.astype(np.int64).copy()
    bins: dict[tuple[int, ...], int] = {}
    for up in (False, True) if share == 1 else (False,):
        for pattern in sorted(x, key=lambda p: (-sum(p), -x[p], p)):
            if capacity - sum(pattern) > 1:
                continue
            want = int(np.ceil(x[pattern])) if up else int(share * x[pattern])
            if want <= 0:
                continue
            ls, a = np.unique(pattern, return_counts=True)
            n = min(want, int((left[ls - 1] // a).min()))
            if n > 0:
                bins[pattern] = bins.get(pattern, 0) + n
                left[ls - 1] -= n * a
    return _best_fit(list(bins.items()), left, capacity)


def configurations(counts: np.ndarray, capacity: int, eps: float = EPS,
                   rounds: int = ROUNDS) -> list[tuple[tuple[int, ...], int]]:
    """[(pattern of lengths, copies)] holding every length ``counts`` times:
    the program's solution rounded at each of SHARES, of which the fewest
    sequences win, at a tie those with most of the program in them."""
    x = fractional_patterns(counts, capacity, eps, rounds)
    return min((_rounded(x, counts, capacity, share) for share in SHARES), key=lambda bins: sum(n for _, n in bins))


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
              tokenizer_path: str | None = None, end_id: int = 0, with_ids: bool = False, cache: int = CACHE) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 (and ``ids``,
    little-endian uint32 bytes, when ``with_ids``).  A null text is empty; an
    empty text is its end id.  Repeated rows are packed one by one.  A worker
    knows at most ``cache`` words by heart."""
    path = tokenizer_path or default_tokenizer_path()
    end = np.uint32(end_id).tobytes()
    schema = f"{id_col} long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def cut(batches):
        tok = chunk_tokenizer(path, cache)
        for batch in (b.slice(lo, 512) for b in batches for lo in range(0, b.num_rows, 512)):
            rows: list[tuple] = []
            for doc, data in zip(batch.column(0).to_pylist(), tok.encode_many([t or "" for t in batch.column(1).to_pylist()])):
                data += end
                n = len(data) // 4
                at = 0
                for piece in range(-(-n // capacity)):
                    to = n - (-(-n // capacity) - 1 - piece) * capacity
                    part = data[4 * at:4 * to]
                    rows.append((doc, piece, at, to - at, zlib.crc32(part), *((part,) if with_ids else ())))
                    at = to
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = [id_col, "piece", "start", "length", "ids_crc32", "ids"]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds)], names=names[:len(cols)])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
         tokenizer_path: str | None = None, end_id: int = 0, with_ids: bool = False,
         eps: float = EPS, rounds: int = ROUNDS, cache: int = CACHE) -> DataFrame:
    """Pieces with ``sequence_id`` (long, unique per sequence; a full piece
    has a negative one of its own) and ``offset`` (gapless from 0).  An empty
    input gives no rows; other columns of ``docs`` are not read."""
    pieces = written(pieces_of(docs, capacity, id_col, text_col, tokenizer_path, end_id, with_ids, cache), "pieces", BATCH)
    cols = pieces.columns
    hist = pieces.filter(F.col("length") < capacity).groupBy("length").count().collect()
    counts = np.zeros(capacity, dtype=np.int64)
    for row in hist:
        counts[row["length"] - 1] = row["count"]
    full = (pieces.filter(F.col("length") >= capacity)
            .withColumn("sequence_id", -1 - F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))
    slots = []
    seen = np.zeros(capacity, dtype=np.int64)
    base = 0
    for pattern, copies in configurations(counts, capacity, eps, rounds):
        at = 0
        for length in pattern:
            slots.append((length, int(seen[length - 1]), base, at))
            seen[length - 1] += copies
            at += length
        base += copies
    slots.sort()
    lens, firsts, bases, offs = (np.array(c, dtype=np.int64) for c in (zip(*slots) if slots else ([],) * 4))
    shift = 40  # ranks below 2**40
    places = docs.sparkSession.sparkContext.broadcast(((lens << shift) + firsts, firsts, bases, offs))
    short = gapless_rank(pieces.filter(F.col("length") < capacity), "length", [id_col, "piece", "start"],
                         int(counts.sum()), "_rank_of_length")

    def place(batches):
        keys, first, base_, off = places.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rank = batch.column("_rank_of_length").to_numpy()
            j = np.searchsorted(keys, (batch.column("length").to_numpy() << shift) + rank, side="right") - 1
            arrays = [batch.column(c) for c in cols]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(base_[j] + rank - first[j]), pa.array(off[j])],
                                             names=[*cols, "sequence_id", "offset"])

    placed = short.mapInArrow(place, full.schema)
    return placed.unionByName(full)
