"""Benchmark decontamination by Wu-Manber search over words.

Every window of an item (``window`` consecutive words, or the whole of a
shorter item) is a pattern.  Patterns of equal length m share one automaton:
a shift table over blocks of two words tells how far the search may skip, a
block that ends some pattern leads to a bucket of patterns by suffix hash,
and the bucket's patterns are compared word by word.  The documents are read
once per benchmark chunk; nothing is shuffled.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import BATCH, written

WINDOW = 13
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
CHUNK_BYTES = 32 << 20

# A-Z fall to a-z; every byte that is neither a letter, a digit nor part of a
# non-ASCII character separates words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class WuManber:
    """Search of equally long word patterns: {pattern tuple: owners}."""

    def __init__(self, patterns: dict[tuple[bytes, ...], tuple[int, ...]], m: int):
        self.m, self.block = m, min(2, m)
        self.skip: dict = {}
        self.buckets: dict = {}
        for pattern in patterns:
            for end in range(self.block, m + 1):
                key = pattern[end - self.block:end]
                self.skip[key] = min(self.skip.get(key, m), m - end)
            self.buckets.setdefault(pattern[-self.block:], {}).setdefault(pattern, patterns[pattern])
        self.most = m - self.block + 1

    def find(self, words: list[bytes]):
        """Yields (start, owners) of every occurrence."""
        m, block, most, skip, buckets = self.m, self.block, self.most, self.skip, self.buckets
        end, n = m, len(words)
        while end <= n:
            key = tuple(words[end - block:end])
            step = skip.get(key, most)
            if step:
                end += step
                continue
            owners = buckets[key].get(tuple(words[end - m:end]))
            if owners is not None:
                yield end - m, owners
            end += 1


def _patterns(items: list[tuple[int, str]], window: int) -> list[WuManber]:
    by_length: dict[int, dict[tuple[bytes, ...], set[int]]] = {}
    for owner, text in items:
        words = words_of(text)
        m = min(window, len(words))
        for at in range(len(words) - m + 1 if m else 0):
            by_length.setdefault(m, {}).setdefault(tuple(words[at:at + m]), set()).add(owner)
    return [WuManber({p: tuple(sorted(o)) for p, o in ps.items()}, m) for m, ps in sorted(by_length.items())]


def _chunks(benchmark: DataFrame, item_col: str, text_col: str, chunk_bytes: int):
    """Lists of (item as string, text) of at most ``chunk_bytes`` each (one
    longer item is its own chunk), fetched one partition at a time."""
    now, size = [], 0
    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text_col)).toLocalIterator()
    for item, text in rows:
        n = len(text or "") * 4
        if now and size + n > chunk_bytes:
            yield now
            now, size = [], 0
        now.append((item, text))
        size += n
    yield now


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def find_overlap(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES,
                 min_share: int = 20) -> DataFrame:
    """All columns of ``docs`` plus n_words, n_hit, n_items, items_sha256,
    hit_spans (merged [start, end) word ranges) and contaminated
    (n_hit > 0 and min_share * n_hit >= n_words).  New columns replace
    columns of the same name.

    Null text has no words and is clean; null or empty items match nothing;
    items of equal text are found together; null item ids count as 'null'.
    The benchmark goes to executors in chunks of at most ``chunk_bytes``;
    each further chunk is one more pass, stored between passes."""
    made = ["n_words", "n_hit", "n_items", "items_sha256", "hit_spans", "contaminated"]
    own = [c for c in docs.columns if c not in made]
    df = docs.select(*own).withColumn("_spans", F.lit(None).cast("array<struct<start:bigint,end:bigint>>")).withColumn(
        "_items", F.lit(None).cast("array<string>")).withColumn("_n", F.lit(0).cast("long"))
    first = True
    for items in _chunks(benchmark, item_col, item_text_col, chunk_bytes):
        df = _search(df if first else written(df, "overlap", BATCH), docs.sparkSession, items, text_col, window)
        first = False
    df = df.withColumnRenamed("_spans", "hit_spans")
    return df.select(*own, F.col("_n").alias("n_words"),
                     F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_hit"),
                     F.size("_items").cast("long").alias("n_items"),
                     F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
                     "hit_spans").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (min_share * F.col("n_hit") >= F.col("n_words")))


def _search(df: DataFrame, spark, items: list[tuple[str, str]], text_col: str, window: int) -> DataFrame:
    names = [("null" if i is None else i) for i, _ in items]
    sent = spark.sparkContext.broadcast(items)
    at_text, at_spans, at_items, at_n = (df.columns.index(c) for c in (text_col, "_spans", "_items", "_n"))

    def run(batches):
        finders = None
        for batch in batches:
            if finders is None:
                finders = _patterns([(k, t) for k, (_, t) in enumerate(sent.value)], window)
            spans_out, items_out, n_out = [], [], []
            old_spans, old_items = batch.column(at_spans).to_pylist(), batch.column(at_items).to_pylist()
            for row, text in enumerate(batch.column(at_text)):
                words = words_of(text.as_py())
                hits, found = [], set()
                for f in finders:
                    for start, owners in f.find(words):
                        hits.append((start, start + f.m))
                        found.update(owners)
                hits.extend((s["start"], s["end"]) for s in old_spans[row] or [])
                spans_out.append([{"start": s, "end": e} for s, e in _merge(hits)])
                items_out.append(sorted({names[k] for k in found} | set(old_items[row] or [])))
                n_out.append(len(words))
            cols = [*batch.columns]
            cols[at_spans] = pa.array(spans_out, type=_SPANS)
            cols[at_items] = pa.array(items_out, type=pa.list_(pa.string()))
            cols[at_n] = pa.array(n_out, type=pa.int64())
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    return df.mapInArrow(run, df.schema)


def items_digest(items: list[str]) -> str:
    """items_sha256 of a list of item ids (for tests and callers)."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
