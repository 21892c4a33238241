"""Near-duplicate documents by circulant MinHash.

A first permutation scatters the shingles, a second one, applied after a
circular shift by k, gives signature coordinate k: two permutations make all
BANDS * ROWS coordinates.  Equal coordinates of a band make documents
candidates.  Documents with equal shingle sets form one class before banding,
so a large group of copies costs one row per band.  Inside a bucket every
class is checked against the smallest one; buckets whose classes are then
still in different components are checked in full, small ones pair by pair,
larger ones in blocks of at most CHUNK sets, out of which only the links'
spanning edges come.  A link needs the exact Jaccard similarity of the full
sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import BATCH, blocks, runs, written
from shopflow.llm.components import components

BANDS, ROWS = 40, 6
BLOCK = 1 << 15
PAIRS_UP_TO = 8
CHUNK = 1024
WORDS = 100_000
#: Up to so many rows (16 bytes each) go to every executor; more are joined by shuffle.
BROADCAST_ROWS = 500_000
_M1, _M2 = np.uint32(0x7FEB352D), np.uint32(0x846CA68B)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)

# A-Z fall to a-z; words are runs without ASCII white space.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class WordHash(dict):
    """64-bit hashes of words, kept for words met before."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int, known: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles; a shorter
    text is one shingle, one without words has none."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(known) > WORDS:
        known.clear()
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    k = min(size, len(words))
    out = h[:len(h) - k + 1].copy()
    for i in range(1, k):
        out = out * _STEP + h[i:len(h) - k + 1 + i]
    return np.unique(_mix64(out + np.uint64(k)))


def signatures(flat: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """(coordinates, documents) minima; document j owns ``flat[starts[j]:
    starts[j + 1]]`` (none empty), already scattered by the first permutation
    of 32-bit numbers."""
    sig = np.full((coordinates, len(starts) - 1), 0xFFFFFFFF, dtype=np.uint32)
    for lo in range(0, len(flat), BLOCK):
        x = flat[lo:lo + BLOCK]
        first = int(np.searchsorted(starts, lo, side="right")) - 1
        last = int(np.searchsorted(starts, lo + len(x), side="left"))
        cuts = np.maximum(starts[first:last], lo) - lo
        v, t = np.empty_like(x), np.empty_like(x)
        for k in range(coordinates):
            np.add(x, np.uint32(k), out=v)  # the circular shift, modulo 2**32
            np.right_shift(v, 16, out=t)
            np.bitwise_xor(v, t, out=v)
            np.multiply(v, _M1, out=v)
            np.right_shift(v, 15, out=t)
            np.bitwise_xor(v, t, out=v)
            np.multiply(v, _M2, out=v)
            np.right_shift(v, 16, out=t)
            np.bitwise_xor(v, t, out=v)
            row = sig[k, first:last]
            np.minimum(row, np.minimum.reduceat(v, cuts), out=row)
    return sig


def band_keys(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """(documents, bands) 64-bit keys, the band's number mixed in."""
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    flat = (np.concatenate(sets) * _STEP >> np.uint64(32)).astype(np.uint32)
    sig = signatures(flat, starts, bands * rows).astype(np.uint64)
    keys = np.empty((len(sets), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(sets), b + 1, dtype=np.uint64)
        for r in range(rows):
            key = _mix64(key * _STEP + sig[b * rows + r])
        keys[:, b] = key
    return keys.view(np.int64)


def _fingerprints(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    def run(batches):
        known = WordHash()
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                sets = [shingle_set(t.as_py(), shingle, known) for t in part.column(1)]
                full = [s for s in sets if len(s)]
                keys = iter(band_keys(full, bands, rows)) if full else iter(())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), *part.columns[2:],
                    pa.array([len(s) for s in sets], type=pa.int64()),
                    pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], type=pa.binary()),
                    pa.array([next(keys) if len(s) else None for s in sets], type=pa.list_(pa.int64())),
                ], names=["doc_id", *carried, "n_shingles", "digest", "keys"])

    carried = [c for c in docs.columns if c not in ("doc_id", "text")]
    kinds = dict(docs.dtypes)
    return docs.select("doc_id", "text", *carried).mapInArrow(
        run, "doc_id long, " + "".join(f"{c} {kinds[c]}, " for c in carried) + "n_shingles long, digest binary, keys array<long>")


def _few(rows: DataFrame) -> bool:
    return rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _sets_of(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(cid, set) of the wanted classes (cid, rep, digest), a stored table: the
    text of each class's smallest document is read again.  Their ids go to the
    texts where they are few enough; no text is shuffled then."""
    def run(batches):
        known = WordHash()
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                sets = [shingle_set(t.as_py(), shingle, known).tobytes() for t in batch.column(0).slice(lo, 1024)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([hashlib.md5(s).digest() for s in sets], type=pa.binary()), pa.array(sets, type=pa.binary())],
                    names=["digest", "set"])

    reps = wanted.select("rep").distinct()
    texts = docs.join(F.broadcast(reps) if _few(reps) else reps, docs["doc_id"].eqNullSafe(F.col("rep")), "left_semi")
    return (texts.select("text").mapInArrow(run, "digest binary, set binary")
            .join(wanted.select("cid", "digest"), "digest").select("cid", "set").dropDuplicates(["cid"]))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * |a & b| >= percent * |a | b|."""
    size = lambda c: F.octet_length(c) / 8
    both = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("set").alias("set_a")), "a")
            .filter((100 * F.least(F.col("n_b"), size("set_a"))) >= percent * F.greatest(F.col("n_b"), size("set_a")))
            .join(sets.select(F.col("cid").alias("b"), F.col("set").alias("set_b")), "b")
            .select("a", "b", "set_a", "set_b"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                inter = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * inter >= percent * (len(x) + len(y) - inter))
            mask = pa.array(keep, type=pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of all pairwise intersections."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    held = np.diff(np.concatenate([starts, [len(values)]]))  # documents per shingle
    out = np.zeros(m * m, dtype=np.float32)
    for p in range(2, 9):
        at = starts[held == p]
        a, b = np.triu_indices(p, 1)
        for lo in range(0, len(at), 1 << 16):
            docs = owner[at[lo:lo + (1 << 16), None] + np.arange(p)]
            out += np.bincount((docs[:, a] * m + docs[:, b]).ravel(), minlength=m * m).astype(np.float32)
    out = out.reshape(m, m)
    often = np.flatnonzero(held > 8)
    for lo in range(0, len(often), 4096):
        some = often[lo:lo + 4096]
        rows = np.concatenate([owner[starts[k]:starts[k] + held[k]] for k in some])
        x = np.zeros((m, len(some)), dtype=np.float32)
        x[rows, np.repeat(np.arange(len(some)), held[some])] = 1
        out += np.triu(x @ x.T, 1)
    return out + out.T


def _spanning(sets: list[np.ndarray], parts: np.ndarray, i: int, j: int, percent: int) -> np.ndarray:
    """For every set of a block the smallest index that it is connected to by
    links of the block (within part i, or between parts i and j)."""
    n = np.array([len(s) for s in sets], dtype=np.float32)
    inter = shared_counts(sets)
    link = 100 * inter >= percent * (n[:, None] + n[None, :] - inter)
    if i != j:
        link &= parts[:, None] != parts[None, :]
    np.fill_diagonal(link, True)
    label = np.arange(len(sets))
    while True:
        new = np.where(link, label[None, :], len(sets)).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _linked_in_blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Spanning edges (a, b) of the links among the members (key, cid) of each
    key, compared in blocks."""
    rows = (blocks(members, ["key"], "cid", CHUNK).join(sets, "cid")
            .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))

    def run(batches):
        for table in runs(batches, ["key", "i", "j"]):
            held = [np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in table.column("set")]
            cids = table.column("cid").to_numpy()
            label = _spanning(held, table.column("part").to_numpy(), table.column("i")[0].as_py(), table.column("j")[0].as_py(), percent)
            off = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([pa.array(cids[label[off]]), pa.array(cids[off])], names=["a", "b"])

    return rows.select("key", "i", "j", "part", "cid", "set").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs`` (doc_id,
    text; other columns are not read).

    Links join documents whose shingle sets have a Jaccard similarity of
    ``percent`` / 100 at least; component_id is the smallest doc_id reachable.
    A text without words (or null) is linked with nothing.  A null doc_id
    links like any other but names a component only where no id is known;
    kept is null there.  Rows that repeat a doc_id are rows of their own.
    With the default bands a pair at 0.8 is missed with a chance of 5e-6."""
    return (_judged(docs.select("doc_id", "text"), shingle, percent, bands, rows).select("doc_id", "n_shingles", "component_id")
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))


def _judged(docs: DataFrame, shingle: int, percent: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component, component_id) per row of ``docs``
    (doc_id, text) and what else it holds: component numbers the components,
    null for texts without words."""
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    carried = [c for c in docs.columns if c not in ("doc_id", "text")]
    prints = written(_fingerprints(docs, shingle, bands, rows), "prints", BATCH)
    classes = written(prints.filter("n_shingles > 0").groupBy("digest")
                      .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"))
                      .withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = classes.select("cid", "n", F.explode("keys").alias("key"))
    pivots = members.groupBy("key").agg(F.min("cid").alias("pivot"), F.count("*").alias("c")).filter("c > 1")
    buckets = written(members.join(pivots, "key"), "buckets")
    named = classes.select("cid", "rep", "digest")
    star = written(buckets.filter("cid <> pivot").select(F.col("pivot").alias("a"), F.col("cid").alias("b"),
                                                         F.col("n").alias("n_b")).distinct(), "star")
    every = buckets.select("cid").distinct()
    wanted = written(named.join(every, "cid"), "wanted")
    sets = written(_sets_of(docs, wanted, shingle), "sets", BATCH)
    links = written(_linked(star, sets, percent), "links", BATCH)
    labels = components(links)
    open_ = (buckets.filter("c > 2").join(labels.withColumnRenamed("id", "cid"), "cid", "left")
             .withColumn("component", F.coalesce("component", "cid")))
    mixed = open_.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    open_ = written(open_.join(mixed.select("key"), "key", "left_semi").select("key", "c", "cid", "n", "component"), "open")
    few = open_.filter(F.col("c") <= PAIRS_UP_TO)
    left = few.select("key", F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("comp_a"))
    right = few.select("key", F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("comp_b"))
    cross = (left.join(right, "key")
             .filter((F.col("comp_a") < F.col("comp_b"))
                     & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")))
             .select("a", "b", "n_b").distinct()
             .join(star.select("a", "b"), ["a", "b"], "left_anti"))
    many = open_.filter(F.col("c") > PAIRS_UP_TO).select("key", "cid")
    more = written(_linked(cross, sets, percent).unionByName(_linked_in_blocks(many, sets, percent)), "links", BATCH)
    labels = components(links.unionByName(more)) if not more.isEmpty() else labels
    joined = (named.join(labels, labels["id"] == named["cid"], "left")
              .select("digest", "rep", F.coalesce("component", "cid").alias("component")))
    lowest = joined.groupBy("component").agg(F.min("rep").alias("low"))
    of = joined.join(lowest, "component").select("digest", "component", F.col("low").alias("component_id"))
    return (prints.select("doc_id", *carried, "n_shingles", "digest").join(of, "digest", "left")
            .select("doc_id", *carried, "n_shingles", "component", F.when(F.col("n_shingles") > 0, F.col("component_id"))
                    .otherwise(F.col("doc_id")).alias("component_id")))


_PLACE = ("_shopflow_file", "_shopflow_row")


def _placed(docs: DataFrame) -> DataFrame:
    """``docs`` with each row's place in its files, which names it whenever the
    files are read; a frame that is no plain file scan is stored first."""
    def place(df):
        return df.select("*", F.xxhash64("_metadata.file_path").alias(_PLACE[0]), F.col("_metadata.row_index").alias(_PLACE[1]))

    try:
        return place(docs)
    except AnalysisException:
        return place(written(docs, "documents"))


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with exactly one row of each group of near-duplicates, with all
    its columns, whatever their names: the one with the smallest doc_id (a row
    without an id only where no id is known), of rows that repeat this id the
    one with the smallest text digest, of equal rows any.  Rows without words
    all stay; texts of any length are compared whole; an empty table stays one.

    Rows are told apart by their place in the stored files: only places, no
    texts, travel to decide which rows go."""
    placed = _placed(docs)
    narrow = placed.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"),
                           F.col(_PLACE[0]).alias("f"), F.col(_PLACE[1]).alias("i"))
    same = written(_judged(narrow, shingle, percent).filter("n_shingles > 0")
                   .select("component", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie", "f", "i").alias("at")), "groups")
    first = same.groupBy("component").agg(F.min("at").alias("first"))
    gone = written(same.join(first, "component").filter("at <> first")
                   .select(F.col("at.f").alias(_PLACE[0]), F.col("at.i").alias(_PLACE[1])), "gone")
    return placed.join(F.broadcast(gone) if _few(gone) else gone, list(_PLACE), "left_anti").select(*docs.columns)
