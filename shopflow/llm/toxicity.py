"""Toxicity of whole texts by a weighted lexicon.

Texts are folded (case, accents, homoglyphs, zero-width characters, digit and
sign substitutions), so that disguised spellings meet the plain entry.  An
Aho-Corasick automaton finds all entries in one pass; hits inside an exception
phrase do not count.  The sum of the weights, divided by 1 + log10(1 + words),
is calibrated into a score between 0 and 1.

Entries and weights are learned from labelled rows: a word, or the beginning
of words (4 to 8 letters), enters when its documents are mostly labelled
toxic; its weight is the log ratio of its document frequencies.  A few seed
words join with a set weight where the labelled rows do not show them.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import BATCH, batches_of, written
from shopflow.llm.minhash import WordHash, shingle_set

SAMPLE_ROWS = 20_000
SAME_PERCENT = 80
FOLDS = 4
MIN_WEIGHT = 3.0
MIN_SHARE = 0.01
LEAST = 5
THRESHOLD = 0.3
PREFIXES = (4, 5, 6, 7, 8)
BIN = 0.05
BINS = 800

# Seed words, their weight, and phrases in which an entry is harmless.
SEED_WEIGHT = 3.0
SEED_WORDS = ("asshole", "bastard", "clown", "cretin", "disgusting", "dumbass", "fool", "idiot", "imbecile", "jerk",
              "loser", "moron", "pathetic", "retard", "scum", "scumbag", "stupid", "trash", "vermin", "worthless")
EXCEPTIONS = ("class clown", "clown fish", "pond scum", "soap scum", "sore loser award", "trash bag", "trash bin",
              "trash can", "trash collection")

# Characters that look like a Latin letter.
_LOOK_ALIKE = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ո": "n", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ß": "s",
}
# Digits and signs that stand for a letter; l falls to i, since 1 and ! stand for either.
_STAND_IN = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "l": "i"}
_ZERO_WIDTH = (0xAD, 0x200B, 0x200C, 0x200D, 0x200E, 0x200F, 0x2060, 0xFEFF)


class _Folding(dict):
    """Code point to folded text; punctuation, symbols and separators that are
    not in the table are spaces, other characters stay."""

    def __missing__(self, cp: int) -> str:
        self[cp] = to = " " if unicodedata.category(chr(cp))[0] in "PSZ" else chr(cp)
        return to


def _fold_table() -> _Folding:
    table = _Folding()
    for cp in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(cp)) if not unicodedata.combining(c)).lower()
        if base.isascii() and (base.isalnum() or base in _STAND_IN):
            table[cp] = base
    table.update((cp, None) for cp in range(0x300, 0x370))
    for c, to in _LOOK_ALIKE.items():
        table[ord(c)] = to
    for c, to in _STAND_IN.items():
        table[ord(c)] = to
    for cp, to in list(table.items()):
        if to:
            table[cp] = "".join(_STAND_IN.get(c, c) for c in to)
    table.update((cp, None) for cp in _ZERO_WIDTH)
    table.update((cp, " ") for cp in range(128) if not chr(cp).isalnum() and cp not in table)
    return table


_TABLE = _fold_table()
_ASCII = bytes(ord(_TABLE[b]) if b in _TABLE else b for b in range(128)) + bytes(range(128, 256))
_BANG = re.compile(r"(?<=\w)!(?=\w)")


def fold(text: str | None) -> str:
    """Folded text: words of lower-case letters and digits between spaces."""
    low = (text or "").lower()
    if "!" in low:
        low = _BANG.sub("i", low)
    if low.isascii():
        return low.encode("ascii").translate(_ASCII).decode("ascii")
    return low.translate(_TABLE)


def _terms(words: set[str]) -> set[str]:
    """Candidates of one document: whole words (" w ") and beginnings (" p")."""
    out = {f" {w} " for w in words if len(w) >= 3}
    for n in PREFIXES:
        out.update(f" {w[:n]}" for w in words if len(w) > n)
    return out


def _seeds() -> dict[str, float]:
    return {f" {fold(w)} ": SEED_WEIGHT for w in SEED_WORDS}


def _counted(sample: DataFrame) -> DataFrame:
    """(term, toxic, clean, toxic_k, clean_k): documents of the sample (text,
    toxic, part) that hold each term, in all and by part k; the empty term
    counts all of them.  One pass over the texts; terms too rare to enter a
    lexicon are left out."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):  # few texts at a time: their terms are many
                some = batch.slice(lo, 500)
                found: dict[tuple, Counter] = {}
                for text, toxic, part in zip(some.column(0), some.column(1).to_pylist(), some.column(2).to_pylist()):
                    to = found.setdefault((part, bool(toxic)), Counter())
                    to[""] += 1
                    to.update(_terms(set(fold(text.as_py()).split())))
                for (part, toxic), terms in found.items():
                    n = len(terms)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(terms), type=pa.string()), pa.array([part] * n, type=pa.int32()), pa.array([toxic] * n, type=pa.bool_()),
                         pa.array(list(terms.values()), type=pa.int64())], names=["term", "part", "toxic", "n"])

    rows = sample.select("text", "toxic", "part").mapInArrow(run, "term string, part int, toxic boolean, n long")
    of = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    sums = [of(F.col("toxic")).alias("toxic"), of(~F.col("toxic")).alias("clean")]
    for k in range(FOLDS):
        mine = F.col("part") == k
        sums += [of(F.col("toxic") & mine).alias(f"toxic_{k}"), of(~F.col("toxic") & mine).alias(f"clean_{k}")]
    return rows.groupBy("term").agg(*sums).filter((F.col("toxic") >= LEAST) | F.col("term").isin("", *_seeds()))


def _lexicon(counts: DataFrame) -> dict[str, float]:
    total = counts.filter("term = ''").first()
    n_bad, n_good = (total["toxic"], total["clean"]) if total else (0, 0)
    seeds = _seeds()
    if not n_bad or not n_good:
        return seeds
    weight = (F.log((F.col("toxic") + 0.5) / (n_bad + 1)) - F.log((F.col("clean") + 0.5) / (n_good + 1)))
    rows = (counts.filter("term <> ''").withColumn("weight", weight)
            .filter((F.col("toxic") >= max(LEAST, MIN_SHARE * n_bad)) & (F.col("weight") >= MIN_WEIGHT))
            .collect())  # each in a share of the toxic rows of a bounded sample
    shown = {r["term"] for r in counts.filter(F.col("term").isin(list(seeds)) & (F.col("toxic") + F.col("clean") >= LEAST)).collect()}
    entries: dict[str, float] = {t: w for t, w in seeds.items() if t not in shown}
    taken: dict[str, tuple[int, float]] = {}
    for r in sorted(rows, key=lambda r: (len(r["term"].rstrip()), r["term"])):
        term = r["term"]
        shorter = [taken[p] for n in PREFIXES if (p := term[:n + 1]) in taken and len(p) < len(term)]
        if any(w >= r["weight"] - 0.5 for _, w in shorter):
            continue  # its beginning says as much
        taken[term] = (r["toxic"], r["weight"])
    entries.update((t, w) for t, (_, w) in taken.items())
    return entries


def _automaton(entries: dict[str, float]):
    import ahocorasick
    found = ahocorasick.Automaton()
    for phrase in EXCEPTIONS:
        found.add_word(f" {' '.join(fold(phrase).split())} ", None)
    for term, weight in entries.items():
        found.add_word(term, (len(term), weight))
    found.make_automaton()
    return found


def _raw(text: str | None, found) -> tuple[float, int, int]:
    """(normalised weight, hits, words) of one text."""
    words = fold(text).split()
    line = f" {' '.join(words)} "
    hits, harmless = [], []
    for end, value in found.iter(line):
        if value is None:
            harmless.append(end)
        else:
            hits.append((end, *value))
    if harmless:
        spans = [(line.rfind(f" {' '.join(fold(p).split())} ", 0, e + 1), e) for e in harmless for p in EXCEPTIONS
                 if line.endswith(f" {' '.join(fold(p).split())} ", 0, e + 1)]
        hits = [h for h in hits if not any(s <= h[0] - h[1] + 1 and h[0] <= e for s, e in spans)]
    return sum(w for _, _, w in hits) / (1 + math.log10(1 + len(words))), len(hits), len(words)


def _rising(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Share of bad per bin, made non-decreasing by pooling adjacent bins."""
    blocks: list[list[float]] = []
    for i in range(len(good)):
        blocks.append([bad[i], good[i] + bad[i], 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            b = blocks.pop()
            blocks[-1] = [blocks[-1][0] + b[0], blocks[-1][1] + b[1], blocks[-1][2] + b[2]]
    return np.concatenate([np.full(int(n), b / t if t else 0.0) for b, t, n in blocks])


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[dict[str, float], np.ndarray]:
    """(entries, score per bin of the normalised weight) from at most
    ``sample_rows`` labelled rows outside the held-out quarter (crc32 of the
    doc_id as text, modulo 4, is 2).  Which rows: those of smallest hash of
    the id.  Of copies and near copies (five-word runs, SAME_PERCENT, compared
    on full sets) with the same label one row counts, with its own text, lest
    the chance words of a much-copied text become entries.  Null ids and
    labels are ignored; of conflicting labels of one id toxic wins.  The weights
    come from all of them; they are graded in FOLDS parts, by hash of the id,
    each under the weights that the other parts give."""
    ids = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    labelled = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select(
        F.col("doc_id").cast("long"), "text", F.col("toxic").cast("int"))
    distinct = written(_distinct(labelled), "labelled", BATCH)
    rows = distinct.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(FOLDS)).cast("int"))
    counts = written(_counted(rows), "terms", BATCH)
    entries = _lexicon(counts)
    hist = []
    for k in range(FOLDS):
        others = _lexicon(counts.select("term", (F.col("toxic") - F.col(f"toxic_{k}")).alias("toxic"), (F.col("clean") - F.col(f"clean_{k}")).alias("clean")))
        with batches_of(docs.sparkSession, BATCH):
            hist += (_scored(rows.filter(F.col("part") == k), others, None, keep=("toxic",))
                     .groupBy(F.least(F.floor(F.col("raw") / BIN), F.lit(BINS - 1)).alias("bin"), "toxic").count().collect())
    good, bad = np.zeros(BINS), np.zeros(BINS)
    for r in hist:
        (bad if r["toxic"] else good)[int(r["bin"])] += r["count"]
    if not bad.sum() or not good.sum():
        return entries, 1 - np.exp(-BIN * (np.arange(BINS) + 0.5))
    share = _rising(good, bad)
    # a little of the raw order inside pooled bins, so that ties are few
    return entries, np.clip(0.98 * share + 0.02 * (1 - np.exp(-BIN * np.arange(BINS))), 0.0, 1.0)


def _distinct(labelled: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) without near copies that carry the same label.

    Rows are grouped by label and the smallest hash of their five-word runs
    under two orders, which near copies mostly share; in a group a row goes if
    its full set is near that of a row kept before it.  Groups are parts of
    the bounded sample."""
    def lead(batches):
        known = WordHash()
        for batch in batches:
            sets = [shingle_set(t.as_py(), 5, known) for t in batch.column(1)]
            of = [[int(s[0]) >> 1, int((s * np.uint64(0x9E3779B97F4A7C15)).min()) >> 1] if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of, type=pa.list_(pa.int64()))], names=["doc_id", "text", "toxic", "lead"])

    def keep(batches):
        known = WordHash()
        group, kept = None, []
        for batch in batches:
            stays = []
            for text, toxic, of in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                mine = shingle_set(text.as_py(), 5, known)
                if (toxic, of) != group:
                    group, kept = (toxic, of), []
                near = False
                for other in kept:
                    if 100 * min(len(mine), len(other)) >= SAME_PERCENT * max(len(mine), len(other)):
                        both = len(np.intersect1d(mine, other, assume_unique=True))
                        if 100 * both >= SAME_PERCENT * (len(mine) + len(other) - both):
                            near = True
                            break
                if not near:
                    kept.append(mine)
                stays.append(not near)
            yield batch.select([0, 1, 2]).filter(pa.array(stays, type=pa.bool_()))

    return (labelled.mapInArrow(lead, "doc_id long, text string, toxic int, lead array<long>")
            .repartition("toxic", "lead").sortWithinPartitions("toxic", "lead", "doc_id", "text")
            .mapInArrow(keep, "doc_id long, text string, toxic int"))


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def _scored(docs: DataFrame, entries: dict[str, float], scale: np.ndarray | None, keep: tuple[str, ...] = ()) -> DataFrame:
    kinds = dict(docs.dtypes)
    schema = ("doc_id long, " + "".join(f"`{c}` {kinds[c]}, " for c in keep)
              + "raw double, score double, n_hits long, n_words long")

    def run(batches):
        found = _automaton(entries)
        for batch in batches:
            raw, hits, words = (list(c) for c in zip(*(_raw(t.as_py(), found) for t in batch.column(1)))) if batch.num_rows else ([], [], [])
            bins = np.minimum(np.array(raw, dtype=float) / BIN, BINS - 1).astype(int)
            score = scale[bins] if scale is not None else np.zeros(len(raw))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(batch.column(2 + i) for i in range(len(keep))),
                 pa.array(raw, type=pa.float64()), pa.array(score, type=pa.float64()),
                 pa.array(hits, type=pa.int64()), pa.array(words, type=pa.int64())],
                names=["doc_id", *keep, "raw", "score", "n_hits", "n_words"])

    return docs.select(F.col("doc_id").cast("long"), "text", *keep).mapInArrow(run, schema)


def score(docs: DataFrame, model: tuple[dict[str, float], np.ndarray]) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_hits, n_words) per row of
    ``docs``.  Null and empty texts have no hits; every row, repeated or with
    a null id (held_out false), is scored alone.  Nothing is shuffled."""
    return (_scored(docs, *model)
            .select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_hits", "n_words"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs``, all columns, without the rows predicted toxic.  The text of
    each row is judged in place, so repeated or null ids do not matter."""
    entries, scale = learn(docs, labels)
    at = docs.columns.index("text")

    def run(batches):
        found = _automaton(entries)
        for batch in batches:
            raw = np.array([_raw(t.as_py(), found)[0] for t in batch.column(at)], dtype=float)
            clean = scale[np.minimum(raw / BIN, BINS - 1).astype(int)] < THRESHOLD
            yield batch.filter(pa.array(clean, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
