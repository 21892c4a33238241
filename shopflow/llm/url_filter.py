"""URL filter: explicit rules, and a character language-model ratio for the rest.

URLs that a rule allows or blocks train two variable-order Markov models over
characters (orders 0 to 3, Witten-Bell smoothing, so a context seen rarely
leans on the shorter one).  A URL without a rule is judged by the
length-normalised difference of its log-likelihoods under the two models,
against a threshold calibrated on rule URLs kept out of the training.

Counts are taken over all rule URLs, partition by partition, and summed by
key; the alphabet has SYMBOLS classes, so the summed table has at most
2 * SYMBOLS**4 cells whatever the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values: (verdict, host, path prefix).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

ORDER = 3
_PUNCT = "/.-_?=&%#:+~"
# start, letters, one class for digits, the signs above, anything else
SYMBOLS = 1 + 26 + 1 + len(_PUNCT) + 1
CALIBRATION_SHARE = 5
BINS = 2001
SPAN = 5.0


def _classes() -> np.ndarray:
    table = np.full(256, SYMBOLS - 1, dtype=np.uint8)
    for b in range(256):
        c = chr(b).lower()
        if b < 128 and c.isalpha():
            table[b] = 1 + ord(c) - 97
        elif b < 128 and c.isdigit():
            table[b] = 27
        elif c in _PUNCT:
            table[b] = 28 + _PUNCT.index(c)
    return table


_CLASS = _classes()


def url_parts(url):
    """(host, path): the host with A-Z in lower case; both empty without '://'."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit("")))


def with_rule(pages: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """``pages`` with host, path, rule and ruled (the rule's verdict): a rule
    fits its host and all subdomains when the path starts with its path; the
    longest wins.  Columns of these names are replaced."""
    host, path = url_parts(F.col(url_col))
    df = pages.withColumn("host", host).withColumn("path", path)
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return df.withColumn("rule", name).withColumn("ruled", verdict)


def _codes(url: str) -> tuple[np.ndarray, np.ndarray]:
    """Code of each character's last ORDER + 1 classes, and nothing else: the
    code counts in base SYMBOLS, oldest first."""
    x = _CLASS[np.frombuffer(url.encode("utf-8", "surrogatepass"), dtype=np.uint8)].astype(np.int64)
    padded = np.concatenate([np.zeros(ORDER, dtype=np.int64), x])
    code = np.zeros(len(x), dtype=np.int64)
    for i in range(ORDER + 1):
        code = code * SYMBOLS + padded[i:i + len(x)]
    return code


def _counts(urls: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the (allow, block) tables over all of ``urls`` (url, ruled)."""
    def run(batches):
        cells = np.zeros((2, SYMBOLS ** (ORDER + 1)), dtype=np.int64)
        seen = False
        for batch in batches:
            for url, ruled in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                np.add.at(cells[int(ruled == "block")], _codes(url), 1)
                seen = True
        if seen:
            for k in (0, 1):
                at = np.flatnonzero(cells[k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), k, dtype=np.int32)), pa.array(at), pa.array(cells[k][at])],
                    names=["model", "code", "n"])

    sums = urls.mapInArrow(run, "model int, code long, n long").groupBy("model", "code").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((2, SYMBOLS ** (ORDER + 1)))
    out[sums["model"].to_numpy(dtype=int), sums["code"].to_numpy(dtype=np.int64)] = sums["n"].to_numpy()
    return out[0], out[1]


def log_model(cells: np.ndarray) -> np.ndarray:
    """log P(character | last ORDER characters) for every cell.  Order k is
    (count + kinds * order k-1) / (total + kinds) of its context."""
    prob = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for k in range(ORDER + 1):
        n = cells.reshape(SYMBOLS ** (ORDER - k), SYMBOLS ** k, SYMBOLS).sum(axis=0)
        kinds = (n > 0).sum(axis=1, keepdims=True)
        total = n.sum(axis=1, keepdims=True)
        # the shorter context of the same recent characters
        low = prob.reshape(1, SYMBOLS) if k == 0 else np.tile(prob.reshape(SYMBOLS ** (k - 1), SYMBOLS), (SYMBOLS, 1))
        prob = np.where(total > 0, (n + kinds * low) / np.maximum(total + kinds, 1), low)
    return np.log(prob).reshape(-1).astype(np.float32)


def _ratios(pages: DataFrame, table, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``ratio``: the mean log ratio per character of url
    (0 for a url without characters)."""
    kinds = dict(pages.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", ratio double"

    def run(batches):
        diff = table.value
        for batch in batches:
            ratio = [float(diff[_codes(u)].mean()) if u else 0.0 for u in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(ratio, type=pa.float64())],
                                             names=[*keep, "ratio"])

    return pages.select(*keep, "url").mapInArrow(run, schema)


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """(id, host, path, rule, verdict, ratio) per row of ``pages``.

    A rule's verdict stands.  Otherwise the verdict is allow when the ratio is
    at least the calibrated threshold; a url without '://' is blocked.  Where
    no rule URL is allowed, or none is blocked, there is nothing to compare
    and the rest is allowed.  Rows may repeat; a null id is kept."""
    df = with_rule(pages.select(F.col(id_col), F.col(url_col).alias("url")), "url", rules)
    ruled = df.filter(F.col("ruled").isNotNull()).select("url", "ruled")
    kept_out = F.pmod(F.xxhash64("url"), F.lit(CALIBRATION_SHARE)) == 0
    allow, block = _counts(ruled.filter(~kept_out))
    spark = pages.sparkSession
    if not allow.any() or not block.any():
        return (df.withColumn("verdict", F.coalesce("ruled", F.when(F.col("host") == "", "block").otherwise("allow")))
                .withColumn("ratio", F.lit(0.0)).select(id_col, "host", "path", "rule", "verdict", "ratio"))
    table = spark.sparkContext.broadcast(log_model(allow) - log_model(block))
    threshold = _threshold(_ratios(ruled.filter(kept_out), table, ["ruled"]))
    scored = _ratios(df, table, [id_col, "host", "path", "rule", "ruled"])
    method = F.when((F.col("host") == "") & (F.col("path") == ""), "block").when(F.col("ratio") >= threshold, "allow").otherwise("block")
    return scored.withColumn("verdict", F.coalesce("ruled", method)).select(
        id_col, "host", "path", "rule", "verdict", "ratio")


def _threshold(scored: DataFrame) -> float:
    """The edge between ratio bins that errs least, each verdict weighing
    alike; of equal ones the nearest to 0."""
    width = 2 * SPAN / (BINS - 1)
    at = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("ratio") + SPAN) / width))).cast("int")
    hist = np.zeros((2, BINS))
    for r in scored.groupBy(at.alias("bin"), "ruled").count().collect():
        hist[int(r["ruled"] == "block"), r["bin"]] += r["count"]
    share = hist / np.maximum(hist.sum(axis=1, keepdims=True), 1)
    # allowed below the edge, blocked at or above it
    lost = np.concatenate([[0], np.cumsum(share[0])]) + share[1].sum() - np.concatenate([[0], np.cumsum(share[1])])
    edges = -SPAN + width * np.arange(BINS + 1)
    best = np.flatnonzero(lost <= lost.min() + 1e-12)
    return float(edges[best[np.abs(edges[best]).argmin()]])
