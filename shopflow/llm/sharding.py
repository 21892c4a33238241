"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Groups (equal texts) are dealt by hash into buckets of about GROUPS_PER_TASK.
Each bucket starts with one partial partition per group and repeatedly
combines the two of largest spread in opposite order until one partition into
n parts is left.  The partitions of the buckets are then combined the same
way, FAN_IN at a time, level by level, until one is left; what travels is n
sums per partition, never the groups.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import bucket_count, gapless_rank, written

SHARDS = 24
GROUPS_PER_TASK = 20_000
FAN_IN = 256


def difference(sums: list[np.ndarray], shards: int) -> list[np.ndarray]:
    """Karmarkar-Karp over partial partitions (one vector of ``shards`` sums
    each).  Returns for every one the final part of each of its parts.

    A heap holds the partitions by spread (largest minus smallest part); the
    two of largest spread combine, the largest part of one with the smallest
    of the other.  Parts are tracked as trees, read out at the end."""
    children: list[tuple[int, int]] = []
    heap = []
    n = len(sums)
    for i, v in enumerate(sums):
        order = np.argsort(v, kind="stable")
        heap.append((-int(v[order[-1]] - v[order[0]]), i, v[order], [i * shards + int(p) for p in order]))
    heapq.heapify(heap)
    made, first_node = n, n * shards
    while len(heap) > 1:
        _, _, va, na = heapq.heappop(heap)
        _, _, vb, nb = heapq.heappop(heap)
        v = va + vb[::-1]
        nodes = []
        for x, y in zip(na, reversed(nb)):
            nodes.append(first_node + len(children))
            children.append((x, y))
        order = np.argsort(v, kind="stable")
        v = v[order]
        heapq.heappush(heap, (-int(v[-1] - v[0]), made, v, [nodes[p] for p in order]))
        made += 1
    part = np.empty(first_node + len(children), dtype=np.int32)
    _, _, _, roots = heap[0]
    for p, node in enumerate(roots):
        part[node] = p
    for k in range(len(children) - 1, -1, -1):
        x, y = children[k]
        part[x] = part[y] = part[first_node + k]
    return list(part[:first_node].reshape(n, shards))


def _difference_groups(sizes: np.ndarray, shards: int) -> np.ndarray:
    """The same for single groups: part of each.  Small partitions hold few
    non-zero parts, which alone are stored and merged."""
    n = len(sizes)
    heap = [(-int(s), i, [int(s)], [i]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    children: list[tuple[int, int]] = []
    made = n
    while len(heap) > 1:
        _, _, va, na = heapq.heappop(heap)  # parts in descending order, the rest zero
        _, _, vb, nb = heapq.heappop(heap)
        ka, kb = len(va), len(vb)
        over = ka + kb - shards
        if over <= 0:
            v, nodes = va + vb, na + nb
        else:
            v, nodes = va[:shards - kb] + vb[:shards - ka], na[:shards - kb] + nb[:shards - ka]
            for i in range(over):
                x, y = shards - kb + i, kb - 1 - i
                v.append(va[x] + vb[y])
                nodes.append(n + len(children))
                children.append((na[x], nb[y]))
        order = sorted(range(len(v)), key=v.__getitem__, reverse=True)
        v, nodes = [v[i] for i in order], [nodes[i] for i in order]
        spread = v[0] - (v[-1] if len(v) == shards else 0)
        heapq.heappush(heap, (-spread, made, v, nodes))
        made += 1
    part = np.zeros(n + len(children), dtype=np.int32)
    if heap:
        for p, node in enumerate(heap[0][3]):
            part[node] = p
    for k in range(len(children) - 1, -1, -1):
        x, y = children[k]
        part[x] = part[y] = part[n + k]
    return part[:n]


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) per row of
    ``docs``: size is the text's UTF-8 bytes (null: none) plus 8; rows of
    equal text share a shard (null texts are equal to each other, not to empty
    ones); slot numbers the rows of a shard from 0.  A null text has the
    checksum of no bytes.  Rows may repeat or lack an id.  ``law`` is 'bytes':
    the shards' sizes differ by no more than indivisible groups force."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(docs.select(
        F.col(id_col).cast("long").alias(id_col),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(F.col(text_col).cast("binary"), 256)), F.lit(b"")).alias("digest")), "shard-rows")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    groups = written(groups, "shard-groups")
    n_rows, n_groups = groups.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    buckets = bucket_count(n_groups, GROUPS_PER_TASK)
    groups = groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int"))

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "digest"], ascending=[False, True], kind="stable")
        return pdf[["digest", "bucket", "bytes"]].assign(part=_difference_groups(pdf["bytes"].to_numpy(), shards))

    placed = written(groups.select("digest", "bucket", "bytes").groupBy("bucket").applyInPandas(
        first, "digest binary, bucket int, bytes long, part int"), "shard-parts")
    sums = placed.groupBy("bucket", "part").agg(F.sum("bytes").alias("bytes"))
    parts = _combine_levels(sums, buckets, shards)
    where = placed.select("digest", "bucket", "part").join(parts, ["bucket", "part"]).select("digest", "shard")
    out = written(rows.join(where, "digest").withColumn("shard", F.col("shard").cast("int")), "shard-out")
    ranked = gapless_rank(out, "shard", [id_col, "digest"], n_rows, "slot")
    return ranked.select(id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def _combine_levels(sums: DataFrame, buckets: int, shards: int) -> DataFrame:
    """(bucket, part, shard): the buckets' partitions (bucket, part, bytes)
    combined FAN_IN at a time until one partition is left."""
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        names = np.sort(pdf["node"].unique())
        table = np.zeros((len(names), shards), dtype=np.int64)
        table[np.searchsorted(names, pdf["node"]), pdf["part"]] = pdf["bytes"]
        to = difference(list(table), shards)
        return pd.DataFrame({"node": np.repeat(names, shards), "part": np.tile(np.arange(shards, dtype=np.int32), len(names)),
                             "to": np.concatenate(to).astype(np.int32), "bytes": table.reshape(-1),
                             "up": np.repeat(names // FAN_IN, shards)})

    now = sums.withColumnRenamed("bucket", "node").withColumn("node", F.col("node").cast("long"))
    maps = []
    left = buckets
    while True:
        step = written(now.withColumn("up", F.floor(F.col("node") / FAN_IN)).groupBy("up").applyInPandas(
            merge, "node long, part int, to int, bytes long, up long"), "shard-level")
        maps.append(step.select("node", "part", "to", "up"))
        left = -(-left // FAN_IN)
        if left <= 1:
            break
        now = step.groupBy(F.col("up").alias("node"), F.col("to").alias("part")).agg(F.sum("bytes").alias("bytes"))
    out = maps[-1].select("node", "part", F.col("to").alias("shard"))
    for lower in reversed(maps[:-1]):
        out = (lower.withColumnRenamed("node", "low").withColumnRenamed("part", "low_part")
               .join(out.withColumnRenamed("node", "up").withColumnRenamed("part", "to"), ["up", "to"])
               .select(F.col("low").alias("node"), F.col("low_part").alias("part"), "shard"))
    return out.select(F.col("node").cast("int").alias("bucket"), "part", "shard")
