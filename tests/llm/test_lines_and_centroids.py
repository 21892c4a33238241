"""Line dedup and centroid clustering against plain versions, and edge cases."""

import collections
import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from shopflow.llm import centroids, line_dedup

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BOILER = "All rights reserved by the shop."


# ---- lines

def cut(rows, min_chars=10, min_docs=2):
    """(id, text) rows -> (id, n_lines, n_dropped, kept text) rows."""
    key = lambda line: line.strip(" \t\x0b\f\r").translate(LOW)
    held = collections.defaultdict(list)
    for i, t in rows:
        for k in {key(line) for line in (t or "").split("\n")}:
            held[k].append(i)
    low = {k: min((i for i in ids if i is not None), default=None) for k, ids in held.items()}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(held[key(x)]) < min_docs or low[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def cut_by_spark(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.drop_repeated_lines(df, **kw).select("doc_id", "n_lines", "n_dropped", "text").collect()
    return sorted((tuple(r) for r in out), key=str)


def test_lines_equal_the_plain_version_on_edges(spark):
    long = "\n".join(f"line number {i % 700} of a long text" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, f"{BOILER}\nown line of four"), (5, f"  {BOILER.upper()}\t\r\nshort\n{BOILER}\n"),
            (6, f"x\n{BOILER}\x0b"), (6, f"x\n{BOILER}\x0b"), (6, f"another text\n{BOILER}"), (None, BOILER), (None, f"{BOILER}\nonly null ids hold this"),
            (None, "only null ids hold this"), (7, "ＡＢＣＤＥＦＧＨＩＪ wide"), (8, "ａｂｃｄｅｆｇｈｉｊ wide"), (9, "İstanbul çok güzel"), (10, "İSTANBUL çok güzel"),
            (11, "123456789"), (12, "123456789"), (13, "1234567890"), (14, "1234567890"), (15, "😀" * 9), (16, "😀" * 9), (17, "😀" * 10), (18, "😀" * 10),
            (19, " ten letters "), (20, "ten letters"), (21, "K" * 10), (22, "k" * 10), (23, "K" * 10), (24, long), (25, long), (26, "a\n" + long)]
    assert cut_by_spark(spark, rows) == cut(rows)
    assert cut_by_spark(spark, rows, min_docs=3) == cut(rows, min_docs=3)
    assert cut_by_spark(spark, []) == []


def test_lines_random_with_a_hot_line(spark):
    rng = random.Random(1)
    pool = [f"repeated line number {i}" for i in range(30)]
    rows = [(i, "\n".join([BOILER] * (i % 3 == 0) + rng.choices(pool + [f"line of document {i}", "", "  "], k=rng.randrange(9)))) for i in range(400)]
    assert cut_by_spark(spark, rows) == cut(rows)


def test_lines_keep_other_columns_whatever_their_names(spark):
    df = spark.createDataFrame([(1, f"{BOILER}\na", "keep", 7, 8.0), (2, BOILER, None, 9, 1.0)],
                               "doc_id long, text string, `_gone` string, n_lines int, `_d.x` double")
    out = line_dedup.drop_repeated_lines(df)
    assert out.columns == ["doc_id", "text", "_gone", "_d.x", "n_lines", "n_dropped"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, f"{BOILER}\na", "keep", 8.0, 2, 0), (2, "", None, 1.0, 1, 1)]


def test_lines_plan_is_native_and_splits_a_text_once(spark, capsys):
    df = spark.range(10).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    line_dedup.drop_repeated_lines(df).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    for part in plan.split("lambdafunction(")[1:]:
        assert not part.startswith("split(")  # else every kept line would split the text again


# ---- centroids

def kmeans(rows, dims=64, scale=256, k=40, rounds=5, seed="2:"):
    """(id, list) rows -> sorted (id, cluster, distance), centroids."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    code = lambda i: hashlib.sha256(f"{seed}{i}".encode()).hexdigest()
    now = [x for _, x in sorted(kept, key=lambda r: (r[0] is None, code(r[0]), r[1]))[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(now))
    for _ in range(rounds):
        of = [near(x)[1] for _, x in kept]
        for n in range(len(now)):
            mine = [x for (_, x), c in zip(kept, of) if c == n]
            if mine:
                now[n] = [sum(col) // len(mine) for col in zip(*mine)]
    return sorted(((i, near(x)[1], near(x)[0]) for i, x in kept), key=str), now


def check_clusters(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = centroids.cluster(df, **kw)
    want, now = kmeans(rows, **{k: v for k, v in kw.items() if k != "pivots"})
    assert sorted((tuple(r) for r in found.assigned.collect()), key=str) == want
    assert found.centroids.tolist() == now
    return found


def test_clusters_equal_the_plain_version(spark):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(6, 8))
    rows = [(i, (middles[i % 6] + 0.05 * rng.normal(size=8)).tolist()) for i in range(300)]
    found = check_clusters(spark, rows, dims=8, k=12, rounds=4, pivots=6)
    assert len(found.computed) == 4 and max(found.computed) < 0.7 * 300 * 12  # the bounds leave centroids out


def test_clusters_edges(spark):
    rng = random.Random(5)
    # few distinct values: many ties between centroids, equal vectors, empty clusters
    rows = [(i, [rng.choice([0.0, 0.25, -0.25]) for _ in range(3)]) for i in range(120)]
    rows += [(None, [0.0, 0.0, 0.1]), (7, [0.5, 0.5, 0.5]), (7, [0.4, 0.5, 0.5]), (200, None), (201, []), (202, [0.1, 0.2]), (203, [0.1, None, 0.2]),
             (204, [float("nan"), 0.0, 0.0]), (205, [float("inf"), 0.0, 0.0]), (206, [0.1, 0.2, 0.3, 0.4]), (207, [-0.0, 1e-9, -1e-9]), (208, [5e4, -5e4, 5e4])]
    check_clusters(spark, rows, dims=3, k=40, rounds=3, pivots=4)
    check_clusters(spark, rows[:5], dims=3, k=40, rounds=2)  # fewer vectors than centroids
    check_clusters(spark, [(1, [1.0] * 3)] * 9, dims=3, k=4, rounds=2)
    check_clusters(spark, rows[-11:-3], dims=3, k=2, rounds=0)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert centroids.with_inertia(centroids.cluster(empty)).collect() == []
    none = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>")
    assert centroids.with_inertia(centroids.cluster(none)).collect() == []


def test_vectors_too_large_for_exact_longs_are_not_kept(spark):
    df = spark.createDataFrame([(1, [1e38, 0.0]), (2, [1.0, 2.0]), (3, [1.1, 2.0])], "vec_id long, embedding array<double>")
    found = centroids.cluster(df, dims=2, k=1, rounds=1)
    assert {r["id"] for r in found.assigned.collect()} == {2, 3}


def test_bounds_never_lose_the_nearest():
    rng = np.random.default_rng(7)
    for big in (10, 10_000, 1 << 26):
        x = rng.integers(-big, big, size=(500, 6))
        c = np.concatenate([x[:9], x[:3], rng.integers(-big, big, size=(8, 6))])
        pivots = centroids.choose_pivots(c, 5)
        found, distance, asked = centroids.assign(x, np.sqrt(centroids.squares(x, pivots).astype(float)), c, pivots)
        plain = np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)
        assert (found == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all() and asked <= plain.size


def test_inertia_is_summed_over_clusters_and_all(spark):
    df = spark.createDataFrame([(i, [float(i % 5), float(i % 3)]) for i in range(50)], "vec_id long, embedding array<double>")
    found = centroids.cluster(df, dims=2, k=4, rounds=2)
    rows = centroids.with_inertia(found).collect()
    by = collections.Counter()
    for r in rows:
        by[r["cluster"]] += r["distance"]
    assert all(r["cluster_inertia"] == by[r["cluster"]] and r["inertia"] == sum(by.values()) for r in rows)
    assert all(r["centroid_sha256"] == hashlib.sha256(",".join(map(str, found.centroids[r["cluster"]])).encode()).hexdigest() for r in rows)
