"""The chunked consecutive-pairs operator equals a plain per-group lead,
whatever the chunk width (boundaries crossed on almost every row)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopflow.operators.sequence import consecutive_pairs, id_chunk, minute_chunk, second_chunk
from shopflow.sources.fixtures import user_visit_action
from tests.conftest import SF_SMALL


def plain(acts, order):
    w = Window.partitionBy("session_id").orderBy(*order)
    return (acts.select("session_id", "page_id", F.lead("page_id").over(w).alias("next_page_id"),
                        F.lead(F.lit(1)).over(w).alias("has"))
            .where(F.col("has").isNotNull()).drop("has"))


BY_ID, BY_TIME = ["event_id"], ["action_time", "event_id"]


@pytest.mark.parametrize("chunk,order", [
    (lambda: id_chunk("event_id", 1), BY_ID), (lambda: id_chunk("event_id", 3), BY_ID),
    (lambda: minute_chunk("action_time"), BY_TIME), (lambda: second_chunk("action_time"), BY_TIME),
    (lambda: F.floor(F.unix_timestamp("action_time") / 7), BY_TIME), (lambda: F.lit(0), BY_TIME)])
@pytest.mark.parametrize("hot_rows", [0, 3, 10 ** 9])
def test_chunked_pairs_equal_plain_lead(spark, chunk, order, hot_rows):
    # hot_rows 0: every session is split; 3: only sessions with > 3 actions
    acts = user_visit_action(spark, SF_SMALL)
    got = consecutive_pairs(acts, "session_id", order, chunk(), ["page_id"], hot_rows)
    want = plain(acts, order)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.count() == want.count()


@pytest.mark.parametrize("name,share", [("hot", 3), (None, 2)])
def test_a_session_with_a_large_share_of_all_rows_is_split(spark, name, share):
    from shopflow.operators.sequence import with_chunks
    acts = user_visit_action(spark, SF_SMALL)
    skewed = acts.withColumn("session_id", F.when(F.col("event_id") % share == 0, F.lit(name).cast("string"))
                             .otherwise(F.col("session_id")))
    is_hot = F.col("session_id").eqNullSafe(F.lit(name).cast("string"))
    n_hot = skewed.where(is_hot).count()
    assert n_hot * share >= acts.count() - 2
    marked = with_chunks(skewed, "session_id", second_chunk("action_time"), hot_rows=100)
    assert marked.where(F.col("_hot") != is_hot).count() == 0
    sizes = [r["count"] for r in marked.where(is_hot).groupBy("_chunk").count().collect()]
    assert len(sizes) > n_hot // 100 and max(sizes) < n_hot // 4
    got = consecutive_pairs(skewed, "session_id", BY_TIME, second_chunk("action_time"), ["page_id"], hot_rows=100)
    want = plain(skewed, BY_TIME)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    every = consecutive_pairs(skewed, "session_id", BY_TIME, second_chunk("action_time"), ["page_id"], hot_rows=100, keep_last=True)
    assert every.count() == skewed.count() and every.where("has_next").drop("has_next").exceptAll(want).count() == 0


@pytest.mark.parametrize("step", [1, 1 << 30])
def test_dense_and_sparse_ids_are_cut_alike(spark, step):
    from shopflow.operators.sequence import with_chunks
    rows = spark.range(4000).select(F.lit("s").alias("g"), (F.col("id") * step).alias("i"))
    sizes = [r["count"] for r in with_chunks(rows, "g", id_chunk("i"), hot_rows=1000).groupBy("_chunk").count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 251
