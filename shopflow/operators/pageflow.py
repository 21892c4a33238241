"""Page conversion along a target page flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.functions.columns import half_up_text
from shopflow.operators.sequence import consecutive_pairs, second_chunk


def page_flow_pairs(spark: SparkSession, flow: str) -> DataFrame:
    """``"1,2,3"`` → rows (step, from_page, to_page): (1, 1, 2), (2, 2, 3).
    Built from the parameter; at most len(flow) rows."""
    pages = [int(p) for p in flow.split(",") if p.strip()]
    rows = [(i + 1, a, b) for i, (a, b) in enumerate(zip(pages, pages[1:]))]
    return spark.createDataFrame(rows, "step int, from_page bigint, to_page bigint")


def page_transitions(actions: DataFrame, chunk: Column | None = None, keep_last: bool = False) -> DataFrame:
    """Consecutive page pairs inside each session, ordered by (action time,
    event id).  A hot session is split by second of action time so it
    spreads over many tasks (``sequence.consecutive_pairs``).  With
    ``keep_last`` a session's last action is there too, ``has_next`` false."""
    pairs = consecutive_pairs(actions, "session_id", ["action_time", "event_id"],
                              second_chunk("action_time") if chunk is None else chunk, ["page_id"], keep_last=keep_last)
    return pairs.select("session_id", F.col("page_id").alias("from_page"), F.col("next_page_id").alias("to_page"),
                        *(["has_next"] if keep_last else []))


def page_transition_counts(actions: DataFrame) -> DataFrame:
    return (page_transitions(actions).groupBy("from_page", "to_page")
            .agg(F.count(F.lit(1)).alias("pair_count")))


def page_flow_counts(spark: SparkSession, actions: DataFrame, flow: str) -> DataFrame:
    """Step 0: actions on the start page; step i: transitions of the i-th
    target pair.  All steps are conditional counts of one aggregate over one
    pass of the transitions (as many counts as the flow has pages), turned
    into rows at the end."""
    pages = [int(p) for p in flow.split(",") if p.strip()]
    steps = [F.count_if(F.col("from_page") == pages[0])]
    steps += [F.count_if(F.col("has_next") & (F.col("from_page") == a) & (F.col("to_page") == b)) for a, b in zip(pages, pages[1:])]
    names = [str(pages[0]), *[f"{a}_{b}" for a, b in zip(pages, pages[1:])]]
    counted = page_transitions(actions, keep_last=True).agg(*[n.alias(f"n{i}") for i, n in enumerate(steps)])
    rows = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(name).alias("page_pair"), F.col(f"n{i}").alias("pair_count"))
                     for i, name in enumerate(names)])
    return counted.select(F.inline(rows))


def page_conversion(flow_counts: DataFrame) -> DataFrame:
    """(step, pair, n, previous n, ratio); ratio is null when the previous
    step counted nothing.  The table has one row per flow step, so the
    previous step comes from a join on step - 1."""
    prev = flow_counts.select((F.col("step") + 1).alias("step"), F.col("pair_count").alias("prev_count"))
    return (flow_counts.where(F.col("step") > 0).join(prev, "step")
            .select("step", "page_pair", "pair_count", "prev_count",
                    F.when(F.col("prev_count") > 0, F.col("pair_count") / F.col("prev_count"))
                    .alias("convert_rate")))


def page_conversion_packed(conversion: DataFrame) -> DataFrame:
    """One string ``1_2=0.1234|2_3=…`` in step order, 4 decimals HALF_UP
    (``null`` where the previous step counted nothing)."""
    text = F.concat(F.col("page_pair"), F.lit("="),
                    F.when(F.col("prev_count") > 0, half_up_text(F.col("pair_count"), F.col("prev_count"), 4))
                    .otherwise(F.lit("null")))
    items = F.array_sort(F.collect_list(F.struct("step", text.alias("t"))))
    return conversion.agg(F.array_join(F.transform(items, lambda x: x["t"]), "|").alias("convert_rate"))
