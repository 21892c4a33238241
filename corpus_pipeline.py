"""Training corpus: toxic documents go, one of each group of near-duplicates
stays, contaminated documents go, and the rest is packed into sequences.
Each stage is stored, its texts passing through Python few at a time.
Part of the ``shopflow.llm`` subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopflow.llm import decontaminate, minhash, packing, toxicity
from shopflow.llm.common import BATCH, ready, table, written

# Workers hold the words of packing beside what the other stages left on the executor.
CACHE = 200_000


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not predicted toxic."""
    ready(spark)
    return written(toxicity.keep_clean(docs, table(spark, sf_dir, "labels")), "pipeline-toxicity", BATCH)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, similarity 0.8) the
    document with the smallest doc_id."""
    ready(spark)
    return written(minhash.keep_one(docs), "pipeline-minhash_near_dedup", BATCH)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by the benchmark, with their columns,
    whatever those are named."""
    plain = [f"c{i}" for i in range(len(docs.columns))]
    found = decontaminate.find_overlap(docs.toDF(*plain), table(spark, sf_dir, "benchmark"),
                                       text_col=plain[docs.columns.index("text")])
    return written(found.filter(~found["contaminated"]).select(*plain).toDF(*docs.columns), "pipeline-benchmark_decontamination", BATCH)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequences and offsets."""
    ready(spark)
    return written(packing.pack(docs, cache=CACHE), "pipeline-best_fit_packing", BATCH)


STAGES = [("toxicity", toxicity_stage), ("minhash_near_dedup", near_dedup_stage),
          ("benchmark_decontamination", decontamination_stage), ("best_fit_packing", packing_stage)]

# The learned lexicon, the word hashes and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
