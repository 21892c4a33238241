"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm import (alignment, centroids, decontaminate, embedding_dedup, licenses, line_dedup, minhash, packing, sharding,
                          token_files, toxicity, url_filter, warc)
from shopflow.llm.common import table
from shopflow.session import scratch_dir


def op1_karmarkar_karp_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", "held_out", "score", "predicted")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "llm-warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    nested = warc.captures(warc.read_records(spark, path))
    answer = F.col("response")
    refers = F.when(answer["kind"] == "revisit", warc.page_of(answer["refers_to"]).try_cast("long"))
    return nested.select(F.col("metadata.page_id").try_cast("long").alias("page_id"), answer["payload_bytes"].alias("payload_bytes"),
                         answer["payload_digest"].alias("payload_digest"), answer["kind"].alias("record_type"),
                         refers.alias("refers_to"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "llm-token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, meta_cols=("lang", "source"))
    return token_files.read_spans(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op7_itq_hamming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_overlap(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                       table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op13_laesa_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return centroids.with_inertia(found).withColumnRenamed("id", "vec_id")


QUERIES = {f.__name__: f for f in (
    op1_karmarkar_karp_shards, op2_toxicity, op3_license_scan, op4_warc_captures, op5_token_files, op6_url_filter,
    op7_itq_hamming_dedup, op8_circulant_minhash, op9_benchmark_decontamination, op10_best_fit_packing,
    op11_token_alignment, op12_line_dedup, op13_laesa_centroids)}
