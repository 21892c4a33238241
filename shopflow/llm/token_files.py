"""Token ids as Parquet list columns.

``write_tokens`` writes (id, n_tokens, metadata..., ids) in ascending id
order.  Ids are delta-encoded (format version 2), metadata is
dictionary-encoded, row groups and pages have set sizes, and page indexes let
a reader that wants some ids or only metadata skip the other pages.  The
documents are range-partitioned by id before tokenising; a part file holds
one range and the numbers in file names sort as the ranges do.  ``read_spans`` finds each
document's place in the whole run of ids from per-file totals.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopflow.llm.tokens import chunk_tokenizer, default_tokenizer_path

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
# Beside the encoder a task holds 512 texts, so there is room for more words than elsewhere.
CACHE = 1_000_000


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 meta_cols: tuple[str, ...] = (), tokenizer_path: str | None = None, end_id: int = 0,
                 row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> None:
    """Null text is empty (its end id alone); rows that repeat an id are all
    written, side by side; a null id sorts first.  Only the id, text and
    ``meta_cols`` columns are read."""
    tok_path = tokenizer_path or default_tokenizer_path()
    source = (docs.select(F.col(id_col), *meta_cols, F.col(text_col).alias("_text"))
              .repartitionByRange(F.col(id_col)).sortWithinPartitions(id_col))
    kept = [id_col, *meta_cols]
    kinds = dict(source.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", n_tokens long, ids array<int>"

    def encode(batches):
        tok = chunk_tokenizer(tok_path, CACHE)
        end = np.uint32(end_id).tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                data = [d + end for d in tok.encode_many([t or "" for t in batch.column(len(kept)).slice(lo, 512).to_pylist()])]
                n = np.array([len(d) // 4 for d in data], dtype=np.int64)
                part = np.frombuffer(b"".join(data), dtype="<i4")
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(part))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(lo, len(n)) for i in range(len(kept))), pa.array(n), ids],
                    names=[*kept, "n_tokens", "ids"])

    (source.mapInArrow(encode, schema).write
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.block.size", row_group_bytes)
     .option("parquet.page.size", page_bytes)
     .option("parquet.enable.dictionary", "true")
     .option("parquet.enable.dictionary#ids.list.element", "false")
     .parquet(path))


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The stored rows; filters on the id and the choice of columns reach the
    scan (row-group statistics and page indexes)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_spans(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per stored row: id, start (ids of all rows before it), n_tokens (as
    counted in the list) and ids_crc32 over the ids as little-endian uint32."""
    stored = spark.read.parquet(path).select(
        F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"), F.col(id_col), F.col("ids"))
    schema = f"_file string, _row long, `{id_col}` {dict(stored.dtypes)[id_col]}, n_tokens long, ids_crc32 long"

    def digest(batches):
        for batch in batches:
            ids = batch.column(3)
            flat = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), dtype="<u4")).cast("B")
            off = ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.diff(off).astype(np.int64)), pa.array(crc, type=pa.int64())],
                names=["_file", "_row", id_col, "n_tokens", "ids_crc32"])

    rows = stored.mapInArrow(digest, schema)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("_file")).agg(F.sum("n_tokens").alias("_sum"))
    # by the number in the name: names of six digits do not sort as numbers do
    before = Window.orderBy(F.regexp_extract("_file", r"part-(\d+)", 1).cast("long")).rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("_file", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    # a file is one range partition: its rows fit one task as they did when written
    inside = Window.partitionBy("_file").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(starts, "_file")
            .select(id_col, (F.col("_start") + F.col("_in")).alias("start"), "n_tokens", "ids_crc32"))
