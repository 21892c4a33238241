"""Repeated lines: explode normalised lines, hash them, count the documents of
each hash, drop the lines over the threshold, reassemble by position.

Two passes over the documents, DataFrame functions only.  The first explodes
each document's distinct keys and counts documents per hash, partially
aggregated in every task, so a line that a third of all documents hold costs
one row per task.  The second explodes the lines with their positions and
joins those hashes; only the positions of dropped lines travel on, and each
text is cut by its own list of positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_CHARS, MIN_DOCS = 10, 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = "\t\x0b\f\r "


def _folded(text: Column) -> Column:
    """A-Z to a-z.  ``lower`` does that faster where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _key(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANK))


def _hash(key: Column) -> list[Column]:
    """128 bits from two seeds."""
    return [F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit(12), key).alias("_h2")]


def _row_key(doc_id: Column, text: Column) -> list[Column]:
    """Names a row, up to rows equal in id and text (those lose the same
    lines).  A row without an id takes another 64 bits from its text."""
    return [doc_id.alias("_d"), F.xxhash64(text).alias("_t1"), F.when(doc_id.isNull(), F.xxhash64(F.lit(12), text)).alias("_t2")]


def repeated_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                  min_docs: int = MIN_DOCS) -> DataFrame:
    """(_h1, _h2, n_docs, first_doc) of the keys that at least ``min_docs``
    documents hold."""
    lines = F.split(_folded(F.coalesce(F.col(f"`{text}`"), F.lit(""))), "\n")
    keys = F.array_distinct(F.filter(F.transform(lines, _key), lambda k: F.char_length(k) >= min_chars))
    return (docs.select(F.col(f"`{doc_id}`").alias("_d"), F.explode(keys).alias("_key")).select("_d", *_hash(F.col("_key")))
            .groupBy("_h1", "_h2").agg(F.count("*").alias("n_docs"), F.min("_d").alias("first_doc"))
            .filter(F.col("n_docs") >= min_docs))


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                        min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with all columns, the text cut, and ``n_lines`` (before) and
    ``n_dropped`` (long).

    A line's key is the line without ASCII white space at its ends, A-Z in
    lower case.  Keys of at least ``min_chars`` code points that at least
    ``min_docs`` documents hold lose all their lines, repeats inside a
    document included, except in the documents with the smallest id that holds
    the key.  Every row is a document: rows that repeat an id count each, and
    all rows of the smallest id keep the line.  A null id is larger than any
    id; among rows without ids alone, all keep the line.  A null or empty text
    is one empty line, and comes back as an empty text; a text that loses all
    lines is empty.  An empty table gives an empty one.  Texts of any length
    are handled whole, in linear time.  Columns named ``n_lines`` or
    ``n_dropped`` are replaced."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    row = _row_key(F.col(f"`{doc_id}`"), whole)
    names = ["_d", "_t1", "_t2"]
    keys = repeated_keys(docs, doc_id, text, min_chars, min_docs).select("_h1", "_h2", F.col("first_doc").alias("_first"))
    # the row's key is made before its lines are exploded, not once per line;
    # outer: no filter that would split the text again
    placed = (docs.select(*row, F.split(_folded(whole), "\n").alias("_lines"))
              .select(*names, F.posexplode_outer("_lines").alias("_pos", "_line"))
              .select(*names, "_pos", _key(F.col("_line")).alias("_key")).filter(F.char_length("_key") >= min_chars)
              .select(*names, "_pos", *_hash(F.col("_key"))))
    gone = (placed.join(keys, ["_h1", "_h2"]).filter(~F.col("_d").eqNullSafe(F.col("_first")))
            .groupBy(*names).agg(F.collect_set("_pos").alias("_gone"))
            .select(*(F.col(c).alias(f"{c}_") for c in names), "_gone"))
    same = [F.col(f"_r{c}").eqNullSafe(F.col(f"{c}_")) for c in names]
    # the other columns travel as one, whatever their names
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text)).alias("_row"), whole.alias("_text"),
                       *(c.alias(f"_r{n}") for c, n in zip(row, names)))
    # split once per row: inside the lambda it would be split once per line
    met = held.join(gone, same[0] & same[1] & same[2], "left").withColumn("_split", F.split("_text", "\n"))
    rest = F.array_except(F.sequence(F.lit(0), F.size("_split") - 1), F.col("_gone"))
    kept = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(rest, lambda i: F.get(F.col("_split"), i)), "\n"))
    return met.select(*((kept if c == text else F.col("_row").getField(c)).alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")),
                      F.size("_split").cast("long").alias("n_lines"),
                      F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"))
