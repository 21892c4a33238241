"""Licence scan by an exact set-similarity join, with built-in functions only.

Text blocks (lines, and paragraphs between blank lines) are matched with the
templates of known notices: a block holds a template when it contains at
least ``percent`` of the template's distinct words.  Words are ordered by how
many blocks hold them, rarest first, over all documents.  A block can only
reach the threshold if it holds a word of the template's prefix, the
|T| - need + 1 rarest (prefix filter), has enough template words (length
filter), and has enough of them left from the matched position on (positional
filter).  Pairs that pass are verified exactly.  Only counts of template
words, at most as many as the templates hold, go to the driver; the template
side of the join has that same bound and is broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERCENT = 80
# Words hold no ASCII but a-z and 0-9.  As ranges that it holds: Java matches the
# class of what it does not hold ten times slower.
WORD = r"[0-9a-z\x80-\x{10FFFF}]+"
_SEP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"

# The phrases to be counted, with their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# Wording of well-known notices.
TEMPLATES = (
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                   "documentation files to deal in the software without restriction"),
    ("apache-notice", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license "
                      "you may obtain a copy of the license"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                   "public license as published by the free software foundation"),
    ("gpl-statement", "this work is licensed under the gnu general public license version 3"),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted provided that "
                   "the following conditions are met"),
    ("cc-notice", "this work is licensed under a creative commons attribution 4 0 international license to view a copy of this license"),
    ("mpl-notice", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc-notice", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense-notice", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use"),
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def base_scan(docs: DataFrame, text_col: str = "text", phrases=PHRASES) -> DataFrame:
    """``docs`` plus n_words, n_base, first_word, last_word and base_labels:
    places where a phrase's words stand consecutively.  Null text is empty.
    Columns of these names are replaced."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    maybe = "|".join(f"{_SEP}+".join(p.split()) for p, _ in phrases)
    df = docs.withColumn("_words", words_of(text)).withColumn("n_words", F.size("_words").cast("long"))

    def here(i: Column) -> Column:
        starts = [reduce(lambda a, b: a & b, [F.get("_words", i + k) == w for k, w in enumerate(p.split())]) for p, _ in phrases]
        return reduce(lambda a, b: a | b, starts)

    places = F.when(F.lower(text).rlike(maybe) & (F.col("n_words") > 0),
                    F.filter(F.sequence(F.lit(0), F.size("_words") - 1), here)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_places", places)

    def label(i: Column) -> Column:
        out = F.lit(None).cast("string")
        for p, name in phrases:
            out = F.when(reduce(lambda a, b: a & b, [F.get("_words", i + k) == w for k, w in enumerate(p.split())]), F.lit(name)).otherwise(out)
        return out

    return (df.withColumn("n_base", F.size("_places").cast("long"))
            .withColumn("first_word", F.array_min("_places").cast("long"))
            .withColumn("last_word", F.array_max("_places").cast("long"))
            .withColumn("_base", F.array_sort(F.array_distinct(F.transform("_places", label))))
            .withColumn("base_labels", F.array_join("_base", ","))
            .drop("_words", "_places"))


def blocks_of(docs: DataFrame, key_cols: list[str], text_col: str = "text") -> DataFrame:
    """Key columns and ``block``: the distinct lines and paragraphs of each row."""
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    both = F.array_distinct(F.concat(F.split(text, r"\n"), F.split(text, r"\n[ \t\r]*\n")))
    return docs.select(*key_cols, F.explode(both).alias("block"))


def matches(docs: DataFrame, key_cols: list[str], text_col: str = "text", templates=TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """(keys, label, containment) of every block and template that meet the
    threshold; one row per block and template."""
    spark = docs.sparkSession
    sets = [(label, sorted(set(t.split()))) for label, t in templates]
    vocabulary = sorted({w for _, ws in sets for w in ws})
    as_array = lambda ws: F.array(*(F.lit(w) for w in ws))
    blocks = blocks_of(docs, key_cols, text_col)
    counts = {r["word"]: r["count"] for r in blocks.select(
        F.explode(F.array_intersect(words_of(F.col("block")), as_array(vocabulary))).alias("word")).groupBy("word").count().collect()}
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    rows, prefix_words = [], set()
    for label, ws in sets:
        ws = sorted(ws, key=rank.__getitem__)
        need = -(-percent * len(ws) // 100)
        for i, w in enumerate(ws[:len(ws) - need + 1]):
            prefix_words.add(w)
            rows.append(F.struct(F.lit(w).alias("word"), F.lit(label).alias("label"), F.lit(i).alias("at"), F.lit(need).alias("need"),
                                 as_array(ws).alias("template")))
    side = spark.range(1).select(F.explode(F.array(*rows)).alias("t")).select("t.*")
    some = "|".join(sorted(prefix_words))
    held = (blocks.filter(F.col("block").rlike(f"(?:^|{_SEP})(?:{some})(?:{_SEP}|$)"))
            .withColumn("held", F.array_intersect(as_array(order), words_of(F.col("block")))))
    pairs = (held.select(*key_cols, "block", "held", F.posexplode("held").alias("pos", "word"))
             .join(F.broadcast(side), "word")
             .filter((F.size("held") >= F.col("need"))
                     & (1 + F.least(F.size("template") - 1 - F.col("at"), F.size("held") - 1 - F.col("pos")) >= F.col("need")))
             .withColumn("common", F.size(F.array_intersect("held", "template")))
             .filter(F.col("common") >= F.col("need"))
             .withColumn("containment", F.col("common") / F.size("template")))
    return pairs.groupBy(*key_cols, F.xxhash64("block").alias("block"), "label").agg(F.max("containment").alias("containment"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, percent: int = PERCENT,
         phrases=PHRASES) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_base, first_word, last_word,
    base_labels, labels (base ones and those of matched templates; distinct,
    sorted, comma-joined, empty without any) and score (1 with a base place,
    else the best containment that meets the threshold, else 0).

    Rows are keyed by id and text, so rows that repeat both get the same
    result, and repeated or null ids with other texts keep their own."""
    keyed = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).withColumn(
        "_text_key", F.sha2(F.coalesce(F.col("_text"), F.lit("")).cast("binary"), 256))
    base = base_scan(keyed, "_text", phrases).drop("_text")
    found = (matches(keyed, ["_id", "_text_key"], "_text", templates, percent).groupBy("_id", "_text_key")
             .agg(F.collect_set("label").alias("_more"), F.max("containment").alias("_best"))
             .withColumnsRenamed({"_id": "_fid", "_text_key": "_fkey"}))
    both = base.join(found, base["_id"].eqNullSafe(found["_fid"]) & (base["_text_key"] == found["_fkey"]), "left")
    none = F.array().cast("array<string>")
    return both.select(
        F.col("_id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_join(F.array_sort(F.array_union("_base", F.coalesce("_more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"))
