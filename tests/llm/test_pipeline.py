"""The pipeline: its stages' decisions hold, against plain versions."""

import brute
import corpus_pipeline
from shopflow.llm import decontaminate, minhash, toxicity

SF = "/root/testdata/sf0.01"


def test_pipeline_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    toxic = {r["doc_id"] for r in toxicity.score(docs, toxicity.learn(docs, labels)).filter("predicted = 1").collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in toxic)
    assert toxic
    comp = brute.roots(len(rows), brute.similar_pairs([brute.shingles(t, 5) for _, t in rows], 80))
    rows = [r for i, r in enumerate(rows) if comp[i] == i]
    pats = brute.windows([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    rows = [r for r in rows if not brute.overlap(r[1], pats)[-1]]
    tok = brute.tokenizer()
    want = {d: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in rows}
    got = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want


def test_stages_keep_columns_and_survive_empty_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0
    assert len(corpus_pipeline.STAGES) == 4 and (toxicity, minhash, decontaminate)


def test_near_dedup_keeps_one_row_of_each_group(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(1, text(1), "a"), (2, text(1) + " more", "b"), (2, text(2), "c"),  # an id of two texts, one a near copy
            (3, text(3), "d"), (3, text(3), "d"), (4, text(3), "e"),  # equal rows and a copy
            (None, text(4), "f"), (None, text(4) + " more", "g"), (None, text(4), "h"),  # no id in the group
            (None, text(5), "i"), (9, text(5), "j"), (5, text(6), "k"), (5, text(6) + " more", "l"),
            (6, None, "m"), (6, None, "m"), (7, " ", "n"), (None, "", "o"), (8, text(8), "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tag string")
    out = minhash.keep_one(docs)
    got = [tuple(r) for r in out.collect()]
    assert out.columns == docs.columns and set(got) <= set(rows)
    groups = {"a": "ab", "c": "c", "d": "de", "f": "fgh", "i": "ij", "k": "kl", "p": "p"}
    for tags in groups.values():
        assert len([r for r in got if r[2] in tags]) == 1, (tags, got)
    assert {"a", "c", "d", "j"} <= {r[2] for r in got}
    assert sorted(r[2] for r in got if r[2] in "mno") == ["m", "m", "n", "o"]


def test_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline as P
    docs = spark.createDataFrame([(1, "one two three four five six seven", "keep", 5, ["x"], "r"), (2, None, "too", 6, None, "s")],
                                 "doc_id long, text string, n_words string, _n int, _items array<string>, _row string")
    for stage in (P.near_dedup_stage, P.decontamination_stage):
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == sorted(map(tuple, docs.collect()))


def test_stages_take_texts_few_rows_at_a_time(spark, monkeypatch):
    from pyspark.sql import functions as F

    def few(batches):
        for batch in batches:
            assert batch.num_rows <= 1024
            yield batch

    monkeypatch.setattr(toxicity, "keep_clean", lambda docs, _: docs.mapInArrow(few, docs.schema))
    monkeypatch.setattr(decontaminate, "find_overlap",
                        lambda docs, _, text_col: docs.mapInArrow(few, docs.schema).withColumn("contaminated", F.lit(False)))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text")).coalesce(1)
    for stage in (corpus_pipeline.toxicity_stage, corpus_pipeline.decontamination_stage):
        assert stage(spark, docs, SF).count() == 3000


def test_learning_and_packing_store_texts_few_rows_at_a_time(spark, monkeypatch):
    from shopflow.llm import packing
    rows = {}

    def spy(module):
        own = module.written
        monkeypatch.setattr(module, "written", lambda df, name, batch_rows=None: rows.update({name: batch_rows}) or own(df, name, batch_rows))

    spy(toxicity)
    spy(packing)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(50)
    toxicity.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    packing.pack(docs).count()
    assert rows == {"labelled": 1024, "terms": 1024, "pieces": 1024}
