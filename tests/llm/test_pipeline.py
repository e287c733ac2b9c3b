"""The corpus pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from quillstone.llm import decontam, rules
from quillstone.llm.common import load
from quillstone.operators.checkpoints import drop_folders
from tests.llm.test_nearcopies import plain_kept


def test_each_stage_does_its_work(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    columns, bench = docs.columns, [(i, decontam.normalised(t)) for i, t in load(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    (_, first), (_, second), (_, third), (_, fourth), (_, fifth) = corpus_pipeline.STAGES

    a = first(spark, docs, sf_dir).cache()
    judged = rules.quality_rules(docs, load(spark, sf_dir, "labels"))
    assert a.columns == columns and {r.doc_id for r in a.collect()} == {r.doc_id for r in judged.where("kept").collect()}

    b = second(spark, a, sf_dir).cache()
    assert b.columns == columns and {r.doc_id for r in b.collect()} == plain_kept([(r.doc_id, r.text) for r in a.collect()])

    c = third(spark, b, sf_dir).cache()
    exact = {r.doc_id for r in b.collect() if any(t in decontam.normalised(r.text) for _, t in bench)}
    assert c.columns == columns and {r.doc_id for r in c.collect()} == {r.doc_id for r in b.collect()} - exact

    d = fourth(spark, c, sf_dir).cache()
    assert d.columns == columns and d.count() == c.count() and d.where(F.length("text") != F.col("n_chars")).count() == 0

    e = fifth(spark, d, sf_dir).toPandas()
    assert set(e.doc_id) <= {r.doc_id for r in d.collect()} and len(e)


def test_run_goes_through_and_its_tables_can_be_dropped(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    assert drop_folders(spark) >= 4 and drop_folders(spark) == 0


def test_stages_keep_columns_that_clash_with_their_own(spark, sf_dir):
    own = ["_text", "_key", "_own", "_made", "key", "fp", "id", "first", "kept", "n_words", "entities", "_id"]
    docs = load(spark, sf_dir, "documents").limit(40).select("*", *[F.lit(c).alias(c) for c in own]).cache()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        assert out.select(*own).distinct().collect() == docs.select(*own).distinct().collect()
    corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count()


def test_stages_take_odd_rows(spark, sf_dir):
    rows = [(1, "", "en", "src1", 0), (2, None, None, None, None), (None, "a b " * 40, None, "x", 3), (3, "w" * 5000, "en", "src1", 5000), (3, "w" * 5000, "en", "src1", 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for df in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, df, sf_dir).count()
