"""The pipeline's stages: what each keeps, on edge cases and on the small tables."""

from __future__ import annotations

import corpus_pipeline
from quarry.llm import decontam, langid


def test_stages_keep_the_columns_and_the_clean(spark, docs, none, tables):
    benchmark = spark.createDataFrame([(1, "nothing like this is anywhere at all in here you see now")], "item_id long, text string")
    d = tables(documents=docs, benchmark=benchmark)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash", "decontamination", "byte_bpe"]
    now, empty = docs, none
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now, empty = stage(spark, now, d).cache(), stage(spark, empty, d)
        assert now.columns == docs.columns and empty.count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, now, d)
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in now.collect())


def test_stages_leave_columns_of_any_name_alone(spark, clashing, tables):
    from pyspark.sql import functions as F

    named = clashing.select("*", F.lit("en").alias("lang"), F.lit(1).alias("language"), F.lit(2).alias("contamination"), F.lit(3).alias("line_report"))
    d = tables(benchmark=spark.createDataFrame([(1, "nothing like this is anywhere at all in here you see now")], "item_id long, text string"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, named, d)
        assert out.columns == named.columns
        assert {(r["__id"], r["u.v"], r["x`y"], r["language"], r["contamination"], r["line_report"]) for r in out.collect()} <= {(f"__id{i}", f"u.v{i}", f"x`y{i}", 1, 2, 3) for i in range(3)}, name


def test_run_drops_what_the_stages_reject(spark):
    d = "/root/testdata/sf0.001"
    rows = corpus_pipeline.run(spark, d).collect()
    kept = {r.doc_id for r in rows}
    assert len(rows) == len(kept)
    hit = {r.doc_id for r in decontam.query(spark, d).collect() if r.contaminated}
    und = {r.doc_id for r in langid.query(spark, d).collect() if r.lang_pred == "und"}
    everything = spark.read.parquet(f"{d}/documents.parquet").count()
    assert not kept & und
    assert 0.5 * everything < len(kept) < everything
    assert len(kept & hit) <= len(hit) / 2  # a passage can only be lost with a repeated line
