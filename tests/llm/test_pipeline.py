"""The pipeline, stage by stage, on a small table with odd rows."""

from __future__ import annotations

import pyarrow as pa
import sentencepiece as library
from pyspark.sql import functions as F

import corpus_pipeline
from telestrata.llm import pii
from telestrata.llm.common import BATCH
from telestrata.llm.queries import vocabulary
from tests.llm.test_table_operators import brute_classes

SF = "/root/testdata/sf0.01"


def test_stages_on_odd_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null").orderBy("doc_id").limit(120)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    base = next(r.text for r in docs.orderBy("doc_id").collect() if 150 < len(r.text.split()) < 400)
    other = lambda seed: " ".join(f"w{seed}x{i}" for i in range(60))
    odd = [
        (9001, None, "en", "x", None), (9002, "", "en", "x", 0), (9003, " ".join([base] * 120), "en", "x", 5),
        (9004, base + " so", "en", "x", 7), (9004, base + " so", "en", "x", 7), (None, base + " more of it", None, None, None),
        (9005, other(1) + " " + item + " " + other(2), "en", "x", 9), (9006, other(3) + " write to jo.doe@example.org or +49 30 1234567", None, "x", 9),
        (9007, "1,2;3 --- ???", "en", "x", 3),
    ]
    rows = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    rows.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    # Columns that clash with names inside the stages.
    extra = [F.lit("mine").alias(c) for c in ("id", "masked", "language", "pieces", "print")]
    now = now.select("*", *extra)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        before, now = now, spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (before.collect(), now.collect())
        if name == "language":  # so small a table teaches little; the next stages get all rows
            now = before
            continue
        if name != "pieces":
            assert now.columns == before.columns

    before, after = seen["language"]
    ids = {r.doc_id for r in after}
    assert not ids & {9001, 9002, 9007} and 0 < len(after) < len(before)
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}

    before, after = seen["near_duplicates"]
    named = {(r.doc_id, r.text) for r in before if r.doc_id is not None and r.text is not None}
    classes = brute_classes(sorted(named))
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted({*classes.values(), 9001})

    before, after = seen["decontamination"]
    assert 9005 in {r.doc_id for r in before} and 9005 not in {r.doc_id for r in after}
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}

    before, after = seen["personal_data"]
    plain = sorted((r.doc_id or 0, pii.masked(r.text or "", pii.find_spans(r.text))) for r in before)
    assert sorted((r.doc_id or 0, r.text or "") for r in after) == plain
    assert all(r.n_chars == len(r.text) for r in after if r.text is not None)
    assert {r.doc_id for r in after if r.text is None} == {9001}

    before, after = seen["pieces"]
    reference = library.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    assert sorted((r.doc_id or 0, r.text or "") for r in before) == sorted((r.doc_id or 0, r.text or "") for r in after)
    assert all(r.pieces_ == reference.encode(r.text or "") and r.round_trip for r in after)


def test_workers_get_rows_a_few_mb_at_a_time(spark):
    """Long rows come in small batches; a limit that the session sets itself stays."""
    sizes = F.arrow_udf(lambda batch: pa.array([batch.nbytes] * len(batch), pa.int64()), "long")
    docs = spark.range(0, 2000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a b c d "), 1250).alias("text"))
    spark.conf.unset(BATCH)
    try:
        pii.mask(docs)
        found = [r[0] for r in docs.select(sizes("text")).collect()]
        assert len(found) == 2000 and max(found) < 5_000_000
        spark.conf.set(BATCH, "1000000")
        pii.mask(docs)
        assert spark.conf.get(BATCH) == "1000000"
    finally:
        spark.conf.unset(BATCH)


def test_run_on_empty_documents(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
