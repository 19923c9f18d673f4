"""The pipeline's stages, each against what it was given."""

from __future__ import annotations

import hashlib

import corpus_pipeline
from pyspark.sql import functions as F

from tidemark.llm import near_duplicates, personal_data

SMALL = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before, given = {}, {}
    for name, stage in corpus_pipeline.STAGES:
        given[name] = docs
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = before[name] = spark.read.parquet(str(tmp_path / name))
        if name != "byte_bpe":
            assert docs.dtypes == given["quality"].dtypes
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    assert 0 < before["quality"].count() < given["quality"].count()
    good = labels.where("quality = 1 AND toxic = 0").join(given["quality"], "doc_id")
    assert before["quality"].join(good, "doc_id", "left_semi").count() >= 0.95 * good.count()
    kept = near_duplicates.near_duplicates(given["near_duplicates"]).where("kept")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in before["near_duplicates"].collect())
    again = near_duplicates.near_duplicates(before["near_duplicates"])
    assert again.where("NOT kept").count() == 0
    clean = personal_data.find_personal_data(before["personal_data"], outputs=("spans",))
    assert clean.where("spans <> ''").count() == 0
    assert before["personal_data"].where(F.length("text") != F.col("n_chars")).count() == 0
    texts = {r.doc_id: r.text for r in before["personal_data"].collect()}
    for r in before["byte_bpe"].collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert before["byte_bpe"].count() == before["mixing"].count() > 0


def test_run_gives_the_rows_of_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert found.count() > 0


def test_an_empty_table_goes_through(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0
