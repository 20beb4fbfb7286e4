"""The pipeline against a composition of brute-force stages; nulls, ties and an empty table."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from test_llm_texts import SCHEMA, _normal, brute_classes, make_docs

import corpus_pipeline
from ledgerlint.llm import decontam


@pytest.fixture(scope="module")
def folder(spark, sf_small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    bench.write.parquet(f"{path}/benchmark.parquet")
    leak = bench.orderBy("item_id").first().text
    rows = make_docs() + [(200, f"some words before {leak} and after", "en", "s", 1), (201, None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).withColumn("digest", F.lit("mine")).write.parquet(f"{path}/documents.parquet")
    return path, rows


def test_pipeline_equals_brute_force(spark, folder):
    path, rows = folder
    kept = [(i, t) for i, t, *_ in rows if re.search(r"[^\W\d_]", t or "")]
    groups = defaultdict(list)
    for i, t in kept:
        groups[_normal(t)].append((-len(t), i, t))
    kept = [min(g)[1:] for g in groups.values()]
    first = {c for _, c in brute_classes(kept)}
    kept = [(i, t) for i, t in kept if i in first and i != 200]
    out = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in out} == {i for i, _ in kept}
    tokens = {r.doc_id: r.doc_tokens for r in out}
    assert sum(r.length for r in out) == sum(tokens.values())


def test_stages_keep_columns(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, path).columns == docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]
    assert decontam.drop_leaks(docs, spark.read.parquet(f"{path}/benchmark.parquet")).where("doc_id = 200").isEmpty()


def test_empty_table(spark, folder, tmp_path):
    path, _ = folder
    spark.read.parquet(f"{path}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()
