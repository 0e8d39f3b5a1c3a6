"""The pipeline's stages against brute force, each on its own input, and the rules that the entry points keep."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.llm.test_operators import brute_components, words


@pytest.fixture(scope="module")
def staged(spark, sf, tmp_path_factory):
    """The input and the output of every stage."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, sf).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs, after)
        docs = after
    return out


def test_all_but_the_last_keep_the_columns(staged):
    for name, (before, after) in list(staged.items())[:-1]:
        assert after.dtypes == before.dtypes, name


def test_quality_keeps_what_is_labelled_good(spark, sf, staged):
    before, after = staged["quality_classifier"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    gone = before.join(after.select("doc_id"), "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.filter("quality = 1").count() == 0 and gone.filter("quality = 0").count() > 0


def test_one_document_of_each_group_stays(staged):
    before, after = staged["ngram_jaccard_join"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    expected = {i for i, (_, top) in brute_components(rows, 5, 80).items() if i == top}
    assert {r["doc_id"] for r in after.collect()} == expected


def test_passages_stay_once(staged):
    before, after = staged["substring_dedup"]
    kept, seen = {r["doc_id"]: r for r in after.collect()}, set()
    for row in before.orderBy("doc_id").collect():
        own = words(row["text"])
        gone = [False] * len(own)
        for k in range(len(own) - 19):
            key = tuple(own[k : k + 20])
            if key in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(key)
        left = " ".join(w for w, g in zip(own, gone, strict=True) if not g) if any(gone) else row["text"]
        assert kept[row["doc_id"]]["text"] == left


def test_leaking_documents_go(spark, sf, staged):
    before, after = staged["benchmark_decontamination"]
    items = [" ".join(words(r["text"], True)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    holds = {r["doc_id"] for r in before.collect() if any(f" {i} " in f" {' '.join(words(r['text'], True))} " for i in items)}
    left = {r["doc_id"] for r in after.collect()}
    assert holds and not holds & left
    assert before.count() - len(left) <= len(holds) + 3


def test_ids_decode_to_the_texts(staged):
    before, after = staged["byte_bpe"]
    both = before.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(after, "doc_id")
    assert both.count() == before.count() == both.filter("decoded = text").count()


def test_stages_take_empty_tables_and_null_rows(spark, sf, staged):
    docs = staged["quality_classifier"][0]
    odd = docs.limit(0).unionByName(
        spark.createDataFrame([(None, None, None, None, None), (None, "some words " * 30, None, None, 1), (3, "", "", "", 0)], docs.schema)
    )
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0, name
        kept = stage(spark, odd, sf).count()
        assert kept == 3 or name == "quality_classifier", name


def test_the_pipeline_is_registered():
    assert "pipeline" in entry_points.queries()
    found = {int(m[1]) for k in entry_points.queries() if (m := re.match(r"op(\d+)_", k))}
    assert found == set(range(1, 14))


def test_sharding_stays_out_of_python(spark, sf):
    text = entry_points.queries()["op2_sharding"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", text)
