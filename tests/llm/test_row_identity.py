"""The pipeline's stages tell rows apart by id and text, and leave the caller's columns alone."""

import os

import pytest

import corpus_pipeline
from strikeloom.llm import kneser_ney

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id bigint, text string, lang string, n_chars int, n_removed string, n_lines double, _dropped int"
A = "the quick brown fox jumps over the lazy dog while seven wizards box with quills"
B = "colourless green ideas sleep furiously beside a river of forgotten paper boats"


def table(spark, rows):
    full = [(number, text, "en", None if text is None else len(text), "77", 88.0, k) for k, (number, text) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def left(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)


def test_one_row_of_each_group_stays(spark):
    rows = [(1, A), (5, A), (5, B), (None, B), (None, A), (7, B), (None, None), (None, ""), (5, B)]
    kept = corpus_pipeline.near_deduplication(spark, table(spark, rows), SF_DIR)
    found = kept.collect()
    assert sorted((r.doc_id, r.text) for r in found if r.text) == [(1, A), (5, B)]
    # NULL and empty text share fingerprint zero; one of these unnamed rows stands for both.
    assert len(found) == 3 and kept.schema.simpleString() == table(spark, rows).schema.simpleString()
    assert all(r.n_removed == "77" and r.n_lines == 88.0 for r in found)


def test_unnamed_copies_leave_one_row(spark):
    rows = [(None, A), (None, A), (None, B)]
    assert left(corpus_pipeline.near_deduplication(spark, table(spark, rows), SF_DIR)) == [(None, B), (None, A)]


def test_benchmark_text_goes_by_row(spark):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").where("text IS NOT NULL").orderBy("item_id").first().text
    rows = [(1, A), (1, f"{B} {item} {A}"), (None, f"{A} {item} {B}"), (None, B), (2, None)]
    kept = corpus_pipeline.decontamination_stage(spark, table(spark, rows), SF_DIR)
    assert left(kept) == sorted([(1, A), (None, B), (2, None)], key=repr)


def test_rejection_goes_by_row(spark):
    texts = [f"{A} and number {k} says that {B}" for k in range(60)]
    noise = "zqxj vkwp " * 30
    rows = [*enumerate(texts), (70, noise), (70, texts[3]), (None, noise), (None, texts[4]), (8, None), (9, "")]
    docs = table(spark, rows)
    trusted = spark.range(60).withColumnRenamed("id", "doc_id")
    kept = left(kneser_ney.accepted(docs, trusted))
    verdicts = sorted(r.kept for r in kneser_ney.classified(docs, trusted).collect())
    assert sum(verdicts) == len(kept)
    assert (70, noise) not in kept and (None, noise) not in kept
    assert (8, None) not in kept and (9, "") not in kept
    assert (None, texts[4]) in kept and (70, texts[3]) in kept


def test_lines_go_and_columns_stay(spark):
    rows = [(1, f"{A}\n{B}"), (2, f"{B}\nown line of this text"), (None, A), (3, None), (4, "")]
    docs = table(spark, rows)
    found = {r.n_removed + str(r._dropped): r for r in corpus_pipeline.line_deduplication(spark, docs, SF_DIR).collect()}
    assert [found[f"77{k}"].text for k in range(5)] == [f"{A}\n{B}", "own line of this text", A, None, ""]
    assert found["771"].n_chars == len("own line of this text") and found["770"].n_chars == len(f"{A}\n{B}")
    assert {r.n_lines for r in found.values()} == {88.0}


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_empty_tables_stay_empty(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, table(spark, []).limit(0), SF_DIR).count() == 0
