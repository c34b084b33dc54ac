"""Corpus queries against SQL, and the pipeline's stages against what they promise."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from strikeloom.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in Path(SF_DIR).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    frame = QUERIES[name](spark, SF_DIR)
    answer = duck.execute(SQL[name])
    columns = [column[0] for column in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    got = sorted(map(repr, map(tuple, frame.select(*columns).collect())))
    assert got == sorted(map(repr, answer.fetchall()))


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if name != "packing":
            assert docs.columns == columns
            assert 0 < docs.count() <= kept
            kept = docs.count()
            assert docs.select("doc_id").distinct().count() == kept
    words = sum(row.n_tokens for row in docs.collect())
    last = spark.read.parquet(f"{tmp_path}/{len(corpus_pipeline.STAGES) - 2}")
    assert words == sum(len(row.text.split()) for row in last.collect())


def test_pipeline_removes_exact_repeats_of_every_length(spark):
    texts = ["short\n\nx\n  short\nother", "x\nnew\n\nshort \nshore", None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    seen, kept = set(), {}
    for k, text in enumerate(texts):
        lines = []
        for line in (text or "").split("\n"):
            if line.strip() and line.strip() in seen:
                continue
            seen.add(line.strip())
            lines.append(line)
        kept[k] = None if text is None else "\n".join(lines)
    rows = corpus_pipeline.line_deduplication(spark, frame, SF_DIR).collect()
    assert {r.doc_id: r.text for r in rows} == kept
