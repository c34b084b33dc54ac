"""A corpus from raw documents to training batches, in stages that each use one operator."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strikeloom.llm import decontamination, kneser_ney, line_dedup, packing, simhash
from strikeloom.llm.identity import fresh_name
from strikeloom.sinks.shared import shared_folder


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the trusted texts' model is within its language's limits.

    Each row is judged on its own text and language, rows without an id among them.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trusted = labels.where("quality = 1 AND toxic = 0").select("doc_id")
    return kneser_ney.accepted(docs, trusted).select(*docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one, however short.

    n_chars is counted anew in documents that lose lines; all other columns, whatever their names,
    stay as they are. Places are by id: rows of one id lose the same line numbers, and rows
    without an id lose none.
    """
    set_aside = {name: fresh_name("own") for name in docs.columns if name not in ("doc_id", "text")}
    result = line_dedup.without_repeated_lines(docs.withColumnsRenamed(set_aside), min_exact=1)
    if "n_chars" in set_aside:
        kind, own = docs.schema["n_chars"].dataType, set_aside["n_chars"]
        count = F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col(own))
        result = result.withColumn(own, count)
    back = [F.col(set_aside.get(name, name)).alias(name) for name in docs.columns]
    return result.select(*back)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 3-word shingles, at most 2 differing bits.

    Different texts under one id are different documents, and so are rows without an id.
    """
    return simhash.one_per_group(docs, shingle=3, max_bits=2).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminated(docs, items).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bucket, batch and place."""
    return packing.packed(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("simhash_dedup", near_deduplication),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# Perplexities and fingerprints are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in shared storage and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark)
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}_{name}")
        docs = spark.read.parquet(f"{folder}/{number}_{name}")
    return docs
