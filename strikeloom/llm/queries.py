"""The registered queries of the corpus operators: each on its whole table, with production settings."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strikeloom.llm import (
    compact_windows,
    decontamination,
    kneser_ney,
    language_cnn,
    line_dedup,
    packing,
    pii,
    quality_rules,
    simhash,
    suffix_dedup,
    vector_codes,
    warc,
    whitening,
)
from strikeloom.llm.sql import SQL
from strikeloom.sinks.shared import stored


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=3, max_bits=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(quality_rules.ledger(documents(spark, sf_dir)))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_lines",
        "n_shouted",
        "failures",
        quality_rules.failed(quality_rules.BASE).alias("base_failed"),
        (~quality_rules.failed(quality_rules.FULL)).alias("kept"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.without_repeated_lines(documents(spark, sf_dir), min_exact=1)
    return rows.select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256")
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.without_repeats(documents(spark, sf_dir), length=200)
    return rows.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contaminated(documents(spark, sf_dir), items)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        *[f"n_{kind}" for kind in pii.BASE_KINDS],
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
    )


def trusted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled good and not toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.where("quality = 1 AND toxic = 0").select("doc_id")


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classified(documents(spark, sf_dir), trusted_documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The grid of the query's SQL; every length can be a bucket's where no step is given.
    return packing.packed(documents(spark, sf_dir), step=64)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"), min_bytes=0)


def op10_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.near_passages(documents(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows, codebooks = vector_codes.compressed(vectors)
    digits = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return rows.select(
        "vec_id",
        digits.alias("code"),
        "error",
        "label_error",
        F.lit(vector_codes.digest(codebooks)).alias("codebooks_sha256"),
    )


def op12_language_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_cnn.predicted(documents(spark, sf_dir))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows


__all__ = ["QUERIES", "SQL"]

QUERIES = {
    query.__name__: query
    for query in (
        op1_simhash,
        op2_quality_rules,
        op3_line_dedup,
        op4_suffix_dedup,
        op5_decontamination,
        op6_pii,
        op7_kneser_ney,
        op8_packing,
        op9_warc,
        op10_compact_windows,
        op11_vector_codes,
        op12_language_cnn,
        op13_whitening,
    )
}
