"""A corpus pipeline from the operators of cutframe.llm: each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutframe.llm import decontaminate, langid, neardup, packing, secrets
from cutframe.llm.common import ship_package, written
from cutframe.llm.queries import tokenizer_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those whose language is in doubt, of whatever length, go."""
    ship_package(spark)
    model = langid.fit(docs)
    told = langid.identify(docs, model, prefix="_told_")
    return told.filter((F.col("_told_lang_pred") != "und") & ~F.col("_told_ambiguous")).select(*docs.columns)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship_package(spark)
    return neardup.keep_one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship_package(spark)
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, one row per piece, with the ids."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_path(), keep=["doc_id"], with_ids=True)


STAGES = [("language_id", language_stage), ("minhash_neardup", neardup_stage), ("decontamination", decontamination_stage), ("secret_scan", secrets_stage), ("packing", packing_stage)]

#: Trained classifiers, tokenisation and latent retrieval are not SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
