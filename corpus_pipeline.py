"""A corpus pipeline over ``documents``: language ID, exact deduplication,
n-gram Jaccard join (one document of each group stays), secret scans (spans
are masked), best-fit packing. Each stage takes the rows its predecessor
wrote; all but the last return the columns of ``documents``.

Defined cases: rows without a letter (NULL and empty texts too) have no
language and go in the first stage; of equal texts, and of a component of near
copies, one row stays, repeated rows included; NULL ids are rows like any
other; a NULL ``n_chars`` stays NULL unless a span is masked; extra columns are
carried along under any name; an empty table gives no row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dqspark.llm import exact_dedup, lang_id, ngram_join, packing, secrets
from dqspark.llm.common import new_dir, ship


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted, by a model of the labelled rows."""
    ship(spark)
    return lang_id.keep_accepted(docs, lang_id.fit(lang_id.training_rows(docs)))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return ngram_join.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact_copies), ("ngram_jaccard_join", near_copies),
          ("secret_scan", secret_scan), ("best_fit_packing", best_fit_packing)]

ORACLE_SQL = None  # language ID, novelty and tokenizing are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
