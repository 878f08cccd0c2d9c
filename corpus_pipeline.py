"""The corpus pipeline: documents -> language -> near-duplicates -> decontamination ->
personal data -> mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's documents. All but the last keep the columns of
``documents`` (and any further ones):

language_id     documents without a learned language (null text, no letter) go; ``lang`` is
                the predicted language
near_dedup      one document of each near-duplicate group stays
decontaminate   documents that hold a passage of a benchmark item go
redact_pii      personal data in ``text`` is replaced by its kind; ``n_chars`` follows
mix_sources     per document its size and how many words the mix takes of it

Null texts, blank or very long texts, ties, repeated rows, empty tables and extra columns
are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import decontam, langid, mixing, neardup, pii
from tarmac.llm.common import staged, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = langid.with_language(docs, langid.train(docs), "_language_found")
    kept = found.filter(F.col("_language_found.lang_pred") != "und")
    return kept.withColumn("lang", F.col("_language_found.lang_pred")).drop("_language_found")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redacted(docs, pii.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("redact_pii", redact_pii),
    ("mix_sources", mix_sources),
]

# Trained models and hashed similarity have no SQL form; tests/llm/test_pipeline.py holds
# the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
