"""Corpus pipeline: quality, near duplicates, decontamination, mixing, token files.

Every stage takes all rows that the one before kept and returns rows with the
columns of ``documents``; the last writes token files and returns what reading
them back gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickwave.llm import decontamination, mixing, near_duplicates, quality_classifier, token_records
from tickwave.llm.queries import prepare, table, tokenizer_path
from tickwave.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_classifier.good_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest doc_id."""
    prepare(spark)
    return near_duplicates.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0, 1 or 2 times)."""
    return mixing.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left; one row a document copy, from the files."""
    prepare(spark)
    return token_records.token_records(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_files", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, name)
    return docs


#: Not expressible in SQL (a learned classifier, a tokenizer); tests/llm compares
#: every stage with a brute-force version.
ORACLE_SQL = None
