"""Registered queries of this subpackage and their DuckDB SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickwave.llm import arc_to_warc, code_compression, decontamination, filter_audit, language_id, mixing, near_duplicates, personal_data, pitman_yor, quality_classifier, quality_rules, token_counts, token_records
from tickwave.session import ensure_checkpoint_dir

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


#: Rows a batch that goes to Python: whole texts are long, and a batch is built
#: in the executor's memory outside the heap.
ARROW_ROWS = 512


def prepare(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, str(min(ARROW_ROWS, int(spark.conf.get(name)))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op2_arc_to_warc")
def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_to_warc.archive_report(table(spark, sf_dir, "pages"))


@register("op3_source_mixing", mixing.ORACLE)
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@register("op4_personal_data")
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


@register("op5_decontamination", decontamination.ORACLE)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op6_token_records")
def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.token_records(table(spark, sf_dir, "documents"), tokenizer_path())


@register("op7_pitman_yor")
def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_texts(table(spark, sf_dir, "documents"))


@register("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@register("op9_near_duplicates")
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


@register("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op11_code_compression")
def op11_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_compression.compress(table(spark, sf_dir, "embeddings"))


@register("op12_token_counts")
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


@register("op13_filter_audit", filter_audit.ORACLE)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
