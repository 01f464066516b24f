"""Training samples are bounded by documents, whatever their rows."""

from pyspark.sql import functions as F

from tickwave.llm import doc_statistics as D


def test_repeated_doc_id_is_one_row(spark):
    docs = spark.range(400).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("doc_id"),
                                   F.concat_ws(" ", F.lit("word"), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).distinct()
    x, y = D.labelled_sample(D.document_statistics(docs), labels, "quality", 1000)
    assert len(x) == len(y) == 101


def test_share_never_falls_to_zero():
    assert D.sample_cells(1500, 2_000_000_000) == 1 and D.sample_cells(1500, 3000) == 1 << 19 and D.sample_cells(5, 1) == 1 << 20
