import zlib

from pyspark.sql import functions as F

from tickwave.llm import language_id as L
from tickwave.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    rows = QUERIES["op8_language_id"](spark, sf01).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_awkward_rows(spark, sf01, awkward):
    docs = spark.read.parquet(f"{sf01}/documents.parquet").filter("doc_id >= 100").select("doc_id", "text", "lang")
    odd = awkward.select("doc_id", "text", F.lit(None).cast("string").alias("lang"))
    mixed = docs.unionByName(odd).withColumn("letter", F.lit("clash")).withColumn("score", F.lit("x"))
    got = L.identify(mixed).filter("doc_id < 100 or doc_id is null").collect()
    assert len(got) == awkward.count()
    by = {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id not in (3, 4)}
    assert by[0] == by[1] == by[2] == by[8] == ("und", 0.0)
    assert by[None][0] != "und"
    assert {r.lang_pred for r in L.identify(odd).collect()} == {"und"}
    assert L.identify(odd.limit(0)).count() == 0
    one = L.identify(docs.withColumn("lang", F.lit("xx")).unionByName(odd)).filter("doc_id >= 100").collect()
    assert {r.lang_pred for r in one} == {"xx"}


def test_families_come_first():
    assert L.family_of("de") == L.family_of("en-GB") != L.family_of("fr")
    assert L.family_of("tlh") == "tlh"
