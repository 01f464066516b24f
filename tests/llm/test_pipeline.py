"""Every stage against a brute-force version of it over its own input."""

from collections import Counter

import corpus_pipeline as P
from pyspark.sql import functions as F

from tests.llm.test_files import report
from tests.llm.test_near_duplicates import brute
from tests.llm.test_sql_queries import fold
from tickwave.llm import mixing, quality_classifier

#: Names that the stages use for columns of their own.
CLASHES = ["extra", "_key", "_d", "_k", "_row", "row", "key", "id", "sha", "size", "place", "number", "copy", "copies", "name", "bucket",
           "mix_copy", "mix_size", "mix_target", "mix_source_size", "mix_copies", "source_size", "target", "n", "w", "rep", "c", "score",
           "predicted", "held_out", "n_words", "label", "quality"]


def test_stages(spark, sf01, tmp_path):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    inputs = []
    for name, stage in P.STAGES:
        inputs.append(docs)
        out = stage(spark, docs, sf01)
        if name != "token_files":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    good, single, clean, mixed = ([tuple(r) for r in d.select("doc_id", "text").collect()] for d in inputs[1:])

    scored = quality_classifier.classify(inputs[0], spark.read.parquet(f"{sf01}/labels.parquet"))
    assert Counter(i for i, _ in good) == Counter(r.doc_id for r in scored.filter("predicted = 1").collect())
    groups = brute(good)
    assert Counter(i for i, _ in single) == Counter(i for i, (_, c) in groups.items() if i == c)

    items = [fold(r.text) for r in spark.read.parquet(f"{sf01}/benchmark.parquet").collect()]
    windows = {tuple(w[i:i + 10]) for w in items if w for i in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}
    dirty = {i for i, t in single if any(tuple(w[s:s + n]) in windows for w in [fold(t)] for n in sizes for s in range(len(w) - n + 1))}
    assert dirty and Counter(i for i, _ in clean) == Counter(i for i, _ in single if i not in dirty)

    plan = mixing.mix_plan(inputs[3]).select("doc_id", "mix_copies").collect()
    assert Counter(i for i, _ in mixed) == Counter({r.doc_id: r.mix_copies for r in plan if r.mix_copies})
    assert sorted((tuple(r) for r in docs.collect()), key=str) == report(mixed)


def test_run_equals_stages_and_awkward_rows(spark, sf01, awkward):
    assert P.run(spark, sf01).count() > 500
    docs = awkward
    for name in CLASHES:
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    for name, stage in P.STAGES:
        out = stage(spark, docs, sf01)
        if name != "token_files":
            assert out.columns == docs.columns
            assert all(r[c] == f"own {c}" for r in out.collect() for c in CLASHES)
        assert stage(spark, docs.limit(0), sf01).count() == 0
    # the two texts of doc_id 4 have nothing in common
    assert P.near_dedup(spark, docs, sf01).filter("doc_id = 4").count() == 2
