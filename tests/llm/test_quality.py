import re

import pytest
from pyspark.sql import functions as F

from tickwave.llm import quality_classifier as Q
from tickwave.llm import quality_rules as R
from tickwave.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i:i + 5]), []).append(i)
    hit = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def check_counts(docs, out):
    texts = sorted(((r.doc_id is None, r.doc_id or 0, brute(r.text)) for r in docs.collect()))
    got = []
    for r in out.collect():
        c = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
        got.append((r.doc_id is None, r.doc_id or 0, c))
    assert sorted(got) == texts


def test_rules_counts_equal_brute_force(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    check_counts(docs, QUERIES["op10_quality_rules"](spark, sf01))


def test_rules_on_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = R.apply_rules(awkward.withColumn("n_words", F.lit("clash")).withColumn("rule", F.lit(1)), labels)
    check_counts(awkward, out)
    assert R.apply_rules(awkward.limit(0), labels).count() == 0


@pytest.mark.parametrize("name,held", [("op10_quality_rules", "kept"), ("op1_quality_classifier", "predicted = 1")])
def test_verdicts_follow_labels(spark, sf01, name, held):
    labels = spark.read.parquet(f"{sf01}/labels.parquet")
    out = QUERIES[name](spark, sf01)
    rows = out.join(labels, "doc_id").filter(f"{held} = (quality = 1)").count()
    n = out.join(labels, "doc_id").count()
    assert rows >= 0.97 * n


def test_classifier_held_out_accuracy(spark, sf01):
    import zlib
    out = QUERIES["op1_quality_classifier"](spark, sf01)
    rows = out.join(spark.read.parquet(f"{sf01}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum((r.score >= 0.7) == (r.quality == 1) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_classifier_on_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(15)] + [(None, 1, 1), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    extra = awkward.withColumn("score", F.lit("clash")).withColumn("quality", F.lit(9))
    assert Q.classify(extra, labels).count() == awkward.count()
    none = Q.classify(extra, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert Q.classify(extra.limit(0), labels).count() == 0
