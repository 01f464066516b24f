"""Queries with SQL equal it; the same operators against plain Python on awkward rows."""

import hashlib
import re


import pytest
from pyspark.sql import functions as F


from tickwave.llm import decontamination as D
from tickwave.llm import mixing as M
from tickwave.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf01, name):
    import duckdb
    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf01}/{t}.parquet'")
    rel = c.sql(ORACLES[name])
    out = QUERIES[name](spark, sf01)
    cols = sorted(out.columns)
    assert cols == sorted(rel.columns)
    want = sorted(c.sql(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall(), key=str)
    got = sorted((tuple(r) for r in out.select(*cols).collect()), key=str)
    assert got == want


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def test_decontamination_awkward(spark, awkward):
    items = [(1, "long words here long words here LONG words here long"), (2, "one two"), (10, "a"), (3, None), (4, "..."),
             (None, "漢字 漢字 漢字"), (5, "nowhere to be found at all in these documents here ok"), (2, "a b c d e f a b c")]
    docs = awkward.withColumn("key", F.lit("clash")).withColumn("window", F.lit(1)).withColumn("words", F.lit(2))
    got = D.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string").withColumn("w", F.lit("x"))).collect()
    want = []
    for r in awkward.collect():
        w, hits, ids = fold(r.text), set(), set()
        for i, t in items:
            v = fold(t)
            n = min(10, len(v))
            for o in range(len(v) - n + 1 if n else 0):
                for s in range(len(w) - n + 1):
                    if w[s:s + n] == v[o:o + n]:
                        hits |= set(range(s, s + n))
                        ids |= {str(i)} if i is not None else set()
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        want.append((r.doc_id, len(w), len(hits), len(ids), sha, bool(hits)))
    key = lambda x: (x[0] is None, x[0] or 0, x)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert D.decontaminate(docs.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    none = D.decontaminate(docs, spark.createDataFrame([], "item_id long, text string")).collect()
    assert len(none) == awkward.count() and not any(r.contaminated for r in none)


def test_mixing_targets_and_copies(spark, sf01, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", 50)  # several buckets in every source
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    rows = M.mix_report(docs).collect()
    assert len(rows) == docs.count()
    source = {r.doc_id: r.source for r in docs.collect()}
    by = {}
    for r in rows:
        by.setdefault(source[r.doc_id], []).append(r)
        assert r.taken in (0, r.size, 2 * r.size)
    sizes = {s: sum(r.size for r in v) for s, v in by.items()}
    weight = dict(zip(sorted(sizes), [3, 1, 2] * len(sizes)))
    left, free, want = 1.5 * sum(sizes.values()), set(sizes), {}
    while True:  # share again and again, as stated
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
        free -= over
    want |= {s: level * weight[s] for s in free}
    for s, v in by.items():
        assert all(r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * want[s] for r in v)
        # every bucket is within its largest document of its share
        assert abs(sum(r.taken for r in v) - want[s]) < 3 * max(r.size for r in v)
    again = M.mix_report(docs.orderBy(F.desc("doc_id")).repartition(3)).collect()
    assert sorted(again) == sorted(rows)
    taken = {r.doc_id: r.taken // r.size for r in rows if r.size}
    emitted = {r.doc_id: r["count"] for r in M.mix(docs).groupBy("doc_id").count().collect()}
    assert {i: n for i, n in taken.items() if n} == {i: n for i, n in emitted.items() if i in taken}


def test_mixing_awkward(spark, awkward):
    docs = awkward.withColumn("size", F.lit("clash")).withColumn("bucket", F.lit(1)).withColumn("mix_copies", F.lit(5))
    rows = M.mix_report(docs).collect()
    assert len(rows) == awkward.count()
    assert all(r.taken <= 2 * r.size for r in rows)
    assert M.mix_report(docs.limit(0)).count() == 0
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    assert M.mix(docs.select("doc_id", "text", F.lit(None).cast("string").alias("source"))).count() > 0
