"""The shuffle plan of the decontamination gives what the broadcast plan gives."""

import re

import pytest

from tests.llm.conftest import SF01
from tickwave.llm import decontamination as D

ITEMS = [(1, "one two three four"), (2, "漢字 漢字 漢字"), (3, "long words here " * 30), (4, None), (5, "   "),
         (None, "tab sep vt ff"), (6, "null id text with some words in it"), (7, "x" * 50_000), (8, "a")]


@pytest.fixture
def by_shuffle(spark, monkeypatch):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    stored = {}
    real = D.materialize
    monkeypatch.setattr(D, "materialize", lambda df, name: stored.setdefault(name, real(df, name)))
    yield stored
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _rows(df) -> list:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_awkward_rows(spark, awkward, request):
    # repeated rows and repeated null ids: each row comes back once
    docs = awkward.unionByName(awkward.filter("doc_id is null or doc_id in (4, 7)"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want, kept = _rows(D.decontaminate(docs, items)), _rows(D.drop_contaminated(docs, items))
    assert any(r[-1] for r in want) and len(kept) < len(want) == docs.count()
    stored = request.getfixturevalue("by_shuffle")
    assert _rows(D.decontaminate(docs, items)) == want
    assert "candidates" in stored
    stored.clear()
    assert _rows(D.drop_contaminated(docs, items)) == kept
    # no stored or broadcast side holds words
    for name in ("tokens", "anchors", "candidates"):
        assert all(not t.startswith("array") for _, t in stored[name].dtypes), name


def test_whole_table(spark, request):
    docs, items = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    want = _rows(D.decontaminate(docs, items))
    request.getfixturevalue("by_shuffle")
    assert _rows(D.decontaminate(docs, items)) == want


def test_texts_are_not_shuffled_by_shingle(spark, by_shuffle, monkeypatch):
    """The join with the anchors exchanges numbers; no exchange by shingle holds the words."""
    plans = []
    real = D.materialize

    def noted(df, name):
        if name == "candidates":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(D, "materialize", noted)
    docs, items = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    D.decontaminate(docs, items)
    assert plans and "SortMergeJoin [token" in plans[0]
    lines = plans[0].splitlines()
    for at, line in enumerate(lines):
        if "Exchange hashpartitioning(token" in line:
            below = next(x for x in lines[at + 1:] if "Project [" in x or "FileScan" in x)
            columns = below.split("[", 1)[1].split(", ")
            assert not any(re.fullmatch(r"w#\d+\]?", c) for c in columns), below
