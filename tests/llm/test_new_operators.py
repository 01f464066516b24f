"""Code compression, token counts and the filter audit against plain Python."""

import hashlib
import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import awkward_texts
from tickwave.llm import code_compression as C
from tickwave.llm import filter_audit as A
from tickwave.llm import token_counts as T
from tickwave.llm import words as W
from tickwave.llm.queries import QUERIES, tokenizer_path


# --- code compression -----------------------------------------------------

def brute_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, lab, [math.floor(4096 * x) for x in v]) for i, lab, v in rows
            if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    w = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * w:(p + 1) * w]
    books = [[cut(v, p) for _, _, v in kept[:entries]] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for _, _, v in kept:
                of.setdefault(nearest(v, p)[1], []).append(cut(v, p))
            for e, own in of.items():
                books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for i, lab, v in kept:
        best = [nearest(v, p) for p in range(parts)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    total = Counter()
    for _, lab, _, e in out:
        total[lab] += e
    return [(i, c, e, total[lab], sha) for i, lab, c, e in out]


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_codes_equal_brute_force(spark, sf01):
    src = spark.read.parquet(f"{sf01}/embeddings.parquet")
    want = brute_codes([(r.vec_id, r.label, r.embedding) for r in src.collect()])
    got = QUERIES["op11_code_compression"](spark, sf01)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert _sorted(got.collect()) == _sorted(want)


def test_codes_awkward(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 7)
    rng = np.random.default_rng(3)
    # few different values: many ties, repeated vectors and unused entries
    rows = [(int(i), None if i % 5 == 0 else int(i % 3), (rng.integers(-2, 3, 16) / 7).tolist()) for i in rng.permutation(90)]
    rows += [(3, 1, [0.5] * 16), (3, 1, [-0.5] * 16), (None, 1, [0.25] * 16), (200, None, None), (201, 1, []), (202, 1, [1.0] * 8),
             (203, 1, [float("nan")] * 16), (204, 1, [float("inf")] * 16), (205, 1, [None] * 16), (206, 1, [1.0] * 15), (207, 1, [9.5] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("code", F.lit("clash")).withColumn("salt", F.lit(1))
    f32 = [(i, lab, v and [None if x is None else float(np.float32(x)) for x in v]) for i, lab, v in rows]
    want = brute_codes(f32)
    assert _sorted(C.compress(df.repartition(3)).collect()) == _sorted(want) and len(want) == 94
    assert C.compress(df.limit(0)).count() == 0
    few = df.filter("vec_id IN (1, 2, 4)")
    assert _sorted(C.compress(few).collect()) == _sorted(brute_codes([r for r in f32 if r[0] in (1, 2, 4)]))
    huge = spark.createDataFrame([(1, 1, [1e30] * 16), (2, 1, [-1e30] * 16)], df.schema.simpleString()[7:-1].replace(":", " ").split(",code")[0])
    assert all(r.error == 0 for r in C.compress(huge).collect())


@pytest.mark.parametrize("spread", [1, 50, 4000])
def test_dual_tree_assignment(spread):
    rng = np.random.default_rng(spread)
    centers = rng.integers(-4000, 4000, (12, 6))
    points = centers[rng.integers(0, 12, 1500)] + rng.integers(-spread, spread + 1, (1500, 6))
    book = points[rng.integers(0, 1500, 16)]
    d = ((points[:, None] - book[None]) ** 2).sum(axis=2)
    want = d.argmin(axis=1)
    count, total, code = C.assign(C.Tree(points), C.entry_tree(book), codes=True)
    assert (code == want).all() and (count == np.bincount(want, minlength=16)).all()
    assert all((total[e] == points[want == e].sum(axis=0)).all() for e in range(16))


# --- token counts -----------------------------------------------------------

def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def test_token_counts_equal_library(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet").collect()
    tok = library()
    want = [(r.doc_id, len((r.text or "").encode()), n, n > 512) for r in docs
            for n in [len(tok.encode(r.text or "", add_special_tokens=False).ids)]]
    assert _sorted(QUERIES["op12_token_counts"](spark, sf01).collect()) == _sorted(want)


def test_token_counts_awkward(spark, awkward):
    tok = library()
    docs = awkward.withColumn("n_tokens", F.lit("clash"))
    want = [(r.doc_id, len((r.text or "").encode()), n, n > 512) for r in awkward.collect()
            for n in [len(tok.encode(r.text or "", add_special_tokens=False).ids)]]
    assert _sorted(T.token_counts(docs, tokenizer_path()).collect()) == _sorted(want)
    assert T.token_counts(docs.limit(0), tokenizer_path()).count() == 0


def test_units_and_merges_on_random_texts():
    rng = np.random.default_rng(2)
    parts = [" ", "  ", "\n", "\t", "\xa0", " ", "　", "\x85", "\x1c", "​", "a", "don't", "'s", "42", "½", "é", "漢字",
             "<|endoftext|>", "<|endo", "…", "“q”", "\r\n", "x" * 30, "\x0b", " ", "᠎", "Ab9", "😀", "\x00"]
    texts = ["".join(parts[j] for j in rng.integers(0, len(parts), rng.integers(0, 20))) for _ in range(4000)] + awkward_texts()
    tok, m = library(), T.Merger(tokenizer_path())
    got = m.counts(W.texts_of(pa.array(texts, pa.string())))
    assert got.tolist() == [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_other_tokenizers_are_refused(tmp_path):
    import public_tokenizers
    with pytest.raises(ValueError):
        T.Merger(public_tokenizers.path("word_bpe_49k.json"))


# --- filter audit -------------------------------------------------------------

def brute_audit(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    rows = []
    for i, t, s in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A"} if len(w) < 200 else set()
        fails |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        fails |= {"E"} if i is not None and i > first[t] else set()
        rows.append((s or "", fails, i in good, i in toxic))
    out = []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        removed = Counter()
        table = []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                removed[f] += len(gone)
                table.append((part, "".join(order), step, len(left), len(gone), sum(f in r[1] for r in own) - len(gone),
                              sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone), f))
        out += [(*row[:-1], removed[row[-1]]) for row in table]
    return out


def _audit_rows(rows):
    assert rows.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return _sorted(rows.collect())


def test_audit_equals_brute_force(spark, sf01):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf01}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf01}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert _audit_rows(QUERIES["op13_filter_audit"](spark, sf01)) == _sorted(brute_audit(docs, labels))


def test_audit_awkward(spark, awkward, monkeypatch):
    monkeypatch.setattr(A, "CHUNK", 64)  # several chunks of counters
    docs = awkward.withColumn("mask", F.lit("clash")).withColumn("part", F.lit(1)).withColumn("hash", F.lit(2))
    docs = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 50))  # every text again
    docs = docs.unionByName(docs.withColumn("source", F.lit(None).cast("string")))  # and every row again
    labels = [(3, 1, 0), (3, 0, 1), (7, None, 1), (None, 1, 1), (57, 1, None)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x"))
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    want = _sorted(brute_audit(rows, [x for x in labels if x[0] is not None]))
    assert _audit_rows(A.audit(docs.repartition(5), lab)) == want
    monkeypatch.setattr(A, "MOST_CELLS", 64)  # a filter that is full: every text is a possible repeat
    assert _audit_rows(A.audit(docs, lab)) == want
    assert A.audit(docs.limit(0), lab).count() == 0
    assert A.audit(docs, lab.limit(0)).filter("good_lost > 0 OR toxic_lost > 0").count() == 0


def test_prepass_clears_unique_texts(spark, tmp_path):
    n = 20_000
    flags = spark.range(n).select(F.xxhash64(F.when(F.col("id") % 100 == 0, F.lit(-1)).otherwise(F.col("id"))).alias("hash"))
    cells = A.CHUNK * -(-n * A.CELLS_A_TEXT // A.CHUNK)
    folder = f"file://{tmp_path}/filter"
    A.merged(A.sketches(flags.repartition(6), cells), folder)
    left = flags.filter(A.possible_repeat(folder, cells)("hash"))
    repeated = n // 100
    assert left.filter(F.col("hash") == F.xxhash64(F.lit(-1).cast("long"))).count() == repeated
    assert left.count() < repeated + 0.02 * n
