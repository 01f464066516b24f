import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwave.llm import pitman_yor as Y
from tickwave.llm.queries import QUERIES


def toks(text):
    return [*(text or "").encode().lower().split(), None]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def check(docs, got):
    c = Counter(t for r in docs if not held(r.doc_id) for t in toks(r.text))
    n, v = sum(c.values()), len(c)
    want = []
    for r in docs:
        t = toks(r.text)
        want.append((r.doc_id is None, r.doc_id or 0, len(t), sum(c[x] > 0 for x in t), n, held(r.doc_id), sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t)))
    rows = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, r.held_out, r.base_score) for r in got)
    want.sort()
    assert [x[:6] for x in rows] == [x[:6] for x in want]
    assert all(a[6] == pytest.approx(b[6], rel=1e-9) for a, b in zip(rows, want))
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_query(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet").collect()
    got = QUERIES["op7_pitman_yor"](spark, sf01).collect()
    check(docs, got)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > 0.9 * sum(r.base_score for r in out)  # both negative
    assert sorted((r.doc_id, r.score) for r in QUERIES["op7_pitman_yor"](spark, sf01).collect()) == sorted((r.doc_id, r.score) for r in got)


def test_awkward(spark, awkward):
    docs = awkward.withColumn("shard", F.lit("clash")).withColumn("block", F.lit(1)).withColumn("n", F.lit(2))
    check(awkward.collect(), Y.score_texts(docs).collect())
    assert Y.score_texts(docs.limit(0)).count() == 0
    only = [i for i in range(60) if held(i)]
    none = Y.score_texts(spark.createDataFrame([(i, "some words") for i in only], "doc_id long, text string")).collect()
    assert {r.train_tokens for r in none} == {0} and all(r.n_known == 0 for r in none)


def test_probabilities_sum_to_one():
    """Over known words and the unseen one, for every context, in one state."""
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 60, (40, 64))
    counts[3] = 0
    counts[3, 5] = 100_000  # a frequent word, seated in blocks
    counts = counts[:, :8]
    tables = np.stack([Y.reseat(counts[:, c], np.full(40, 0.3), Y.DISCOUNT[1], rng) for c in range(8)], 1)
    assert ((tables > 0) == (counts > 0)).all() and (tables <= counts).all()
    guests = tables.sum(1)
    root = Y.reseat(guests, np.full(40, 0.2), Y.DISCOUNT[0], rng)
    v = int((counts.sum(1) > 0).sum())
    new = (Y.STRENGTH[0] + Y.DISCOUNT[0] * root.sum()) / (v + 1)
    parent = (guests - Y.DISCOUNT[0] * root + new) / (Y.STRENGTH[0] + guests.sum())
    unseen = new / (Y.STRENGTH[0] + guests.sum())
    for c in range(8):
        back = Y.STRENGTH[1] + Y.DISCOUNT[1] * tables[:, c].sum()
        p = (counts[:, c] - Y.DISCOUNT[1] * tables[:, c] + back * parent) / (Y.STRENGTH[1] + counts[:, c].sum())
        rest = back * unseen / (Y.STRENGTH[1] + counts[:, c].sum())
        assert p[counts.sum(1) > 0].sum() + rest == pytest.approx(1, rel=1e-9)
    many = Y.reseat(np.full(4000, 500), np.full(4000, 2.0), 0.5, rng).mean()
    one, Y_one = Y.ONE_BY_ONE, None  # noqa: F841
    Y.ONE_BY_ONE = 10_000
    exact = Y.reseat(np.full(4000, 500), np.full(4000, 2.0), 0.5, rng).mean()
    Y.ONE_BY_ONE = one
    assert many == pytest.approx(exact, rel=0.03)


def one_by_one(docs, sweeps=40, burn=10):
    """Log10 probability of each text by a plain two-level restaurant sampler in
    which every customer is taken from its table and seated again."""
    r = random.Random(5)
    pairs = Counter()
    for _, text in (d for d in docs if not held(d[0])):
        before = ""
        for t in toks(text):
            pairs[before, t] += 1
            before = t
    seats = {p: [] for p in pairs}  # tables of a context's dish
    root = {w: [] for _, w in pairs}
    v = len(root)

    def p_root(w):
        n, t = sum(map(sum, root.values())), sum(map(len, root.values()))
        return (max(0, sum(root.get(w, ())) - Y.DISCOUNT[0] * len(root.get(w, ()))) + (Y.STRENGTH[0] + Y.DISCOUNT[0] * t) / (v + 1)) / (Y.STRENGTH[0] + n)

    def sit(tables, discount, new):
        k = r.choices(range(len(tables) + 1), [x - discount for x in tables] + [new])[0]
        if k == len(tables):
            tables.append(1)
            return True
        tables[k] += 1
        return False

    def leave(tables):
        k = r.choices(range(len(tables)), tables)[0]
        tables[k] -= 1
        if not tables[k]:
            del tables[k]
            return True
        return False

    def of(c):
        mine = [x for (b, _), x in seats.items() if b == c]
        return sum(map(sum, mine)), sum(map(len, mine))

    def root_sit(w):
        t = sum(map(len, root.values()))
        sit(root[w], Y.DISCOUNT[0], (Y.STRENGTH[0] + Y.DISCOUNT[0] * t) / (v + 1))

    everyone = [p for p, n in pairs.items() for _ in range(n)]
    total = Counter()
    asked = {(b, t) for _, text in docs for b, t in zip(["", *toks(text)], toks(text))}
    for sweep in range(sweeps):
        for c, w in everyone:
            if sweep and leave(seats[c, w]):
                leave(root[w])
            if sit(seats[c, w], Y.DISCOUNT[1], (Y.STRENGTH[1] + Y.DISCOUNT[1] * of(c)[1]) * p_root(w)):
                root_sit(w)
        if sweep >= burn:
            for c, w in asked:
                n, t = of(c)
                mine = seats.get((c, w), ())
                total[c, w] += (sum(mine) - Y.DISCOUNT[1] * len(mine) + (Y.STRENGTH[1] + Y.DISCOUNT[1] * t) * p_root(w)) / (Y.STRENGTH[1] + n)
    return {i: sum(math.log10(total[b, t] / (sweeps - burn)) for b, t in zip(["", *toks(text)], toks(text))) for i, text in docs}


def test_one_by_one(spark):
    """The scores of a small corpus are near those of the plain sampler."""
    r = random.Random(9)
    docs = [(i, " ".join(r.choices(["a", "b", "cc", "d", "e"], [8, 4, 2, 1, 1], k=6))) for i in range(24)]
    want = one_by_one(docs)
    got = {x.doc_id: x.score for x in Y.score_texts(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert sum(got.values()) == pytest.approx(sum(want.values()), rel=0.03)
    assert all(got[i] == pytest.approx(want[i], rel=0.1) for i in want)


def test_spread_contexts(spark):
    """Contexts spread over shards give the scores of whole ones, but for sampling."""
    r = random.Random(4)
    rows = [(i, " ".join(r.choices([f"w{x}" for x in range(60)], [60 / (x + 1) for x in range(60)], k=80))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {x.doc_id: x.score for x in Y.score_texts(docs).collect()}
    for i, s in {x.doc_id: x.score for x in Y.score_texts(docs, hot=20).collect()}.items():
        assert s == pytest.approx(whole[i], rel=0.02)


def test_packed_pairs():
    rng = np.random.default_rng(2)
    for n in (0, 1, 1000):
        p = np.unique(rng.integers(0, 1 << 40, (n, 2)) >> rng.integers(0, 38, (n, 2)), axis=0) if n else np.zeros((0, 2), np.int64)
        x, y = p[:, 0].copy(), p[:, 1].copy()
        a, b = Y.unpack_pairs(*Y.pack_pairs(x, y))
        assert (a == x).all() and (b == y).all()
