import random

from pyspark.sql import functions as F

from tickwave.llm import near_duplicates as N
from tickwave.llm.queries import QUERIES


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """{doc_id: (size, component)} by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    tried = set()
    for ids in holders.values():
        for n, a in enumerate(ids):
            for b in ids[n + 1:]:
                if (a, b) not in tried:
                    tried.add((a, b))
                    inter = len(sets[a] & sets[b])
                    if 100 * inter >= 85 * len(sets[a] | sets[b]):
                        x, y = sorted((root(a), root(b)))
                        parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_equals_brute_force(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet").select("doc_id", "text").collect()
    want = brute([(r.doc_id, r.text) for r in docs])
    got = QUERIES["op9_near_duplicates"](spark, sf01).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len(got) == len(docs) and all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert sum(not r.kept for r in got) > 50


def test_chains_and_near_groups(spark):
    """A chain whose ends do not link, a large near group, copies, bystanders."""
    rng = random.Random(5)
    word = lambda: "w%d" % rng.randrange(5000)
    base = [word() for _ in range(300)]
    rows, n = [], 0
    for step in range(12):  # each differs from the one before by a few words
        base[step * 20] = "c%d" % step
        rows.append((n, " ".join(base)))
        n += 1
    hub = [word() for _ in range(200)]
    for _ in range(60):
        t = list(hub)
        for _ in range(rng.randrange(0, 5)):
            t[rng.randrange(200)] = word()
        rows.append((n, " ".join(t)))
        n += 1
    rows += [(n + i, rows[3][1]) for i in range(30)]
    rows += [(n + 30 + i, " ".join(word() for _ in range(rng.randrange(1, 60)))) for i in range(40)]
    rng.shuffle(rows)
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_awkward_rows(spark, awkward):
    extra = awkward.withColumn("n", F.lit("clash")).withColumn("rep", F.lit(1)).withColumn("component", F.lit(2))
    got = N.near_duplicates(extra).collect()
    assert len(got) == awkward.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id, r.kept))
    assert by[0] == {(0, 0, True)} and by[1] == {(0, 1, True)} and by[2] == {(0, 2, True)}
    assert by[3] == {(1, 3, True)} and by[4] == {(2, 4, True)}  # 'another text...' sorts first
    assert by[12] == {(6, 11, False)} and by[None] == {(4, None, True)}
    assert N.near_duplicates(extra.limit(0)).count() == 0


def test_sketch_agreement_is_close_to_similarity():
    import numpy as np
    rng = np.random.default_rng(3)
    for size in (30, 200, 2000):
        x = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        y = np.concatenate((x[: int(size * 0.9)], rng.integers(0, 1 << 63, size // 10, dtype=np.uint64)))
        j = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        s = N.sketches(np.concatenate((x, y)), np.repeat([0, 1], [len(x), len(y)]), 2, 128)
        assert (s < np.iinfo(np.uint64).max).all()
        assert abs((s[0] == s[1]).mean() - j) < 0.13


def test_prefix_join_equals_brute_force(spark, monkeypatch):
    """A group of near copies around the threshold, forced through every step."""
    monkeypatch.setattr(N, "LEAST_GAIN", 0.0)  # one hub round
    monkeypatch.setattr(N, "LISTED_ROWS", 2)
    rng = random.Random(9)
    word = lambda: "w%d" % rng.randrange(9000)
    base, rows = [word() for _ in range(150)], []
    for i in range(150):
        t = list(base)
        for _ in range(rng.randrange(0, 7)):
            t[rng.randrange(150)] = word()
        rows.append((i, " ".join(t)))
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) > 3


def test_prefix_rows_grow_with_documents(spark):
    """Five times the documents of a group of near copies: candidates of the last
    join stay in proportion to the rows they come from."""
    def made(n):
        rng = random.Random(7)
        word = lambda: "w%d" % rng.randrange(90_000)
        base, rows, seen = [word() for _ in range(60)], [], {}
        for i in range(n):
            t = list(base)
            for _ in range(rng.randrange(0, 4)):
                t[rng.randrange(60)] = word()
            rows.append((i, " ".join(t)))
        keep = N.materialize

        def watch(df, name="stage"):
            out = keep(df, name)
            seen[name] = seen.get(name, 0) + (out.count() if name in ("pairs", "prefixes") else 0)
            return out

        N.materialize = watch
        try:
            got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        finally:
            N.materialize = keep
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)
        return seen

    few, many = made(80), made(400)
    assert many.get("pairs", 0) < 8 * max(few.get("pairs", 0), 80)


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    words = lambda a, n=40: " ".join(f"{a}{i}" for i in range(n))
    rows = [(1, words("a"), "x"), (1, words("b"), "y"), (1, words("a"), "x"), (2, words("b"), "z"), (2, words("c"), "z"), (3, None, "n"),
            (3, None, "n"), (None, words("a"), "n"), (4, words("a", 41), "w"), (5, words("d"), "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string").withColumn("key", F.lit(1)).withColumn("row", F.lit(2))
    out = N.drop_near_duplicates(df)
    assert out.columns == df.columns
    got = sorted((r.doc_id or 0, (r.text or "-")[0], r._row, r.key, r.row) for r in out.collect())
    assert got == [(0, "a", "n", 1, 2), (1, "a", "x", 1, 2), (1, "b", "y", 1, 2), (2, "c", "z", 1, 2), (3, "-", "n", 1, 2), (5, "d", "v", 1, 2)]
    assert N.drop_near_duplicates(df.limit(0)).count() == 0
