"""MinHash near-duplicate detection by fast similarity sketching.

Each document's set of word shingles is sketched into ``bins`` coordinates:
round i hashes every element to a bin and a value, a bin keeps the smallest
(round, value), and rounds go on until every bin of the document is filled.
Rounds ``bins`` to ``2 * bins - 1`` send every element to one fixed bin, so all
bins are filled after ``2 * bins`` rounds at the latest.  Coordinates of two
sketches agree with probability close to the Jaccard similarity, with
Chernoff-like concentration.

Banding proposes candidates (``rows`` equal coordinates in one band), and each
candidate is confirmed on the documents' full shingle sets.  With 32 bands of
6 rows a pair at the threshold 0.85 is missed with probability 3e-7.

Scale: documents with equal sets are collapsed to one representative before
any pairing, so a group of copies costs one row.  Within a band bucket each
round verifies links to one hub only, then merges components; buckets that lie
in one component drop out.  After the first merge, buckets of a few rows list
their cross pairs and are settled.  Large ones go on with hubs while that merges
much, and the members left in them are joined by prefix filtering: a set that reaches the threshold with another one
shares one of its rarest ``n - ceil(0.85 n) + 1`` elements, whatever the order
of rarity, at places that leave room for enough shared elements.  So a large group of near copies costs linear work, members with
many own words pair with nobody, and no link that could join two components is
lost.  Two bits of every coordinate travel with a bucket row, and a pair whose
bits differ too much is dropped inside the join.  Prefix rows also carry the
parities of the set's elements in hashed cells: each element of only one of two
sets flips one cell, so as many elements differ as cells do, or more, and a pair
with too many differing cells is dropped without loss.  Texts move only for
documents in some remaining pair.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwave.llm import words as W
from tickwave.operators.ordered import numbered
from tickwave.session import materialize

BINS, ROWS = 192, 6
WORDS, PERCENT = 5, 85
#: Chance, at most, that a pair at the threshold is lost by the bands, and by
#: the comparison of two bits of every coordinate that comes before verification.
BAND_MISS, BIT_MISS = 1e-6, 1e-9
#: Buckets with at most so many rows list their cross pairs (fewer than half as many a row).
LISTED_ROWS = 16
#: Hub rounds end when one leaves more than this share of the cross pairs; the rest is joined by prefixes.
LEAST_GAIN = 0.9
#: Rarity of elements is counted in so many hashed cells (4 bytes each, sent to
#: every task); any order gives right results, a finer one fewer candidates.
RARITY_CELLS = 1 << 20
#: Cells of a set's element parities, a multiple of 64; few cells only let more pairs through.
PARITY_CELLS = 512
#: Texts are sketched, counted and compared in slices of so many bytes (about 60
#: bytes of temporaries each): two workers share an executor's memory with a full heap.
SLICE_BYTES = 512 << 10
#: Ids of documents to fetch texts for are broadcast (8 bytes each) up to here.
BROADCAST_IDS = 2_000_000


def bit_limit(bins: int, percent: int) -> int:
    """Bits that may differ: the smallest number that a pair at the threshold
    exceeds with probability below ``BIT_MISS``, by the exact distribution.  A
    coordinate differs with probability q, and then each of its bits with 1/2."""
    q = 1 - percent / 100
    p = np.ones(1)
    for _ in range(bins):
        p = np.convolve(p, [1 - 0.75 * q, 0.5 * q, 0.25 * q])
    return int(np.flatnonzero(np.concatenate((np.cumsum(p[::-1])[::-1][1:], [0.0])) < BIT_MISS)[0])


def band_rows(bins: int, percent: int) -> int:
    """Most rows a band, up to ``ROWS``, with which bands lose a pair at the
    threshold with probability below ``BAND_MISS``."""
    fits = [r for r in range(1, ROWS + 1) if bins % r == 0 and (1 - (percent / 100) ** r) ** (bins // r) < BAND_MISS]
    return max(fits, default=1)


def _seed(i: int) -> np.uint64:
    return np.uint64(0xD6E8FEB86659FD93 * i % (1 << 64))


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    t = W.texts_of(texts)
    t.data = W.FOLD[t.data]
    r = W.runs(t, W.SPACES)
    return W.distinct_by_doc(*W.shingles(W.hashes(t, r), r.doc, len(t), k))


def sketches(h: np.ndarray, doc: np.ndarray, n_docs: int, bins: int) -> np.ndarray:
    """(n_docs, bins) coordinates; rows of documents without elements stay at
    the largest value."""
    empty = np.iinfo(np.uint64).max
    out = np.full(n_docs * bins, empty, np.uint64)
    for i in range(2 * bins):
        if not len(h):
            break
        x = W.mix(h + _seed(2 * i + 1))
        place = (x >> np.uint64(8)) % np.uint64(bins) if i < bins else np.uint64(i - bins)
        value = (np.uint64(i) << np.uint64(55)) | (W.mix(x + _seed(1)) >> np.uint64(10))
        np.minimum.at(out, doc * bins + place.astype(np.int64), value)
        open_ = (out.reshape(n_docs, bins) == empty).any(axis=1)
        if not open_.all():
            go_on = open_[doc]
            h, doc = h[go_on], doc[go_on]
    return out.reshape(n_docs, bins)


def _describe(k: int, bins: int, rows: int):
    bands, longs = bins // rows, 2 * bins // 64

    def run(batches):
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for lo, hi in W.slices(texts, SLICE_BYTES):
                h, doc = shingle_sets(texts.slice(lo, hi - lo), k)
                n = np.bincount(doc, minlength=hi - lo)
                sig = [np.zeros(hi - lo, np.uint64) for _ in range(2)]
                for j, s in enumerate(sig):  # a set's signature: 128-bit sum of element hashes
                    np.add.at(s, doc, W.mix(h + _seed(1000 + j)))
                s = sketches(h, doc, hi - lo, bins)
                band = np.tile(np.arange(bands, dtype=np.uint64), (hi - lo, 1))
                for j in range(rows):
                    band = W.mix(band + s[:, j::rows] + np.uint64(j + 1))
                bits = np.unpackbits(W.mix(s).view(np.uint8).reshape(hi - lo, bins, 8)[:, :, :1], axis=2)[:, :, :2]
                bits = np.packbits(bits.reshape(hi - lo, 2 * bins), axis=1)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, hi - lo), pa.array(n, pa.int64()),
                    pa.array(sig[0].view(np.int64)), pa.array(sig[1].view(np.int64)),
                    pa.ListArray.from_arrays(np.arange(0, (hi - lo) * bands + 1, bands, dtype=np.int32),
                                             pa.array(band.view(np.int64).ravel())),
                    pa.ListArray.from_arrays(np.arange(0, (hi - lo) * longs + 1, longs, dtype=np.int32),
                                             pa.array(bits.view(np.int64).ravel())),
                ], names=["doc_id", "n", "s0", "s1", "bands", "bits"])

    return run


def _confirm(k: int, percent: int):
    """Rows (a, b, text_a, text_b) -> (a, b) whose full sets meet the threshold."""
    def run(batches):
        for b in batches:
            a_id, b_id, ta, tb = (b.column(i) for i in range(4))
            size = np.diff(W.texts_of(ta).offset) + np.diff(W.texts_of(tb).offset)
            low = 0
            while low < b.num_rows:
                high = low + max(1, int(np.searchsorted(np.cumsum(size[low:]), SLICE_BYTES, "right")))
                n = min(high, b.num_rows) - low
                both = pa.concat_arrays([x.slice(low, n).cast(pa.large_string()) for x in (ta, tb)])
                h, doc = shingle_sets(both, k)
                count = np.bincount(doc, minlength=2 * n)
                pair = doc % n  # an element that occurs twice for a pair is in both sets
                order = np.lexsort((h, pair))
                hs, ps = h[order], pair[order]
                same = (hs[1:] == hs[:-1]) & (ps[1:] == ps[:-1])
                inter = np.bincount(ps[1:][same], minlength=n)
                union = count[:n] + count[n:] - inter
                ok = pa.array((100 * inter >= percent * union) & (union > 0))
                yield pa.RecordBatch.from_arrays(
                    [a_id.slice(low, n).filter(ok), b_id.slice(low, n).filter(ok)], names=["a", "b"])
                low += n

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the graph with edges (a, b): every node takes the
    smallest label around it, then labels jump to their label's label; stored
    after each round, so lineage stays short.  Labels never leave the cluster."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = (both.join(labels, F.col("a") == F.col("node"))
                .groupBy(F.col("b").alias("n2")).agg(F.min("component").alias("near")))
        step = labels.join(near, F.col("node") == F.col("n2")).select(
            "node", F.least("component", "near").alias("component"), F.col("component").alias("old"))
        up = step.select(F.col("node").alias("m"), F.col("component").alias("up"))
        step = materialize(step.join(up, F.col("component") == F.col("m"), "left").select(
            "node", F.coalesce("up", "component").alias("component"), "old"), "labels")
        if not step.filter("component <> old").limit(1).count():
            return step.select("node", "component")
        labels = step.select("node", "component")


def _linked(reps: DataFrame, src: DataFrame, k: int, percent: int, bins: int) -> DataFrame:
    """(node, component) of representatives that have a link to another one."""
    slots = reps.select("rep", F.explode("bands").alias("h"))
    shared = slots.groupBy("h").agg(F.count("*").alias("m")).filter("m > 1").select("h")
    info = reps.select("rep", "n", "bits")
    open_ = materialize(slots.join(shared, "h").join(info, "rep").withColumn("c", F.col("rep")), "buckets")
    limit = bit_limit(bins, percent)
    differ = sum((F.bit_count(F.get("bits", F.lit(i)).bitwiseXOR(F.get("bits2", F.lit(i))))
                  for i in range(2 * bins // 64)), F.lit(0))
    fits = (F.col("c") != F.col("c2")) & (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")) & (differ <= limit)
    found, tested = None, None
    turn, left, listed = 0, None, False
    while True:
        # buckets that still hold several components, and their cross pairs
        by = (open_.groupBy("h", "c").agg(F.count("*").cast("double").alias("k"))
              .groupBy("h").agg(F.sum("k").alias("m"), F.sum(F.col("k") * F.col("k")).alias("own"), F.count("*").alias("parts"))
              .filter("parts > 1"))
        by = materialize(by, "mixed")
        large = F.col("m") > LISTED_ROWS
        sums = by.agg(F.sum("m").alias("m"), F.sum(F.when(large, (F.col("m") * F.col("m") - F.col("own")) / 2)).alias("pairs")).first()
        if not sums["m"]:
            break
        rest = materialize(open_.join(by.select("h", large.alias("large")), "h"), "open")
        pairs = []
        if turn and not listed:  # after one merge, small buckets are settled once and for all
            small = rest.filter("not large")
            second = small.select("h", *(F.col(x).alias(f"{x}2") for x in ("rep", "n", "bits", "c")))
            pairs.append(small.join(second, "h").filter((F.col("rep") < F.col("rep2")) & fits))
            listed = True
        # hubs merge what is left until they hardly do any more
        cross = sums["pairs"] or 0
        last = bool(turn) and (not cross or (left is not None and cross > LEAST_GAIN * left))
        left = cross if turn else None
        if last and cross:
            one, other = _prefix_rows(rest.filter("large").select("rep", "n", "bits", "c").dropDuplicates(["rep"]), src, k, percent)
            # at a shared token, what can be shared before it, it, and what can be after it
            most = F.least("before", "before2") + 1 + F.least("after", "after2")
            enough = (100 + percent) * most >= percent * (F.col("n") + F.col("n2"))
            # elements in one of the two sets only: at least as many as parities that differ
            apart = sum((F.bit_count(F.get("parity", F.lit(i)).bitwiseXOR(F.get("parity2", F.lit(i))))
                         for i in range(PARITY_CELLS // 64)), F.lit(0))
            both = F.col("n") + F.col("n2")
            near = (100 + percent) * (both - apart) >= 2 * percent * both
            pairs.append(one.join(other, "token").filter(fits & enough & near))
        elif not last:
            some = rest if not turn else rest.filter("large")
            hub = some.groupBy("h").agg(F.min(F.struct(F.xxhash64("rep", F.lit(turn)).alias("x"), "rep", "n", "bits", "c")).alias("u"))
            hub = hub.select("h", *(F.col(f"u.{x}").alias(f"{x}2") for x in ("rep", "n", "bits", "c")))
            pairs.append(some.join(hub, "h").filter(fits))
        if not pairs:
            break
        pairs = reduce(DataFrame.unionByName, [p.select("rep", "rep2") for p in pairs])
        pairs = pairs.select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        edges = _verified(pairs, src, k, percent)
        tested = pairs if tested is None else tested.unionByName(pairs)
        merged = edges if found is None else edges.unionByName(
            found.select(F.col("node").alias("a"), F.col("component").alias("b")).filter("a <> b"))
        found = components(merged)
        if last:
            break
        new = found.withColumnRenamed("node", "rep")
        open_ = (rest if not listed else rest.filter("large")).drop("c", "large").join(new, "rep", "left").withColumn("c", F.coalesce("component", "rep")).drop("component")
        turn += 1
    if found is None:
        found = reps.select(F.col("rep").alias("node"), F.col("rep").alias("component")).limit(0)
    return found


def _texts_of(ids: DataFrame, src: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents with those ids, stored."""
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return materialize(src.join(ids, "doc_id", "left_semi"), "texts")


def _prefix_rows(members: DataFrame, src: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Prefix tokens of the members, as two sides to join on ``token``.

    Tokens whose holders are all in one component are left out, and the first
    side leaves out each token's largest component, so pairs inside a large
    component are never met."""
    texts = _texts_of(members.select(F.col("rep").alias("doc_id")), src)
    # what is known of a member joins its text, one row each, before prefix rows are made
    told = materialize(texts.join(members.withColumnRenamed("rep", "doc_id"), "doc_id").select("doc_id", "text", "n", "bits", "c"), "members")

    def cells(batches):
        seen = np.zeros(RARITY_CELLS, np.int64)
        for b in batches:
            for lo, hi in W.slices(b.column(1), SLICE_BYTES):
                h, _ = shingle_sets(b.column(1).slice(lo, hi - lo), k)
                seen += np.bincount((h % np.uint64(RARITY_CELLS)).astype(np.int64), minlength=RARITY_CELLS)
        at = np.flatnonzero(seen)
        for i in range(0, len(at), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(at[i:i + (1 << 16)]), pa.array(seen[at[i:i + (1 << 16)]])], names=["cell", "n"])

    total = texts.mapInArrow(W.trimmed(cells), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    rarity = np.zeros(RARITY_CELLS, np.int32)  # at most RARITY_CELLS rows, whatever the input
    rarity[total["cell"].to_numpy()] = np.minimum(total["n"].to_numpy(), np.iinfo(np.int32).max)

    def prefixes(batches):
        for b in batches:
            for lo, hi in W.slices(b.column(1), SLICE_BYTES):
                h, doc = shingle_sets(b.column(1).slice(lo, hi - lo), k)
                order = np.lexsort((h, rarity[(h % np.uint64(RARITY_CELLS)).astype(np.int64)], doc))
                first, n = W.first_and_count(doc, hi - lo)
                take = n - (-(-percent * n // 100)) + 1
                own, place = doc[order], np.arange(len(h)) - first[doc[order]]
                met = rarity[(h[order] % np.uint64(RARITY_CELLS)).astype(np.int64)] > 1  # others cannot match
                before = np.concatenate(([0], np.cumsum(met)))
                before = before[:-1] - before[first][own]
                keep = (place < take[own]) & met
                cell = (W.mix(h + _seed(2000)) % np.uint64(PARITY_CELLS)).astype(np.int64)
                odd = np.bincount(doc * PARITY_CELLS + cell, minlength=(hi - lo) * PARITY_CELLS) & 1
                odd = np.packbits(odd.astype(np.uint8).reshape(hi - lo, PARITY_CELLS), axis=1).view(np.int64)
                odd = odd[own[keep]]
                at = pa.array(own[keep])
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo).take(at), pa.array(h[order][keep].view(np.int64)),
                    pa.array(before[keep]), pa.array((n[own] - place - 1)[keep]),
                    pa.ListArray.from_arrays(np.arange(0, odd.size + 1, odd.shape[1], dtype=np.int32), pa.array(odd.ravel())),
                    *(b.column(j).slice(lo, hi - lo).take(at) for j in (2, 3, 4))],
                    names=["rep", "token", "before", "after", "parity", "n", "bits", "c"])

    rows = materialize(told.mapInArrow(
        W.trimmed(prefixes), "rep long, token long, before long, after long, parity array<long>, n long, bits array<long>, c long"), "prefixes")
    by = rows.groupBy("token", "c").agg(F.count("*").alias("k")).groupBy("token").agg(
        F.max(F.struct("k", "c")).alias("top"), F.count("*").alias("parts")).filter("parts > 1")
    rows = rows.join(by.select("token", F.col("top.c").alias("top")), "token")
    one = rows.filter("c <> top").drop("top")
    other = rows.select("token", *(F.col(x).alias(f"{x}2") for x in ("rep", "n", "bits", "c", "before", "after", "parity")))
    return one, other


def _verified(pairs: DataFrame, src: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets meet the threshold."""
    t = _texts_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), src)
    ta = t.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    tb = t.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    with small_batches(src.sparkSession):
        return materialize(pairs.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb")
                           .mapInArrow(W.trimmed(_confirm(k, percent)), "a long, b long"), "edges")


@contextmanager
def small_batches(spark, rows: int = 256):
    """Few rows an Arrow batch while rows of two whole texts go to Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT,
                    bins: int = BINS, rows: int | None = None) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents link when ``100 * |A & B| >= percent * |A | B|`` over their sets
    of lower-cased (A-Z) k-word shingles; component_id is the smallest doc_id
    reachable by links and kept says that it is the document's own.  Null or
    wordless texts have an empty set, link with nothing and are kept.  Rows
    that share a doc_id are one document, whose text is the smallest of theirs;
    each of them gives a row.  A null doc_id takes part in no link and is kept.
    An empty table gives an empty result; other columns are ignored.

    The set elements are 64-bit hashes of the shingles and equal sets are
    recognised by size and 128-bit signature.  ``rows`` a band follow from
    ``percent`` unless given.
    """
    rows = rows or band_rows(bins, percent)
    src = rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    repeated = materialize(src.filter("doc_id is not null").groupBy("doc_id").count()
                           .filter("count > 1").select("doc_id"), "repeated")
    any_repeated = repeated.limit(1).count() > 0
    if any_repeated:
        src = src.join(repeated, "doc_id", "left_anti").unionByName(
            src.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")))
    all_ = materialize(src.mapInArrow(
        W.trimmed(_describe(k, bins, rows)),
        "doc_id long, n long, s0 long, s1 long, bands array<long>, bits array<long>"), "sketches")
    # one representative per distinct set; equal sets have equal bands and bits
    key = ["n", "s0", "s1"]
    reps = materialize(all_.filter("n > 0 and doc_id is not null").groupBy(*key).agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("bits").alias("bits")), "reps")
    found = _linked(reps, src, k, percent, bins)

    label = (reps.select(*key, "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
             .select(*key, F.coalesce("component", "rep").alias("component")))
    out = all_.select("doc_id", *key).join(label, key, "left")
    out = out.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
        .otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    if any_repeated:
        ids = rows_in.select("doc_id")
        out = ids.filter("doc_id is not null").join(out, "doc_id").unionByName(out.filter("doc_id is null"))
    return out


def drop_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns.

    Every distinct (doc_id, text) is judged by its own text: of a component the
    one of the smallest doc_id stays (of several texts of that id, the one whose
    SHA-1 is smallest), of equal rows of one doc_id and text one stays.  Rows
    without a doc_id and texts without a word are duplicates of nothing and stay,
    the latter once a doc_id.  An empty table gives an empty result; columns of any
    name come back as they were.
    """
    sha = F.sha1(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), sha.alias("sha"))
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), sha.alias("sha")).filter("doc_id is not null")
    repeated = materialize(light.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if not repeated.limit(1).count():
        gone = near_duplicates(docs, **how).filter("not kept").select("doc_id")
        gone = materialize(gone, "dropped")
        return rows.join(F.broadcast(gone) if gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else gone, "doc_id", "left_anti").select("row.*")
    # a number of its own for each (doc_id, text), in the order of ids
    told = materialize(numbered(light.distinct(), [], ["doc_id", "sha"]).select("doc_id", "sha", F.col("_n").alias("number")), "numbers")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), sha.alias("sha"), F.col("text").cast("string").alias("text"))
    once = texts.join(told, ["doc_id", "sha"]).groupBy("number").agg(F.min("text").alias("text"))
    gone = near_duplicates(once.select(F.col("number").alias("doc_id"), "text"), **how).filter("not kept").select(F.col("doc_id").alias("number"))
    gone = materialize(told.join(gone, "number").select("doc_id", "sha"), "dropped")
    left = rows.join(gone, ["doc_id", "sha"], "left_anti")
    many = Window.partitionBy("doc_id", "sha").orderBy(F.to_json("row"))
    first = left.filter("doc_id is not null").withColumn("place", F.row_number().over(many)).filter("place = 1")
    return first.select("row").unionByName(left.filter("doc_id is null").select("row")).select("row.*")
