"""Benchmark decontamination by a prefix-filtered set join (DataFrame functions only).

An item window is a set of positioned shingles (three consecutive words, or
the whole of a shorter window).  Shingles are ordered by rarity over all
documents.  A document that contains a window contains every shingle of it, so
the prefix that must match has one token: the window's rarest shingle.  Only
these anchors are joined with the documents' shingles; the anchor's place in
the window gives the one place where the window could start (positional
bound), the document's length says whether it fits (length bound), and the
SHA-256 of that stretch's words is then compared with the window's.

Scale: document positions are exploded and probed against the anchors in the
scan stage; what is shuffled is one row a document plus its verified
occurrences.  Anchors are broadcast only while they are counted to be few
(``BROADCAST_ROWS``); their rows hold numbers and one digest, never words, so
the count bounds the bytes.  Beyond that, positions (numbers only, no words)
are joined by shuffle with the anchors, shingle counts are added up before
they meet the tokens, and a second pass joins the candidates that pass the
bounds with their documents, so a text travels at most once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwave.session import materialize

WINDOW = 10
SHINGLE = 3
#: Shingles, anchors, candidates or contaminated texts are broadcast up to this many
#: rows; each is numbers and at most one digest (under 200 bytes, so 40 MB at most).
BROADCAST_ROWS = 200_000


def words_of(text: str) -> Column:
    """Lower-cased (A-Z only) words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; null: none."""
    low = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")),
                      "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(low, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), "")


def _shingle(words: str, at: Column, n: int) -> Column:
    """Hash of n words from a position on."""
    return F.xxhash64(F.lit(n), *(F.get(F.col(words), at + j) for j in range(n)))


def _digest(words: Column) -> Column:
    """Identity of a window: SHA-256 of its words, which hold no blank."""
    return F.sha2(F.concat_ws(" ", words).cast("binary"), 256)


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, words): every window of ``window`` consecutive words, or the
    whole of a shorter item.  Items without words have none."""
    w = benchmark.select(F.col("item_id"), words_of("text").alias("w")).filter(F.size("w") > 0)
    at = w.withColumn("i", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))))
    return at.select("item_id", F.slice("w", F.col("i") + 1, window).alias("words"))


def _few(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _maybe_broadcast(df: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(df) if few else df


def occurrences(docs: DataFrame, windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(key, doc_id, n_words, start, length, window): one row with null start
    for each row of ``docs``, and one for each verified occurrence.

    ``windows`` has distinct (window, words), ``window`` the words' digest.
    ``key`` identifies the text."""
    w = windows.withColumn("length", F.size("words")).withColumn("k", F.least("length", F.lit(shingle)))
    lengths = sorted(r[0] for r in w.select("k").distinct().collect())  # at most `shingle` values
    tokens = w.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("length") - F.col("k"))))
    token = F.lit(None).cast("long")
    for n in lengths:
        token = F.when(F.col("k") == n, _shingle("words", F.col("place"), n)).otherwise(token)
    tokens = materialize(tokens.select("window", "length", "k", "place", token.alias("token")), "tokens")

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of("text").alias("w"),
                        F.xxhash64("text").alias("key")).withColumn("n_words", F.size("w").cast("long"))
    # position -1 stands for the document itself; it has no shingle
    cells = whole.withColumn("pos", F.explode(F.sequence(F.lit(-1), F.size("w") - 1)))

    def shingled(n: int) -> DataFrame:
        fits = (F.col("pos") >= 0) & (F.col("pos") + n <= F.size("w"))
        return cells.withColumn("token", F.when(fits, _shingle("w", F.col("pos"), n)))

    few = _few(tokens)
    counts = tokens.select("token").limit(0).groupBy("token").count()
    for n in lengths:
        mine = tokens.filter(F.col("k") == n).select("token").distinct()
        seen = shingled(n).select("token").filter("token is not null")
        if few:
            part = seen.join(F.broadcast(mine), "token", "left_semi").groupBy("token").count()
        else:  # a hot shingle is added up in each task before it is shuffled
            part = seen.groupBy("token").count().join(mine, "token", "left_semi")
        counts = counts.unionByName(part)
    # the rarest shingle of each window; one that no document holds rules its window out
    anchors = materialize(
        tokens.join(counts, "token", "left")
        .groupBy("window", "length", "k")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token", "place")).alias("a"))
        .filter("a.n > 0")
        .select("k", F.col("a.token").alias("token"), F.col("a.place").alias("place"), "length", "window"), "anchors")
    if not _few(anchors):
        return _occurrences_by_shuffle(whole, shingled, anchors, lengths)

    found = None
    for n in lengths or [shingle]:
        a = F.broadcast(anchors.filter(F.col("k") == n).drop("k"))
        hit = shingled(n).join(a, "token", "left" if found is None else "inner")
        start = F.col("pos") - F.col("place")
        hit = hit.withColumn("same", F.coalesce(_fits(start) & _same(start), F.lit(False)))
        hit = hit.filter(F.col("same") | (F.col("pos") == -1))
        part = hit.select("key", "doc_id", "n_words", F.when(F.col("same"), start).alias("start"),
                          F.when(F.col("same"), F.col("length")).alias("length"),
                          F.when(F.col("same"), F.col("window")).alias("window"))
        found = part if found is None else found.unionByName(part)
    return found


def _fits(start: Column) -> Column:
    """Positional and length bounds of a window that would begin at ``start``."""
    return (start >= 0) & (start + F.col("length") <= F.col("n_words"))


def _same(start: Column) -> Column:
    """The words from ``start`` on are the window's."""
    return _digest(F.slice(F.col("w"), F.greatest(start, F.lit(0)) + 1, F.col("length"))) == F.col("window")


def _occurrences_by_shuffle(whole: DataFrame, shingled, anchors: DataFrame, lengths: list) -> DataFrame:
    """``occurrences`` for anchors that are too many to broadcast.

    Positions go to the join as numbers.  Candidates that pass the bounds are
    stored, one row each however often a row of ``docs`` is repeated, and meet
    their texts in a second join by (doc_id, key)."""
    start = F.col("pos") - F.col("place")
    near = None
    for n in lengths:
        places = shingled(n).filter("token is not null").select("key", "doc_id", "n_words", "pos", "token")
        part = (places.join(anchors.filter(F.col("k") == n).drop("k"), "token").filter(_fits(start))
                .select("key", "doc_id", start.alias("start"), "length", "window"))
        near = part if near is None else near.unionByName(part)
    near = materialize(near.distinct().select(F.col("key").alias("t"), F.col("doc_id").alias("d"), "start", "length", "window"),
                       "candidates")
    held = whole.join(_maybe_broadcast(near, _few(near)), (F.col("key") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d")))
    held = held.filter(_same(F.col("start"))).select("key", "doc_id", "n_words", "start", "length", "window")
    none = whole.select("key", "doc_id", "n_words", F.lit(None).cast("int").alias("start"),
                        F.lit(None).cast("int").alias("length"), F.lit(None).cast("string").alias("window"))
    return none.unionByName(held)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row.

    Hit words are those inside any occurrence of an item window; overlapping
    occurrences count a word once.  A null or wordless text has no words and
    is clean; an item without words has no window; a null item_id counts for
    hits but is no item.  Repeated rows give a row each, as do rows that share
    a doc_id or have a null one.  Item ids are joined as sorted strings.
    Empty tables give an empty (or all clean) result; other columns are
    ignored.
    """
    of_item = materialize(item_windows(benchmark, window).withColumn("window", _digest(F.col("words")))
                          .distinct(), "item_windows")
    found = materialize(occurrences(docs, of_item.select("window", "words").distinct()), "occurrences")
    covered = F.flatten(F.transform("at", lambda x: F.sequence(x["start"], x["start"] + x["length"] - 1)))
    rows = found.groupBy("doc_id", "key", "n_words").agg(
        F.count(F.when(F.col("start").isNull(), 1)).alias("copies"),
        F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "length"))).alias("at"))
    rows = rows.select("doc_id", "key", "n_words", "copies", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"))
    items = (found.filter("start is not null").select("doc_id", "key", "window").distinct()
             .join(of_item.select("window", "item_id"), "window").filter("item_id is not null")
             .groupBy("doc_id", "key").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
             .select(F.col("doc_id").alias("d"), F.col("key").alias("t"), F.sort_array("items").alias("items")))
    out = rows.join(items, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("key").eqNullSafe(F.col("t")), "left")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        "doc_id", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any item window, all columns.

    Rows are judged by their own text, so repeated rows and null doc_ids are rows
    like any other; a null or wordless text stays.  An empty table gives an empty
    result, an empty benchmark keeps every row; columns of any name come back as
    they were."""
    windows = materialize(item_windows(benchmark, window).select("words").distinct()
                          .withColumn("window", _digest(F.col("words"))), "item_windows")
    hit = materialize(occurrences(docs, windows).filter("start is not null").select(
        F.col("doc_id").alias("_d"), F.col("key").alias("_k")).distinct(), "contaminated")
    d = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"))
    out = d.join(_maybe_broadcast(hit, _few(hit)), F.col("id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k")), "left_anti")
    return out.select("row.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, list_slice(w, i + 1, i + least(10, len(w))) AS words
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS i FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT len(words) AS n FROM win),
cand AS (
  SELECT r, s, n, list_slice(w, s + 1, s + n) AS words
  FROM (SELECT r, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, size WHERE len(w) >= n)),
occ AS (SELECT c.r, c.s, c.n, win.item_id FROM cand c JOIN win ON c.words = win.words),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT r, s, n FROM occ)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM occ WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""
