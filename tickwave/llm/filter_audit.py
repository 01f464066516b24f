"""Filter interaction audit with a counting-Bloom duplicate prepass.

Five filters fail documents: A few words, B few distinct words, C many capitals,
D odd symbols, E a text that a smaller doc_id has too.  A to D follow from a
text alone.  For E, every task sketches the hashes of its texts as counters of a
counting Bloom filter; the sketches are added up cell by cell (a count stops at
two), and a text with any cell below two occurs once for certain.  Only the other
texts, the possible repeats, are shuffled, as whole texts with a partial
minimum, to find the smallest doc_id of each.  All flags meet on doc_id and are
added up to counts a mask; every order of the filters is read off those counts.

Scale: a sketch travels as its non-zero cells, packed in chunks, so what is
shuffled follows the number of texts and not the filter's size.  The filter has
``CELLS_A_TEXT`` cells a text and ``MOST_CELLS`` at most; the cells that reached
two come to ``MOST_CELLS / 8`` bytes (64 MB), stored once in the shared folder and
read by each worker.  In a table so large that this fills up, more texts count as
possible repeats and are shuffled; the results stay the same.  A text that fills
a third of the table is one row a task after the partial minimum.  Mask counts
are one row a (source, mask).
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSelector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwave.llm import files
from tickwave.llm import words as W
from tickwave.session import materialize

FILTERS = "ABCDE"
MIN_WORDS = 200
CELLS_A_TEXT = 16
MOST_CELLS = 1 << 29
HASHES = 4
#: Cells a chunk: one chunk's counts are added up in one task.
CHUNK = 1 << 18
#: Counters a task holds before it passes them on.
HELD_CELLS = 1 << 21

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#$%&*|")] = True
_CONTINUATION = np.zeros(256, bool)
_CONTINUATION[128:192] = True


def own_failures(t: W.Texts) -> np.ndarray:
    """Bits 0 to 3 for the filters A to D that each text fails."""
    n = len(t)
    r = W.runs(t, W.SPACES)
    words = np.bincount(r.doc, minlength=n)
    different = _distinct(W.hashes(t, r), r.doc, n)
    chars = np.diff(t.offset) - t.count(_CONTINUATION)
    return ((words < MIN_WORDS) * 1 + (100 * different < 50 * words) * 2
            + (100 * t.count(_UPPER) > 2 * chars) * 4 + (t.count(_SYMBOL) > 0) * 8).astype(np.int32)


def _distinct(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes a text.  The text's number takes the place of the lowest
    bits, so one sort of integers does; a slice has few texts unless they are short."""
    bits = np.uint64(max(n - 1, 0).bit_length())
    key = np.sort((doc.astype(np.uint64) << (np.uint64(64) - bits) if bits else np.uint64(0)) | (h >> bits))
    if not len(key):
        return np.zeros(n, np.int64)
    new = np.concatenate(([True], key[1:] != key[:-1]))
    of = (key[new] >> (np.uint64(64) - bits)).astype(np.int64) if bits else np.zeros(int(new.sum()), np.int64)
    return np.bincount(of, minlength=n)


def _with_flags(docs: DataFrame) -> DataFrame:
    """doc_id, part, hash and own failures of every row; no text."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.xxhash64(_text()).alias("hash"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for b in batches:
            for lo, hi in W.slices(b.column(3)):
                some = b.slice(lo, hi - lo)
                mask = own_failures(W.texts_of(some.column(3)))
                yield pa.RecordBatch.from_arrays([*some.columns[:3], pa.array(mask)], names=["doc_id", "part", "hash", "mask"])

    return rows.mapInArrow(W.trimmed(run), "doc_id long, part string, hash long, mask int")


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def cells_of(h: np.ndarray, cells: int) -> np.ndarray:
    """The counters of each hash: HASHES rows of cell numbers."""
    h = h.view(np.uint64)
    step = W.mix(h) | np.uint64(1)
    return np.stack([(W.mix(h + np.uint64(i) * step) % np.uint64(cells)).astype(np.int64) for i in range(HASHES)])


def _packed(cells: np.ndarray, twice: np.ndarray) -> bytes:
    """Sorted cells of one chunk with a flag each, as compressed differences."""
    step = np.diff(cells, prepend=0).astype(np.uint32) << 1 | twice
    return zlib.compress(step.astype(np.uint32).tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    step = np.frombuffer(zlib.decompress(data), np.uint32)
    return np.cumsum((step >> 1).astype(np.int64)), (step & 1).astype(bool)


def sketches(flags: DataFrame, cells: int, chunk: int | None = None) -> DataFrame:
    """Each task's counting filter as (chunk, packed non-zero counters).

    The cells of one text are counted once even where two of them fall together."""
    size = chunk or CHUNK

    def run(batches):
        counted = np.zeros(0, np.int64), np.zeros(0, bool)
        for b in batches:
            h = b.column(0).to_numpy(zero_copy_only=False)
            c = np.sort(cells_of(h, cells), axis=0)
            own = np.concatenate((np.ones((1, len(h)), bool), c[1:] != c[:-1]))
            counted = _added([counted, (np.sort(c[own]), np.zeros(int(own.sum()), bool))])
            if len(counted[0]) > HELD_CELLS:  # bounds a task's memory; the chunks are added up later
                yield from _rows(*counted)
                counted = np.zeros(0, np.int64), np.zeros(0, bool)
        yield from _rows(*counted)

    def _rows(cell, twice):
        if len(cell):
            chunk, first = np.unique(cell // size, return_index=True)
            edge = [*first.tolist(), len(cell)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk), pa.array([_packed(cell[a:b] % size, twice[a:b]) for a, b in zip(edge, edge[1:])], pa.binary())],
                names=["chunk", "counters"])

    return flags.select("hash").mapInArrow(W.trimmed(run), "chunk long, counters binary")


def _added(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """Counters added up: cells in order, and whether the count reached two."""
    cell = np.concatenate([p[0] for p in parts])
    twice = np.concatenate([p[1] for p in parts])
    if not len(cell):
        return cell, twice
    order = np.argsort(cell, kind="stable")
    cell, twice = cell[order], twice[order]
    first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    n = np.diff(np.concatenate((first, [len(cell)])))
    return cell[first], np.logical_or.reduceat(twice, first) | (n > 1)


def merged(sketch: DataFrame, folder: str, chunk: int | None = None) -> None:
    """Adds the sketches up, chunk by chunk, and stores one file of bits a chunk:
    the cells that reached two."""
    size = chunk or CHUNK
    chunks = sketch.repartition(int(sketch.sparkSession.conf.get("spark.sql.shuffle.partitions")), "chunk").sortWithinPartitions("chunk")

    def run(batches):
        now, have = None, (np.zeros(0, np.int64), np.zeros(0, bool))

        def store():
            bits = np.zeros(size, bool)
            bits[have[0][have[1]]] = True
            fs, path = files.open_store(f"{folder}/{now}.bits")
            with fs.open_output_stream(path) as f:  # a repeated task writes the same bytes
                f.write(np.packbits(bits).tobytes())

        for b in batches:
            for at, data in zip(b.column(0).to_pylist(), b.column(1)):
                if at != now:
                    if now is not None:
                        store()
                    now, have = at, (np.zeros(0, np.int64), np.zeros(0, bool))
                have = _added([have, _unpacked(data.as_py())])
        if now is not None:
            store()
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64())], names=["chunk"])

    fs, path = files.open_store(folder)
    fs.create_dir(path, recursive=True)
    chunks.mapInArrow(W.trimmed(run), "chunk long").agg(F.count("chunk")).collect()


@lru_cache(maxsize=1)
def _bits(folder: str, cells: int, chunk: int) -> np.ndarray:
    """The stored filter: at most MOST_CELLS / 8 bytes, read once a worker."""
    fs, path = files.open_store(folder)
    out = np.zeros((-(-cells // chunk), chunk // 8), np.uint8)
    for info in fs.get_file_info(FileSelector(path)):
        if info.base_name.endswith(".bits"):
            with fs.open_input_stream(info.path) as f:
                out[int(info.base_name.split(".")[0])] = np.frombuffer(f.read(), np.uint8)
    return out.reshape(-1)


def possible_repeat(folder: str, cells: int, chunk: int | None = None):
    """A column function: whether the filter leaves it open that a hash occurs twice."""
    size = chunk or CHUNK

    @F.pandas_udf("boolean")
    def test(h: pd.Series) -> pd.Series:
        bits, c = _bits(folder, cells, size), cells_of(h.to_numpy(), cells)
        return pd.Series(((bits[c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1).all(axis=0))

    return test


def failure_masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, docs): rows by the filters they fail, as bits A=1 to E=16.

    Only texts that the prepass can't clear are shuffled, each once a task."""
    spark = docs.sparkSession
    flags = materialize(_with_flags(docs), "audit_flags")
    n = flags.count()
    cells = CHUNK * -(-min(MOST_CELLS, max(1, n) * CELLS_A_TEXT) // CHUNK)
    folder = files.output_folder(spark, "audit_filter")
    merged(sketches(flags, cells), folder)
    repeats = possible_repeat(folder, cells)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text().alias("text")).filter(F.col("doc_id").isNotNull())
    first = (text.withColumn("hash", F.xxhash64("text")).filter(repeats("hash"))
             .groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", F.xxhash64("text").alias("hash"), F.lit(True).alias("first")))
    flags = flags.withColumn("open", F.col("doc_id").isNotNull() & repeats("hash"))
    # equal rows are counted before they move; only possible repeats look for their text's first id
    open_ = (flags.filter("open").groupBy("doc_id", "part", "hash", "mask").agg(F.count(F.lit(1)).alias("docs"))
             .join(first, ["doc_id", "hash"], "left")
             .select("doc_id", "part", (F.col("mask") + F.when(F.col("first").isNull(), 16).otherwise(0)).alias("mask"), "docs"))
    clear = flags.filter("NOT open").select("doc_id", "part", "mask", F.lit(1).cast("long").alias("docs"))
    return clear.unionByName(open_).groupBy("doc_id", "part", "mask").agg(F.sum("docs").alias("docs"))


def orders() -> list[str]:
    """Every order of the filters."""
    return ["".join(p) for p in permutations(FILTERS)]


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a (part, filter_order, step) with the counts of that step.

    A null text is empty; a null source counts as the part "".  Equal texts of
    one doc_id are no repeats of each other, and a row without a doc_id neither
    repeats another nor is repeated.  A document is good (toxic) if any label row
    of its doc_id says so.  An empty table gives an empty result; other columns
    are ignored.
    """
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = failure_masks(docs).join(marks, "doc_id", "left")
    counts = rows.groupBy("part", "mask").agg(
        F.sum("docs").alias("docs"), F.sum(F.col("docs") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("docs") * F.coalesce("toxic", F.lit(0))).alias("toxic"))
    return order_steps(counts)


def order_steps(counts: DataFrame) -> DataFrame:
    """Every order and step from additive counts a (part, mask)."""
    steps = F.explode(F.array(*[
        F.struct(F.lit(o).alias("filter_order"), F.lit(i + 1).alias("step"), F.lit(1 << FILTERS.index(x)).alias("own"),
                 F.lit(sum(1 << FILTERS.index(y) for y in o[:i])).alias("before"))
        for o in orders() for i, x in enumerate(o)]))
    # a document that fails n filters is removed by each of them in 120 / n orders
    times = F.get(F.array(*[F.lit(x) for x in (0, 120, 60, 40, 30, 24)]), F.bit_count("mask"))
    # one row a part first: its 32 counts, so that the 600 steps multiply parts and not masks
    packed = counts.groupBy("part").agg(
        F.collect_list(F.struct("mask", "docs", "good", "toxic", (F.col("docs") * times).alias("orders"))).alias("masks"))
    s = packed.select("part", "masks", steps.alias("s")).select("part", "masks", "s.*")

    def total(test, of="docs"):
        return F.aggregate("masks", F.lit(0).cast("long"),
                           lambda a, m: a + F.when(test(m["mask"]), m[of]).otherwise(F.lit(0).cast("long")))

    own, before = F.col("own"), F.col("before")
    fails = lambda m: m.bitwiseAND(own) != 0
    gone = lambda m: m.bitwiseAND(before) != 0
    here = lambda m: fails(m) & ~gone(m)
    return s.select(
        "part", "filter_order", "step",
        total(lambda m: m.bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"), total(here).alias("removed"),
        total(lambda m: fails(m) & gone(m)).alias("redundant"), total(lambda m: m == own).alias("unique_fails"),
        total(here, "good").alias("good_lost"), total(here, "toxic").alias("toxic_lost"), total(fails, "orders").alias("shapley"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), f AS (
  SELECT d.doc_id, part,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)::INT AS mask,
         coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
  FROM d LEFT JOIN (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
                    FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id
), c AS (
  SELECT part, mask, count(*) AS docs, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask
), x AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)
), o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM x a, x b, x c, x d, x e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), s AS (
  SELECT filter_order, i::INT AS step, bits[i] AS own, coalesce(list_sum(bits[1:i - 1]), 0)::INT AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS i)
)
SELECT part, filter_order, step,
  sum(CASE WHEN (mask & (own | before)) = 0 THEN docs ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN (mask & own) > 0 AND (mask & before) = 0 THEN docs ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN (mask & own) > 0 AND (mask & before) > 0 THEN docs ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN mask = own THEN docs ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN (mask & own) > 0 AND (mask & before) = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN (mask & own) > 0 AND (mask & before) = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
  sum(CASE WHEN (mask & own) > 0 THEN docs * (120 // bit_count(mask)) ELSE 0 END)::BIGINT AS shapley
FROM c, s GROUP BY part, filter_order, step
"""
