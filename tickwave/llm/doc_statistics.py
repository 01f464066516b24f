"""Statistics of whole texts, one pass, vectorised over Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwave.llm import words as W

#: Texts are described in slices of so many bytes (about 100 bytes of temporaries
#: each): two workers share an executor's memory with a full heap.
SLICE_BYTES = 256 << 10


def _member(chars: bytes) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars)] = True
    return m


UPPER = _member(bytes(range(65, 91)))
LETTER = _member(bytes(range(65, 91)) + bytes(range(97, 123)))
DIGIT = _member(b"0123456789")
SYMBOL = _member(b"#*$%&|<>")
PUNCT = _member(b"!?.,;:")
SHOUT = _member(b"!?")
BRACKET = _member(b"{}[]()<>=/\\_@+~^`")
CONTROL = _member(bytes(x for x in range(32) if x not in (9, 10, 11, 12, 13)) + b"\x7f")
HIGH = _member(bytes(range(128, 256)))
CONTINUATION = _member(bytes(range(128, 192)))

#: Exact counts, as long columns.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Shares and means, as double columns: the inputs of the learned models.
SHARES = ["log_words", "mean_word", "upper", "digit", "symbol", "punct", "shout", "bracket", "control",
          "high", "distinct", "top_word", "same_as_last", "dup_lines", "repeat_words", "words_a_line",
          "short_words", "long_words", "longest_word"]


def describe_texts(texts: pa.Array) -> dict[str, np.ndarray]:
    t = W.texts_of(texts)
    n = len(t)
    r = W.runs(t, W.SPACES)
    h = W.hashes(t, r)
    n_words = np.bincount(r.doc, minlength=n)
    size = np.diff(t.offset)
    spaces = t.count(W.SPACES)
    ink = size - spaces
    chars = ink - t.count(CONTINUATION)

    lines = W.runs(t, W.NEWLINE)
    has_word = np.searchsorted(r.start, lines.end) > np.searchsorted(r.start, lines.start)
    lines = W.Runs(lines.doc[has_word], lines.start[has_word], lines.end[has_word])
    lh = W.hashes(t, lines)
    n_lines = np.bincount(lines.doc, minlength=n)
    distinct_lines = np.bincount(W.distinct_by_doc(lh, lines.doc)[1], minlength=n)

    # words covered by a five-word window that the text holds twice or more
    k = 5
    covered = np.zeros(len(h) + 1, np.int64)
    m = len(h) - k + 1
    if m > 0:
        ok = np.flatnonzero(r.doc[:m] == r.doc[k - 1:])
        sh = W.shingles(h, r.doc, n, k)[0][:len(ok)]
        order = np.lexsort((sh, r.doc[ok]))
        a, d = sh[order], r.doc[ok][order]
        same = (a[1:] == a[:-1]) & (d[1:] == d[:-1])
        twice = np.zeros(len(ok), bool)
        twice[order] = np.concatenate((same, [False])) | np.concatenate(([False], same))
        np.add.at(covered, ok[twice], 1)
        np.add.at(covered, ok[twice] + k, -1)
    repeat = np.bincount(r.doc, weights=np.cumsum(covered)[:-1] > 0, minlength=n).astype(np.int64)

    uh, ud = W.distinct_by_doc(h, r.doc)
    distinct = np.bincount(ud, minlength=n)
    top = np.zeros(n, np.int64)
    if len(h):
        order = np.lexsort((h, r.doc))
        first = np.flatnonzero(np.concatenate(
            ([True], (h[order][1:] != h[order][:-1]) | (r.doc[order][1:] != r.doc[order][:-1]))))
        np.maximum.at(top, ud, np.diff(np.concatenate((first, [len(h)]))))
    last = np.zeros(len(h), bool)
    last[1:] = (h[1:] == h[:-1]) & (r.doc[1:] == r.doc[:-1])
    length = r.end - r.start
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, r.doc, length)

    w, c = np.maximum(n_words, 1), np.maximum(ink, 1)
    by_word = lambda x: np.bincount(r.doc, weights=x, minlength=n) / w
    return {
        "n_words": n_words, "word_chars": chars, "n_symbols": t.count(SYMBOL),
        "n_dup_lines": n_lines - distinct_lines, "n_repeat_words": repeat,
        "log_words": np.log1p(n_words), "mean_word": chars / w,
        "upper": t.count(UPPER) / np.maximum(t.count(LETTER), 1), "digit": t.count(DIGIT) / c,
        "symbol": t.count(SYMBOL) / w, "punct": t.count(PUNCT) / w, "shout": t.count(SHOUT) / w,
        "bracket": t.count(BRACKET) / w, "control": t.count(CONTROL) / np.maximum(size, 1),
        "high": t.count(HIGH) / c, "distinct": distinct / w, "top_word": top / w,
        "same_as_last": by_word(last), "dup_lines": (n_lines - distinct_lines) / np.maximum(n_lines, 1),
        "repeat_words": repeat / w, "words_a_line": np.log1p(n_words / np.maximum(n_lines, 1)),
        "short_words": by_word(length <= 3), "long_words": by_word(length > 20), "longest_word": np.log1p(longest),
    }


def _run(batches):
    for b in batches:
        ids, texts = b.column(0), b.column(1)
        for lo, hi in W.slices(texts, SLICE_BYTES):
            s = describe_texts(texts.slice(lo, hi - lo))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), *(pa.array(s[c].astype(np.int64)) for c in COUNTS),
                 *(pa.array(s[c].astype(np.float64)) for c in SHARES)],
                names=["doc_id", *COUNTS, *SHARES])


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS and SHARES of every row's whole text (null: empty).

    Words are ``[^\\x20\\x09-\\x0D]+``.  word_chars: code points in words;
    n_symbols: characters of ``[#*$%&|<>]``; n_dup_lines: lines (split at \\n)
    that hold a word and equal an earlier line; n_repeat_words: words inside
    five-word windows that the text holds twice or more, the first included.
    Words, lines and windows are compared by 64-bit hashes.
    """
    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), *(f"{c} double" for c in SHARES)])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(W.trimmed(_run), schema)


def sample_cells(limit: int, n: int) -> int:
    """Of 2^20 hash cells, those that hold about ``limit`` of ``n``; one at least."""
    return max(1, int((1 << 20) * min(1.0, limit / n)))


def labelled_ids(labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(doc_id, y) of at most about ``limit`` labelled documents, chosen by a
    hash of doc_id, so that reruns agree and the bound holds at every size."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter(
        F.col("y").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("y").alias("y"))
    n = max(1, known.count())
    return known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < sample_cells(limit, n))


def labelled_sample(stats: DataFrame, labels: DataFrame, label: str, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, label 0/1) of the sample, one row a doc_id (the smallest of
    its features); only these rows reach the driver."""
    rows = stats.select("doc_id", *SHARES).join(labelled_ids(labels, label, limit), "doc_id")
    rows = rows.groupBy("doc_id", "y").agg(F.min(F.struct(*SHARES)).alias("x")).select("doc_id", "x.*", "y").orderBy("doc_id").toPandas()
    return rows[SHARES].to_numpy(np.float64).reshape(len(rows), len(SHARES)), rows["y"].to_numpy(np.int64)
