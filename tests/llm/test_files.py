"""Archives and token files: round trips against plain Python."""

import base64
import hashlib
import io
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickwave.llm import arc_to_warc as A
from tickwave.llm import files
from tickwave.llm import token_records as T
from tickwave.llm import words as W
from tickwave.llm.queries import QUERIES, tokenizer_path


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(pages):
    first = {}
    for i, html in sorted(pages, key=lambda x: (x[0] is None, x[0] or 0)):
        first.setdefault(html or "", i)
    seen, out = set(), []
    for i, html in sorted(pages, key=lambda x: (x[0] is None, x[0] or 0)):
        original = (html or "") not in seen
        seen.add(html or "")
        out.append((i, len((html or "").encode()), sha(html), "response" if original else "revisit", None if original else first[html or ""]))
    return sorted(out, key=str)


def test_archive_query(spark, sf01):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf01}/pages.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op2_arc_to_warc"](spark, sf01).collect()]
    assert sorted(got, key=str) == expected(pages)


def test_archive_awkward_and_small_files(spark):
    rows = [(5, "http://a/ b c", "x"), (2, None, "x"), (9, "http://é/ü?q=1 2", None), (1, "u", ""), (7, "u", "WARC/1.1\r\n\r\n\r\nHTTP/1.1 200"),
            (8, "u", "é" * 30_000), (3, "u", "é" * 30_000), (3, "u", "é" * 30_000), (None, "u", "x"), (4, "u\nv", "1 2 3\n\nfiledesc://x\n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("key", F.lit(1))
    got = [tuple(r) for r in A.archive_report(df, file_bytes=400).collect()]
    assert sorted(got, key=str) == expected([(r[0], r[2]) for r in rows])
    assert A.archive_report(df.limit(0)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    body = b"HTTP/1.1 200 OK\r\n\r\nhello\n\nworld"
    data = A.arc_start(version, "n.arc") + A.arc_header(version, "http://x y/", "20010203040506", "text/html", "200", "-", 9, "n.arc", len(body)) + body + b"\n"
    (number, h, content), = A.read_arc(io.BytesIO(data))
    assert (number, h["URL"], h["Archive-date"], content) == (0, "http://x y/", "20010203040506", body)
    assert A.warc_date(h["Archive-date"]) == "2001-02-03T04:05:06Z"
    with pytest.raises(ValueError):
        list(A.read_arc(io.BytesIO(data[:-10])))
    with pytest.raises(ValueError):
        list(A.read_arc(io.BytesIO(b"not an archive 4\nabcd")))


def plain_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    return [e.ids + [2] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def report(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, out = 0, []
    for (doc, _), ids in zip(rows, plain_ids([t for _, t in rows])):
        out.append((doc, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return sorted(out, key=str)


def test_token_query(spark, sf01):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf01}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op6_token_records"](spark, sf01).collect()]
    assert sorted(got, key=str) == report(docs)


ODD = ["  two  spaces  ", " lead", "tail ", "a\n b", "a \nb", "nb  x  y", "it's we'll 'S ' s", "<|endoftext|> in <|endoftext|>", "tab\t x", "  wide 　 z",
       "x\x1f y \x1c z", "0 1 22 +1 (3)", "é à 漢 字 🙂 🙂"]


def test_token_files_awkward(spark, awkward, tmp_path):
    rows = [(r.doc_id, r.text) for r in awkward.collect()] + [(100 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("file", F.lit("clash")).withColumn("ids", F.lit(1))
    folder = f"file://{tmp_path}/tokens"
    manifest = T.write_token_files(df, folder, tokenizer_path(), file_bytes=2000)
    got = [tuple(r) for r in T.read_token_files(manifest).collect()]
    assert sorted(got, key=str) == report(rows)
    m = manifest.orderBy("part", "number").collect()
    assert len(m) > 3 and sum(r.records for r in m) == len(rows)
    for r in m:  # reads through the index, in any order
        with files.open_input(r.file) as f:
            payloads = list(T.read_records(f))
        assert [T.read_at(r.file, i) for i in range(r.records)] == payloads
    damaged = bytearray(T.frame(b"some payload"))
    damaged[15] ^= 1
    with pytest.raises(ValueError):
        list(T.read_records(io.BytesIO(bytes(damaged))))
    assert T.token_records(df.limit(0), tokenizer_path()).count() == 0


def test_pieces_equal_whole_texts():
    rng = np.random.default_rng(1)
    parts = [" ", "  ", "a", "'s", "\n", "\t", "é", "1", "!", " ", "word", "<|endoftext|>", "漢", " ", "\x1f"]
    enc = T.Encoder(tokenizer_path())
    texts = ["".join(parts[j] for j in rng.integers(0, len(parts), 12)) for _ in range(3000)]
    for t, got, ids in zip(texts, enc.encode(W.texts_of(pa.array(texts))), plain_ids(texts)):
        assert np.frombuffer(got, enc.kind).tolist() == ids, t
