"""Token files: length-delimited binary records with masked checksums and an offset index.

A data file is a sequence of records

    uint64 payload length | uint32 masked crc of the length | payload | uint32 masked crc of the payload

all little-endian.  The payload is an int64 doc_id, one byte (1: the doc_id is
null, then written as 0), one byte with the width of an id in bytes (2 or 4),
and the ids.  The mask is ``rotate right by 15, plus 0xA282EAD8`` over CRC-32, so
that a checksum stored inside checked data is not itself a valid checksum.
``<file>.idx`` holds one little-endian uint64 record offset each, for reads in
any order.

Texts are cut into units that tokens never cross (:mod:`pieces`).  Of a batch's
distinct units only those not met lately are encoded (a table of fixed size per
worker), and the ids of all texts are gathered from them with numpy; the ids are
those of the whole texts.
"""

from __future__ import annotations

import os
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwave.llm import files
from tickwave.llm import pieces as P
from tickwave.llm import words as W
from tickwave.session import materialize

END = 2
#: Rows of a worker's table of units.
TABLE_UNITS = 1 << 19
#: Texts are encoded in slices of so many bytes (about 90 bytes of temporaries
#: each): two workers share an executor's memory with a full heap.
SLICE_BYTES = 256 << 10
_MASK = 0xA282EAD8
_HEAD = "<QI"
_ID = "<qBB"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def read_records(stream, where: str = ""):
    """Payloads in file order; a wrong checksum or a short file is an error."""
    while head := stream.read(12):
        if len(head) < 12:
            raise ValueError(f"cut record head in {where}")
        n, crc = struct.unpack(_HEAD, head)
        if masked(head[:8]) != crc:
            raise ValueError(f"wrong length checksum in {where}")
        body = stream.read(n + 4)
        if len(body) < n + 4 or masked(body[:n]) != struct.unpack("<I", body[n:])[0]:
            raise ValueError(f"wrong payload checksum in {where}")
        yield body[:n]


def read_at(uri: str, index: int) -> bytes:
    """The record with that number, through the offset index."""
    with files.open_random(uri + ".idx") as f:
        f.seek(8 * index)
        at = struct.unpack("<Q", f.read(8))[0]
    with files.open_random(uri) as f:
        f.seek(at)
        return next(read_records(f, uri))


class Encoder:
    """Ids of whole texts, little-endian, ``width`` bytes each."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = 2 if max(*vocabulary.values(), END) < 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.end = np.array([END], self.kind).tobytes()
        pre = self.tokenizer.pre_tokenizer
        state = pre.__getstate__() if pre is not None else b""
        # pieces are independent only for plain byte-level pre-tokens
        self.by_piece = (self.tokenizer.normalizer is None and b'"type":"ByteLevel"' in state
                         and b'"add_prefix_space":false' in state and b'"use_regex":true' in state)
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes a token: one character each
        for token, i in vocabulary.items():
            self.size[i] = len(token)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.marks = [t.content.encode() for t in added]
        self.units = P.Table(TABLE_UNITS, self.kind)

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, units: list[bytes], between: bytes, have: dict) -> None:
        """Units are encoded end to end, many at once, and cut by byte counts: no
        token reaches across a unit's end or the line end put between two."""
        gap = len(between)
        for i in range(0, len(units), 512):
            some = units[i:i + 512]
            text = between.join(some).decode()
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            ends = np.cumsum(self.size[ids])
            stop = np.cumsum([len(u) + gap for u in some]) - gap
            at = np.searchsorted(ends, stop)
            if at[-1] >= len(ends) or (ends[at] != stop).any():
                have.update(zip(some, self._plain([u.decode() for u in some])))
                continue
            data, at = ids.astype(self.kind).tobytes(), ((at + 1) * self.width).tolist()
            skip = gap * self.width
            have.update(zip(some, (data[x:y] for x, y in zip([0, *(x + skip for x in at)], at))))

    def _made(self, units: list[bytes]) -> list[bytes]:
        """The ids of distinct units."""
        have: dict[bytes, bytes] = {}
        self._joined([u for u in units if u[0] == 32 and len(u) > 1 and u[1] > 32], b"", have)
        self._joined([u for u in units if u[0] > 32 and u[0] < 128], b"\n", have)
        rest = [u for u in units if u not in have]
        have.update(zip(rest, self._plain([u.decode() for u in rest])))
        return [have[u] for u in units]

    def _ids(self, t: W.Texts, r: W.Runs, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct units and the end id; where those of each begin, and how many."""
        rows, hit = self.units.find(t, r, h)
        known, size = np.flatnonzero(hit), rows["n"].astype(np.int64)
        found = rows["ids"][known][np.arange(P.UNIT_IDS) < size[known, None]]
        new = np.flatnonzero(~hit)
        parts = self._made(P.bytes_of(t, W.Runs(r.doc[new], r.start[new], r.end[new])))
        made = np.frombuffer(b"".join(parts), self.kind)
        size[new] = np.fromiter(map(len, parts), np.int64, len(parts)) // self.width
        self.units.keep(rows[new], h[new], size[new], made)
        order = np.concatenate((known, new))
        begin = np.empty(len(size), np.int64)
        begin[order] = np.cumsum(size[order]) - size[order]
        return np.concatenate((found, made, [END])).astype(self.kind), np.append(begin, len(found) + len(made)), np.append(size, 1)

    def encode(self, t: W.Texts) -> list[bytes]:
        """The ids of every text, the end id last."""
        def whole(i):
            return t.data[t.offset[i]:t.offset[i + 1]].tobytes().decode()

        if not self.by_piece:
            return [x + self.end for x in self._plain([whole(i) for i in range(len(t))])]
        r = P.units(t)
        some, h, place = P.firsts(t, r)
        flat, begin, size = self._ids(t, some, h)
        first = np.searchsorted(r.doc, np.arange(1, len(t) + 1))
        place = np.insert(place, first, len(some))  # the end id after each text's last unit
        n = size[place]
        stop = np.cumsum(n)
        shift = begin[place] - (stop - n)
        data = flat[np.arange(stop[-1]) + np.repeat(shift, n)].tobytes()
        at = [0, *(stop[first + np.arange(len(t))] * self.width).tolist()]
        out = [data[x:y] for x, y in zip(at, at[1:])]
        for i in P.holding(t, self.marks):
            out[i] = self._plain([whole(i)])[0] + self.end
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a worker process, so that its cache serves all its tasks."""
    W.KEPT["encoder"] = encoder.cache_clear
    return Encoder(path)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, file_bytes: int = files.FILE_BYTES) -> DataFrame:
    """Encode every text and write the files in ascending doc_id order (nulls
    first); returns the stored manifest: file, part, number, records, ids."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text")

    def run(batches):
        enc, out, state = None, None, None
        rows_out = []

        def finish():
            if state is not None:
                out.beside(".idx", np.array(state["at"], "<u8").tobytes())
                rows_out.append((out.file(), out.part, out.number, len(state["at"]), state["ids"]))
                out.close()

        for b in batches:
            for lo, hi in W.slices(b.column(1), SLICE_BYTES):
                if out is None:
                    enc, out = encoder(tokenizer), files.Roller(folder, "tok", file_bytes)
                part = b.slice(lo, hi - lo)
                for doc, ids in zip(part.column(0).to_pylist(), enc.encode(W.texts_of(part.column(1)))):
                    if out.full():
                        finish()
                        out.begin()
                        state = {"at": [], "ids": 0}
                    state["at"].append(out.write(frame(struct.pack(_ID, doc or 0, doc is None, enc.width) + ids)))
                    state["ids"] += len(ids) // enc.width
        finish()
        if rows_out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in rows_out], t) for j, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
                names=["file", "part", "number", "records", "ids"])

    return materialize(ordered.mapInArrow(W.trimmed(run, "encoder"), "file string, part long, number long, records long, ids long"), "token_manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, from the files.

    ``start`` counts the ids before a record over all files: a running sum over
    the manifest (one small row a file) plus the ids before it in its file."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    m = manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long"))
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    m = m.select("file", "base").repartition(parts, "file")

    def run(batches):
        for b in batches:
            for file, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = ([], [], [], [])
                with files.open_input(file) as f:
                    for payload in read_records(f, file):
                        doc, null, width = struct.unpack_from(_ID, payload)
                        ids = np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(_ID)).astype("<u4")
                        for column, v in zip(got, (None if null else doc, base, len(ids), zlib.crc32(ids.tobytes()))):
                            column.append(v)
                        base += len(ids)
                        if len(got[0]) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in got], names=NAMES)
                            got = ([], [], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in got], names=NAMES)

    return m.mapInArrow(W.trimmed(run, "encoder"), "doc_id long, start long, n_tokens long, ids_crc32 long")


NAMES = ["doc_id", "start", "n_tokens", "ids_crc32"]


def token_records(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write token files of ``docs`` and report from reading them back.

    A null or empty text is the end id alone.  Rows that share a doc_id give a
    record each, ordered by text; null doc_ids come first.  An empty table
    writes nothing and gives an empty result; other columns are ignored.
    """
    folder = folder or files.output_folder(docs.sparkSession, "token_files")
    return read_token_files(write_token_files(docs, folder, tokenizer))
