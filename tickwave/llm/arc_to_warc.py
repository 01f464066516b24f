"""Legacy archive converter: ARC files (version 1 and 2) to WARC/1.1.

The converter reads ARC files by their version block, header lines and declared
lengths, synthesises what WARC wants and ARC lacks (record ids, UTC timestamps,
record types, block and payload digests), and turns equal payloads into revisit
records of one response.

Scale: an archive file is the unit of work.  One pass reads all files and
stores a light row a record (no payload); who is the original of a digest is
decided on those rows with a pre-aggregated minimum and a join that adaptive
execution may split; a second pass streams each ARC file next to its decisions
and writes WARC.  A task holds one record at a time.  Files of lost attempts
are never in a manifest (see ``files``).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwave.llm import files
from tickwave.session import materialize

#: Field names of the header line by version (fixed by the ARC format).
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
DATE = "19700101000000"
LEVEL = 4
KEY = b"x-page-id"
#: Payloads of at least so many bytes are deduplicated.
LEAST_BYTES = 0
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(data: bytes) -> bytes:
    """One gzip member; archives are sequences of members, one a record."""
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def open_archive(uri: str):
    """Buffered, decompressed if gzipped (any number of members)."""
    raw = io.BufferedReader(files.open_input(uri), 1 << 20)
    return gzip.GzipFile(fileobj=raw) if raw.peek(2)[:2] == b"\x1f\x8b" else raw


# --- ARC ---------------------------------------------------------------------


def arc_header(version: int, url: str, date: str, kind: str, status: str, checksum: str, offset: int, name: str, length: int) -> bytes:
    v = {"URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": kind, "Result-code": status,
         "Checksum": checksum, "Location": "-", "Offset": str(offset), "Filename": name, "Archive-length": str(length)}
    return (" ".join(v[f] for f in FIELDS[version]) + "\n").encode()


def arc_start(version: int, name: str) -> bytes:
    block = f"{version} 0 tickwave\n{' '.join(FIELDS[version])}\n".encode()
    return arc_header(version, f"filedesc://{name}", DATE, "text/plain", "200", "-", 0, name, len(block)) + block + b"\n"


def http_response(key, payload: bytes) -> bytes:
    own = "" if key is None else f"X-Page-Id: {key}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{own}\r\n".encode() + payload


def read_arc(f, where: str = ""):
    """(number, header fields, content) of every record after the version block.

    The version block says which header line follows; the last field is the
    declared length.  A cut record or an unknown version is an error."""
    fields, number = None, 0
    while line := f.readline():
        if line == b"\n":
            continue
        text = line.rstrip(b"\r\n").decode("utf-8", "replace")
        if fields is None:
            length = int(text.rsplit(" ", 1)[1])
            block = f.read(length).decode()
            version = int(block.split(" ", 1)[0])
            if not text.startswith("filedesc:") or version not in FIELDS:
                raise ValueError(f"no ARC version block in {where}")
            fields = FIELDS[version]
            continue
        values = text.rsplit(" ", len(fields) - 1)  # a URL may hold spaces, the rest may not
        if len(values) < len(fields):
            raise ValueError(f"bad ARC header line in {where}: {text[:200]}")
        h = dict(zip(fields, values))
        n = int(h["Archive-length"])
        content = f.read(n)
        if len(content) < n:
            raise ValueError(f"cut ARC record in {where}")
        yield number, h, content
        number += 1


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """(header block, payload) of an HTTP message; others have no header."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    head, gap, payload = content.partition(b"\r\n\r\n")
    return head + gap, payload


def http_fields(head: bytes) -> dict[bytes, bytes]:
    pairs = (x.partition(b":") for x in head.split(b"\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs if k}


def key_of(head: bytes):
    v = http_fields(head).get(KEY)
    return int(v) if v is not None else None


def write_arc(pages: DataFrame, folder: str, file_bytes: int = files.FILE_BYTES) -> DataFrame:
    """Store page_id, url and html as ARC files (versions 1 and 2 in turn);
    returns the stored manifest (file, records)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))

    def run(batches):
        out, done, count = None, [], 0
        for b in batches:
            for i in range(b.num_rows):
                key, url, html = (b.column(j)[i].as_py() for j in range(3))
                if out is None:
                    out = files.Roller(folder, "arc.gz", file_bytes)
                if out.full():
                    if out.out is not None:
                        done.append((out.file(), count))
                    name, count = out.begin(), 0
                    version = 1 + (out.part + out.number) % 2
                    out.write(member(arc_start(version, name)))
                content = http_response(key, (html or "").encode())
                url = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else "urn:unknown"
                head = arc_header(version, url, DATE, "text/html", "200", hashlib.md5(content).hexdigest(), out.at, name, len(content))
                out.write(member(head + content + b"\n"))
                count += 1
        if out is not None:
            out.close()
            done.append((out.file(), count))
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], names=["file", "records"])

    return materialize(rows.mapInArrow(run, "file string, records long"), "arc_manifest")


# --- WARC --------------------------------------------------------------------


def record_id(file: str, number: int) -> str:
    """A record's id, from its archive's whole address and its place in it; the
    address has a folder of its own for every written file, so ids of different
    archives differ."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{number}')}>"


def warc_date(arc_date: str) -> str:
    d = (arc_date + "00000000000000")[:14] if arc_date.isdigit() else DATE
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v)
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def read_warc(f, where: str = ""):
    """(header dict with lower-case names, block) of every record."""
    while line := f.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record in {where}")
        h = {}
        while (line := f.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().partition(":")
            h[k.strip().lower()] = v.strip()
        n = int(h["content-length"])
        block = f.read(n)
        if len(block) < n or f.read(4) != b"\r\n\r\n":
            raise ValueError(f"cut WARC record in {where}")
        yield h, block


INDEX = "file string, number long, key long, url string, date string, payload_bytes long, digest string"


def index_arc(manifest: DataFrame) -> DataFrame:
    """A light row for every record of the ARC files."""
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        for b in batches:
            for file in b.column(0).to_pylist():
                rows = []
                with open_archive(file) as f:
                    for number, h, content in read_arc(f, file):
                        head, payload = split_http(content)
                        rows.append((file, number, key_of(head), h["URL"], warc_date(h["Archive-date"]), len(payload), sha1_base32(payload)))
                        if len(rows) >= 5000:
                            yield _batch(rows, INDEX)
                            rows = []
                yield _batch(rows, INDEX)

    return materialize(manifest.select("file").repartition(parts, "file").mapInArrow(run, INDEX), "arc_index")


_TYPES = {"string": pa.string(), "long": pa.int64()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split(" ") for x in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _TYPES[k]) for i, k in enumerate(kinds)], names=list(names))


def decide(index: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The index with the original (o_*) of every record that revisits another.

    Of records with equal digests the one of the smallest key is the original,
    then the earliest, then by place; payloads under ``least_bytes`` are all
    originals."""
    order = F.struct(F.coalesce(F.col("key"), F.lit((1 << 63) - 1)).alias("k"), "date", "file", "number", "url")
    first = (index.filter(F.col("payload_bytes") >= least_bytes).groupBy("digest")
             .agg(F.min(order).alias("o"), F.count("*").alias("n")).filter("n > 1").select("digest", "o"))
    out = index.join(first, "digest", "left")
    other = (F.col("payload_bytes") >= least_bytes) & ((F.col("o.file") != F.col("file")) | (F.col("o.number") != F.col("number")))
    return out.select(*index.columns, *(F.when(other, F.col(f"o.{x}")).alias(f"o_{x}") for x in ("file", "number", "url", "date")))


def convert(decided: DataFrame, folder: str, file_bytes: int = files.FILE_BYTES) -> DataFrame:
    """Write WARC files; returns the stored manifest (file, records)."""
    parts = int(decided.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = decided.select("file", "number", "o_file", "o_number", "o_url", "o_date").repartition(parts, "file").sortWithinPartitions("file", "number")

    def run(batches):
        out, done, count, at, source = None, [], 0, None, None
        for b in batches:
            for file, number, o_file, o_number, o_url, o_date in zip(*(b.column(i).to_pylist() for i in range(6))):
                if file != at:
                    at, opened = file, open_archive(file)
                    source = read_arc(opened, file)
                have, h, content = next(source)
                if have != number:
                    raise ValueError(f"records of {file} and its index differ")
                if out is None:
                    out = files.Roller(folder, "warc.gz", file_bytes)
                if out.full():
                    if out.out is not None:
                        done.append((out.file(), count))
                    name, count = out.begin(), 0
                    info = b"software: tickwave\r\nformat: WARC File Format 1.1\r\n"
                    out.write(member(warc_record("warcinfo", [
                        ("WARC-Record-ID", record_id(out.file(), -1)), ("WARC-Date", warc_date(DATE)), ("WARC-Filename", name),
                        ("Content-Type", "application/warc-fields")], info)))
                head, payload = split_http(content)
                fields = [("WARC-Record-ID", record_id(file, number)), ("WARC-Date", warc_date(h["Archive-date"])),
                          ("WARC-Target-URI", h["URL"]), ("WARC-IP-Address", h["IP-address"].replace("0.0.0.0", "")),
                          ("WARC-Payload-Digest", "sha1:" + sha1_base32(payload))]
                if o_file is not None:
                    kind, block = "revisit", head
                    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(o_file, o_number)),
                               ("WARC-Refers-To-Target-URI", o_url), ("WARC-Refers-To-Date", o_date)]
                else:
                    kind, block = "response" if head else "resource", content
                fields += [("WARC-Block-Digest", "sha1:" + sha1_base32(block)),
                           ("Content-Type", "application/http; msgtype=response" if head else h["Content-type"])]
                out.write(member(warc_record(kind, fields, block)))
                count += 1
        if out is not None:
            out.close()
            done.append((out.file(), count))
            yield _batch(done, "file string, records long")

    return materialize(rows.mapInArrow(run, "file string, records long"), "warc_manifest")


READ = "key long, record_type string, record_id string, refers_id string, url string, payload_bytes long, payload_digest string"


def read_back(manifest: DataFrame) -> DataFrame:
    """A row for every record but warcinfo, from the WARC files; digests of
    blocks and whole payloads are checked."""
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        for b in batches:
            for file in b.column(0).to_pylist():
                rows = []
                with open_archive(file) as f:
                    for h, block in read_warc(f, file):
                        kind = h["warc-type"]
                        if kind == "warcinfo":
                            continue
                        head, payload = split_http(block)
                        digest = h["warc-payload-digest"].removeprefix("sha1:")
                        if h["warc-block-digest"] != "sha1:" + sha1_base32(block) or kind != "revisit" and digest != sha1_base32(payload):
                            raise ValueError(f"wrong digest in {file}: {h['warc-record-id']}")
                        n = int(http_fields(head)[b"content-length"]) if kind == "revisit" else len(payload)
                        rows.append((key_of(head), kind, h["warc-record-id"], h.get("warc-refers-to"), h["warc-target-uri"], n, digest))
                        if len(rows) >= 5000:
                            yield _batch(rows, READ)
                            rows = []
                yield _batch(rows, READ)

    return manifest.select("file").repartition(parts, "file").mapInArrow(run, READ)


def archive_report(pages: DataFrame, file_bytes: int = files.FILE_BYTES) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every
    page, read back from the WARC files converted from its ARC record.

    A null html is an empty payload, a null url is ``urn:unknown``.  Of records
    with equal payloads the smallest page_id is the response (a null page_id
    comes last; of rows with one page_id the first written is it).  An empty
    table gives an empty result; other columns are ignored.
    """
    spark = pages.sparkSession
    arc = write_arc(pages, files.output_folder(spark, "arc"), file_bytes)
    warc = convert(decide(index_arc(arc)), files.output_folder(spark, "warc"), file_bytes)
    records = materialize(read_back(warc), "warc_records")
    # only responses that something refers to can be met
    target = records.filter("record_type <> 'revisit'").select(F.col("record_id").alias("refers_id"), F.col("key").alias("refers_to"))
    out = records.join(target, "refers_id", "left")
    return out.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
