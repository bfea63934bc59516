"""WARC archives: writing, a monolithic-gzip normaliser with a sidecar offset index, and reading back.

``normalise`` inflates a whole-file gzip stream once, front to back, rewrites each record as a gzip
member of its own and yields the index entry (offset, length) of each. It copies in blocks, so memory
does not depend on the size of a record or file.

Archives of the DataFrame interface are rows (archive, data, index) of a table in the shared folder:
Spark commits them atomically and any file system that Spark writes to will do. ``export_archives``
writes them as .warc.gz files with sidecar index files, ``normalise_file`` normalises a file.

Defined cases: null payloads are empty; records whose payload has fewer than ``least`` bytes are
always responses; repeated rows with the largest id of their payload are all responses; a null id
gives an id-less record (never a target); white space and control characters in URLs are escaped;
an empty table gives an empty archive table; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markscribe.llm.common import map_batches, written

BLOCK = 1 << 18
LEVEL = 1
#: Repeated digests that are broadcast at most.
MOST_BROADCAST = 1 << 18
ARCHIVES = "archive string, data binary, index array<struct<record string, offset long, length long>>"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(value: str) -> int | None:
    number = value.strip().removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit leaves its payload out and names the response and full length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%-._~' + chr(39))}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def normalise(source, target) -> Iterator[tuple[str, int, int]]:
    """Rewrite the gzip stream ``source`` to ``target``, one member a record; yield (record id, offset, length)."""
    at = 0
    with gzip.GzipFile(fileobj=source) as inflated, io.BufferedReader(inflated, BLOCK) as plain:
        while line := plain.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not a WARC record: {line[:40]!r}")
            head, name, left = [line], "", 0
            while (line := plain.readline()).strip():
                head.append(line)
                key, _, value = line.decode("utf-8", "replace").partition(":")
                if key.lower() == "content-length":
                    left = int(value)
                elif key.lower() == "warc-record-id":
                    name = value.strip()
            packer, size = zlib.compressobj(LEVEL, wbits=31), 0
            for part in _blocks(plain, b"".join([*head, b"\r\n"]), left):
                size += target.write(packer.compress(part))
            size += target.write(packer.flush())
            yield name, at, size
            at += size


def _blocks(plain, head: bytes, left: int) -> Iterator[bytes]:
    yield head
    while left:
        part = plain.read(min(left, BLOCK))
        if not part:
            raise EOFError("a record is cut off")
        left -= len(part)
        yield part
    yield b"\r\n\r\n"


def normalise_file(source: str, target: str, index: str) -> int:
    """Normalise a file; the index has a line (record id, offset, length; tab-separated) per record."""
    n = 0
    with open(source, "rb") as a, open(target, "wb") as b, open(index, "w", encoding="utf-8") as c:
        for name, offset, length in normalise(a, b):
            c.write(f"{name}\t{offset}\t{length}\n")
            n += 1
    return n


def parse_member(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload of one record's gzip member."""
    head, _, rest = zlib.decompress(member, wbits=31).partition(b"\r\n\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    return headers, rest[: int(headers["content-length"])].partition(b"\r\n\r\n")[2]


def deduplicated(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``pages(page_id, url, html)`` with digest, record_type and refers_to, with SQL functions only.

    Ids and digests alone are shuffled; the digests that occur twice come back to the payloads, which
    are shuffled only if those are more than MOST_BROADCAST.
    """
    rows = pages.select(F.col("page_id").cast("long"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= least
    target = rows.filter(large).groupBy(F.col("digest").alias("of")).agg(F.max("page_id").alias("target"), F.count("*").alias("n"))
    target = written(target.filter("n > 1 and target is not null").select("of", "target"), "targets")
    if target.count() <= MOST_BROADCAST:
        target = F.broadcast(target)
    rows = rows.join(target, (F.col("digest") == F.col("of")) & large, "left")
    revisit = F.col("target").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target"))
    return rows.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("target")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(records: DataFrame, archive_bytes: int = 1 << 23) -> DataFrame:
    """Archives of about ``archive_bytes`` inflated bytes: written as one gzip stream each, then normalised."""

    def run(batches):
        task, n = TaskContext.get().partitionId(), 0
        raw, packer, size = io.BytesIO(), zlib.compressobj(LEVEL, wbits=31), 0

        def finish():
            nonlocal raw, packer, size, n
            raw.write(packer.flush())
            raw.seek(0)
            out = io.BytesIO()
            index = [{"record": a, "offset": b, "length": c} for a, b, c in normalise(raw, out)]
            row = {"archive": [f"pages-{task:05d}-{n:05d}.warc.gz"], "data": [out.getvalue()], "index": [index]}
            n += 1
            raw, packer, size = io.BytesIO(), zlib.compressobj(LEVEL, wbits=31), 0
            kind = pa.schema([("archive", pa.string()), ("data", pa.binary()), ("index", pa.list_(pa.struct([("record", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])))])
            return pa.RecordBatch.from_pydict(row, schema=kind)

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, digest, refers_to, revisit = (c[i].as_py() for c in batch.columns)
                record = record_bytes(page_id, url, payload, digest, refers_to, revisit)
                raw.write(packer.compress(record))
                size += len(record)
                if size >= archive_bytes:
                    yield finish()
        if size:
            yield finish()

    return map_batches(records, run, ARCHIVES)


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of ``archives`` by their offset index; digests are those of the payloads read, or a revisit's header."""
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data, rows = memoryview(batch.column(0)[i].as_buffer()), []
                for entry in batch.column(1)[i].as_py():
                    headers, payload = parse_member(data[entry["offset"] : entry["offset"] + entry["length"]])
                    kind, named = headers["warc-type"], base64.b32decode(headers["warc-payload-digest"].partition(":")[2]).hex()
                    digest = hashlib.sha1(payload).hexdigest() if kind == "response" else named
                    if digest != named:
                        raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
                    refers_to = _page_of(headers["warc-refers-to"]) if kind == "revisit" else None
                    length = len(payload) if kind == "response" else int(headers["warc-payload-length"])
                    rows.append((_page_of(headers["warc-record-id"]), length, digest, kind, refers_to, headers["warc-target-uri"], payload if payloads else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return map_batches(archives.select("data", "index"), run, RECORDS)


def export_archives(archives: DataFrame, directory: str) -> None:
    """Write every archive as ``<archive>`` with its sidecar ``<archive>.idx`` (record id, offset, length; tab-separated); ``directory`` is shared and mounted.

    Files appear whole under their names, so a repeated task does no harm.
    """

    def write(rows) -> None:
        import os

        os.makedirs(directory, exist_ok=True)
        for row in rows:
            index = "".join(f"{e['record']}\t{e['offset']}\t{e['length']}\n" for e in row["index"])
            for name, data in ((row["archive"], bytes(row["data"])), (f"{row['archive']}.idx", index.encode())):
                part = os.path.join(directory, f".{name}.{TaskContext.get().taskAttemptId()}")
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, os.path.join(directory, name))

    archives.select("archive", "data", "index").foreachPartition(write)
