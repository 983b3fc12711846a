"""WARC archives: writing, reading, and revisit records for repeated payloads.

Archives are folders of gzipped files that Spark's text writer makes: a record
is one row, ended by the two line ends that the format asks for, so any file
system that Spark writes to will do. They are read back file by file, record
after record by their stated lengths; payloads may hold any bytes.

Revisits are resolved from headers alone: they are shuffled by payload digest,
the least response of a digest is its original, and every other record of the
digest is joined to it. The deduplicated archive is then written in one pass
over the first one, with fresh headers: originals keep their payload, revisits
have none and name their original.

Defined results: a null payload is empty, a null URL is written as an empty
one; white space and control characters in a URL are written as ``%20``.
Records without a page id come last in the order of ids, so they are originals
only if no record of their group has an id. Repeated ids: the record that comes
first by archive file and offset is the original, the others revisit it. An
empty table gives an archive without records. Further columns are ignored. A
response whose payload doesn't have the digest its header states, or a record
cut short, makes the read fail.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from datetime import datetime, timezone
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, maybe_broadcast

END = "\r\n"
HTTP = "application/http;msgtype=response"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_BYTES = 100           # payloads from this size on are stored once
RECORDS_PER_FILE = 100_000
BATCH_BYTES = 4 << 20       # payload bytes of an Arrow batch, about; a longer payload is a batch of its own
WIDE_ROWS = 100_000         # broadcast limit of tables that hold ids and URLs as strings: about 64 MB

RECORD_SCHEMA = ("archive string, offset long, record_type string, record_id string, target_uri string, date string, "
                 "page_id long, refers_to string, payload_bytes long, payload_digest string")


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing if its value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)), F.lit(""))


def _uuid(of: Column) -> Column:
    """A record id made from a string's digest."""
    h = F.md5(of.cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]),
                    F.lit(">"))


def record_text(kind: Column, record_id: Column, uri: Column, date: Column, page_id: Column, digest: Column, size: Column,
                payload: Column, refers_to: Column, refers_uri: Column, refers_date: Column) -> Column:
    """A whole record but for the line ends that close it. ``size`` is that of
    the full payload, which only a response carries."""
    revisit = kind == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                    size.cast("string"), F.lit(END + END))
    body = F.when(revisit, F.lit("")).otherwise(payload)
    length = F.octet_length(http) + F.octet_length(body)
    only = lambda c: F.when(revisit, c)
    return F.concat(
        F.lit(f"WARC/1.1{END}"), _line("WARC-Type", kind), _line("WARC-Record-ID", record_id), _line("WARC-Date", date),
        _line("WARC-Target-URI", uri), _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)), _line("Page-ID", page_id),
        _line("WARC-Profile", only(F.lit(PROFILE))), _line("WARC-Refers-To", only(refers_to)),
        _line("WARC-Refers-To-Target-URI", only(refers_uri)), _line("WARC-Refers-To-Date", only(refers_date)),
        _line("Content-Type", F.lit(HTTP)), _line("Content-Length", length), F.lit(END), http, body)


def _write(records: DataFrame, path: str) -> None:
    (records.write.mode("overwrite").option("lineSep", END + END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def write_responses(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                    date: str | None = None) -> None:
    """One response record per row, in the row's own partition: no shuffle."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"),
        F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"[\x00-\x20\x7F]", "%20").alias("uri"))
    absent = F.lit(None).cast("string")
    _write(rows.select(record_text(
        F.lit("response"), F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">")), F.col("uri"), F.lit(date or _now()), F.col("page_id"),
        F.sha2(F.col("payload").cast("binary"), 256), F.octet_length("payload"), F.col("payload"), absent, absent, absent)), path)


def _records(content: pa.Buffer, name: str) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers by lower-case name, block) of each record of a file."""
    raw = pa.BufferReader(content)
    file = gzip.GzipFile(fileobj=raw) if content.size > 1 and content[:2].to_pybytes() == b"\x1f\x8b" else io.BufferedReader(raw)
    at = 0

    def line() -> bytes:
        nonlocal at
        got = file.readline()
        at += len(got)
        return got

    while first := line():
        if not first.strip():
            continue
        offset = at - len(first)
        if not first.startswith(b"WARC/"):
            raise ValueError(f"{name}: no record at {offset}")
        headers: dict[str, str] = {}
        while (got := line()).strip():
            key, _, value = got.decode("utf-8", "replace").partition(":")
            headers[key.strip().lower()] = value.strip()
        size = int(headers.get("content-length", 0))
        block = file.read(size)
        at += len(block)
        if len(block) < size:
            raise ValueError(f"{name}: the record at {offset} is cut short")
        yield offset, headers, block


def _payload(headers: dict[str, str], block: bytes) -> bytes:
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of an archive (``RECORD_SCHEMA``, then ``payload`` if asked
    for). Size and digest of a response are those of the payload read; a
    revisit has the digest its header states and no size. Files are told apart
    by their name in the folder."""
    schema = RECORD_SCHEMA + (", payload binary" if payloads else "")
    names = [f.split()[0] for f in schema.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]] for f in schema.split(", ")]

    def run(batches):
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*held)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py().rpartition("/")[2]
                for offset, h, block in _records(batch.column(1)[i].as_buffer(), name):
                    kind, page = h.get("warc-type", ""), h.get("page-id")
                    payload, digest = b"", h.get("warc-payload-digest", "").partition(":")[2] or None
                    if kind == "response":
                        payload = _payload(h, block)
                        found = sha256(payload).hexdigest()
                        if digest not in (None, found):
                            raise ValueError(f"{name}: the payload at {offset} has another digest than its header")
                        digest = found
                    row = (name, offset, kind, h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-date"),
                           None if page is None else int(page), h.get("warc-refers-to"),
                           len(payload) if kind == "response" else None, digest)
                    held.append((*row, payload) if payloads else row)
                    size += len(payload) if payloads else 0
                    if size >= BATCH_BYTES or len(held) >= 4096:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, schema)


def originals(headers: DataFrame, scratch: Scratch, tag: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The original of each payload digest that several records have: the
    response of the smallest page id. Reduced in each task before the shuffle,
    and stored, so that the join back to a frequent digest can be split."""
    place = F.struct(F.col("page_id").isNull().alias("nameless"), F.coalesce("page_id", F.lit(0)).alias("page_id"), "archive", "offset",
                     "record_id", "target_uri", "date", "payload_bytes")
    first = (headers.where("payload_digest is not null").groupBy("payload_digest")
             .agg(F.min(F.when(F.col("record_type") == "response", place)).alias("o"), F.count("*").alias("n"))
             .where(f"n > 1 and o.payload_bytes >= {int(least_bytes)}"))
    return scratch.save(first.select(
        F.col("payload_digest").alias("digest"), F.expr("if(o.nameless, null, o.page_id)").alias("o_page"), F.col("o.archive").alias("o_archive"),
        F.col("o.offset").alias("o_offset"), F.col("o.record_id").alias("o_id"), F.col("o.target_uri").alias("o_uri"),
        F.col("o.date").alias("o_date"), F.col("o.payload_bytes").alias("o_bytes")), tag)


def write_deduplicated(spark: SparkSession, source: str, target: str, scratch: Scratch, least_bytes: int = LEAST_BYTES,
                       date: str | None = None) -> None:
    """Archive ``target`` with the records of ``source``, payloads of
    ``least_bytes`` and more stored once. Payloads are shuffled only if the
    revisits are too many to broadcast."""
    headers = scratch.save(read_records(spark, source), "headers")
    first = originals(headers, scratch, "originals", least_bytes)
    joined = headers.join(maybe_broadcast(first, limit=WIDE_ROWS), headers["payload_digest"] == first["digest"])
    revisits = scratch.save(joined.where("archive <> o_archive or offset <> o_offset").select(
        F.col("archive").alias("r_archive"), F.col("offset").alias("r_offset"), "o_id", "o_uri", "o_date", "o_bytes"), "revisits")
    rows = read_records(spark, source, payloads=True)
    rows = rows.join(maybe_broadcast(revisits, limit=WIDE_ROWS), (rows["archive"] == revisits["r_archive"]) & (rows["offset"] == revisits["r_offset"]), "left")
    fresh = date or _now()
    _write(rows.select(record_text(
        F.when(F.col("r_offset").isNotNull(), "revisit").otherwise(F.col("record_type")), _uuid(F.col("record_id")), F.col("target_uri"),
        F.lit(fresh), F.col("page_id"), F.col("payload_digest"), F.coalesce("payload_bytes", "o_bytes", F.lit(0)),
        F.col("payload").cast("string"), _uuid(F.col("o_id")), F.col("o_uri"), F.col("o_date"))), target)


def resolved(spark: SparkSession, path: str, scratch: Scratch, tag: str = "resolved") -> DataFrame:
    """The records of an archive with size and digest of their full payload;
    ``original`` is the page id of the response that a revisit repeats. A
    revisit without its response in the archive has neither size nor original."""
    headers = scratch.save(read_records(spark, path), f"{tag}-headers")
    first = originals(headers, scratch, f"{tag}-originals", 0)
    joined = headers.join(maybe_broadcast(first, limit=WIDE_ROWS), headers["payload_digest"] == first["digest"], "left")
    revisit = F.col("record_type") == "revisit"
    return joined.select(
        "archive", "offset", "record_type", "record_id", "target_uri", "page_id", "payload_digest",
        F.when(revisit, F.col("o_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("o_page")).alias("original"))


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
             least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Archive ``pages``, deduplicate the archive, read that back: per page
    page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    write_responses(pages, scratch.path("archive"), id_col, url_col, payload_col)
    write_deduplicated(spark, scratch.path("archive"), scratch.path("deduplicated"), scratch, least_bytes)
    return resolved(spark, scratch.path("deduplicated"), scratch).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("original").alias("refers_to"))
