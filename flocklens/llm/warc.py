"""WARC archives, index first.

Writing: every task writes one gzip member per record into archive files of its
own in the shared folder and returns an index row per record: file, offset,
length, URL, digest. The index is committed as Parquet, so files of lost or
repeated task attempts are never referred to. Of records with equal payloads of
at least ``min_revisit`` bytes, the one with the largest page_id is a response
and the others are revisits of it without payload.

Reading: the selected index rows are sorted by file and offset and dealt by
range; each task joins neighbouring byte ranges into reads of bounded size and
parses the records out of them, checking every response's digest.

The archive folder must be reachable from all executors through
``pyarrow.fs`` (file, hdfs, s3, gs).

Cases: null or empty payloads are responses of 0 bytes; a null URL has no
target header; line breaks in a URL are percent-encoded; a null page_id stays
null (it never serves as the response of a group that has an id); repeated rows
with the largest page_id are all responses; an empty table gives an empty
result; only page_id, url and html are read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flocklens.llm.common import Run, shuffle_partitions

MIN_REVISIT = 1000
READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10
FILE_BYTES = 512 << 20

_INDEX = "file string, offset long, length long, page_id long, url string, digest string, record_type string"
_RECORD = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)


def roles(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``pages(page_id, url, html)`` with payload digest, size and the page_id
    (refers_to) of the response that a revisit stands for."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"), F.length(payload).cast("long").alias("size")
    )
    large = rows.where(F.col("size") >= min_revisit).groupBy("digest", "size")
    many = large.agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(many, ["digest", "size"], "left")
    return rows.withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    ).drop("response")


def _record(page_id, url, payload, digest, size, refers_to, date) -> bytes:
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    ).encode()
    body = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _member(record: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def write(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", min_revisit: int = MIN_REVISIT, level: int = 1) -> DataFrame:
    """Write all ``pages`` into archives below ``folder``; the (lazy) index rows."""

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        out, path, at = None, None, 0
        try:
            for batch in batches:
                rows = {c: [] for c in ("file", "offset", "length", "page_id", "url", "digest", "record_type")}
                for r in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "size", "refers_to"))):
                    if out is None or at > FILE_BYTES:
                        if out is not None:
                            out.close()
                        name = f"part-{uuid.uuid4().hex}.warc.gz"
                        store.create_dir(root, recursive=True)
                        out, path, at = store.open_output_stream(f"{root}/{name}", compression=None), name, 0
                    page_id, url, payload, digest, size, refers_to = r
                    data = _member(_record(page_id, url, payload, digest, size, refers_to, date), level)
                    out.write(data)
                    kind = "response" if refers_to is None else "revisit"
                    for c, v in zip(rows, (path, at, len(data), page_id, url, digest, kind)):
                        rows[c].append(v)
                    at += len(data)
                yield pa.RecordBatch.from_pydict(rows, schema=_arrow(_INDEX))
        finally:
            if out is not None:
                out.close()

    return roles(pages, min_revisit).mapInArrow(run, _INDEX)


def _arrow(ddl: str) -> pa.Schema:
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(f.split()[0], types[f.split()[1]]) for f in ddl.split(", ")])


def _page(urn: str):
    digits = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def parse(member: bytes) -> tuple:
    """The fields of ``_RECORD`` from one gzip member; raises on a damaged record."""
    record = zlib.decompress(member, 31)
    head, body = record.split(b"\r\n\r\n", 1)
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    if version != "WARC/1.1" or body[int(fields["Content-Length"]) :] != b"\r\n\r\n":
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    http, payload = body[: int(fields["Content-Length"])].split(b"\r\n\r\n", 1)
    size = int(next(v for k, v in (h.split(b": ", 1) for h in http.split(b"\r\n")[1:]) if k == b"Content-Length"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response":
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    refers_to = _page(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return (
        _page(fields["WARC-Record-ID"]),
        fields.get("WARC-Target-URI"),
        payload if kind == "response" else None,
        size,
        digest,
        kind,
        refers_to,
    )


def joined_ranges(rows, read_bytes: int = READ_BYTES, gap_bytes: int = GAP_BYTES):
    """Sorted (file, offset, length) rows in runs that one read serves."""
    run, start, end = [], 0, 0
    for file, offset, length in rows:
        if run and (file != run[0][0] or offset > end + gap_bytes or offset + length - start > read_bytes):
            yield run, start, end
            run = []
        if not run:
            start = end = offset
        run.append((file, offset, length))
        end = max(end, offset + length)
    if run:
        yield run, start, end


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records of the selected ``index`` rows (file, offset, length)."""
    parts = shuffle_partitions(index.sparkSession)

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        schema = _arrow(_RECORD)
        opened, source = None, None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")))
            for group, start, end in joined_ranges(rows):
                if opened != group[0][0]:
                    if source is not None:
                        source.close()
                    opened, source = group[0][0], store.open_input_file(f"{root}/{group[0][0]}")
                data = source.read_at(end - start, start)
                found = [parse(data[o - start : o - start + n]) for _, o, n in group]
                columns = [pa.array(c, f.type) for c, f in zip(zip(*found), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        if source is not None:
            source.close()

    rows = index.select("file", "offset", "length")
    return rows.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, _RECORD)


def archive(pages: DataFrame) -> tuple[DataFrame, str]:
    """Write ``pages`` to a new folder on shared storage: (committed index, folder)."""
    run = Run(pages.sparkSession, "warc")
    folder = f"{run.dir}/archives"
    if "://" not in folder and folder.startswith("file:"):
        folder = "file://" + folder.removeprefix("file:")
    return run.keep(write(pages, folder), "index"), folder


