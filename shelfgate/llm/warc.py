"""WARC archives: write with an index, read back by coalesced byte ranges.

Every task writes one archive of gzip members, one per record, into the
shared folder and returns an index row per record (file, offset, length, URL,
digest); the index is written as a table, so it names the archives of
successful tasks alone. Reading starts from index rows: they are range-partitioned and
sorted by file and offset, and neighbouring records are fetched in one read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .tokens import string_column

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
ESCAPED = "X-Target-URI-Escaped"
HOT_ROWS, MAX_HOT = 1000, 100_000
GAP_BYTES = 64 << 10
READ_BYTES = 4 << 20
TASK_BYTES = 8 << 20
_INDEX = "page_id {id}, url string, file string, offset bigint, length bigint, payload_digest string, record_type string"


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _record_id(page_id) -> str:
    """``<urn:page:ID>``, the id as percent-encoded text; ``<urn:page>`` without one."""
    return "<urn:page>" if page_id is None else f"<urn:page:{quote(str(page_id), safe='')}>"


def record(page_id, url: str | None, payload: bytes, refers_to, is_revisit: bool, digest: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP header, with the payload's length, and no payload.

    A URL that would break its header line is written percent-encoded, and a header of its own says so.
    """
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if is_revisit else http + payload
    head = [VERSION, f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}",
            f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    if url is not None:
        broken = "\r" in url or "\n" in url
        head.append(f"WARC-Target-URI: {quote(url, safe='/:?&=#') if broken else url}")
        head += [f"{ESCAPED}: true"] if broken else []
    if is_revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _write(folder: str):
    def run(batches):
        fs, root = _file_system(folder)
        name = f"{uuid.uuid4().hex}.warc.gz"
        out, offset = None, 0
        try:
            for batch in batches:
                ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
                first = batch.column("response_id").to_pylist()
                rows = []
                for i, url, html, ref in zip(ids, urls, string_column(batch, "html").cast(pa.binary()), first):
                    payload = html.as_buffer().to_pybytes()
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    revisit = ref is not None and ref != i
                    data = _member(record(i, url, payload, ref, revisit, digest))
                    if out is None:
                        fs.create_dir(root, recursive=True)
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)  # members are compressed one by one
                    out.write(data)
                    rows.append((i, url, name, offset, len(data), digest, "revisit" if revisit else "response"))
                    offset += len(data)
                cols = list(zip(*rows)) or [()] * 7
                types = [batch.column("page_id").type, pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types)],
                    names=["page_id", "url", "file", "offset", "length", "payload_digest", "record_type"])
        finally:
            if out is not None:
                out.close()
    return run


def write_archives(pages: DataFrame, folder: str | None = None, *, min_bytes: int = 0) -> tuple[DataFrame, str]:
    """Write a record per row of ``pages`` (page_id, url, html); returns the index and the folder.

    Of records with equal payloads of at least ``min_bytes`` bytes the one
    with the largest page_id is a response and the others revisit it; smaller
    payloads are responses. Null html is an empty payload, a null url leaves
    its header out. A null page_id never is the response others refer to; if
    no record of a payload has an id, all are responses. Rows that repeat the
    largest id are responses too. Other columns are ignored, and an empty
    table gives an empty index. Ids may be of any type that its text gives
    back (numbers, texts, dates). The folder must be one that all executors
    reach; the default lies in the shared folder of the session.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    src = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    src = src.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    same = (src.where(F.octet_length("html") >= min_bytes).groupBy("sha")
            .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
            .select(F.col("sha").alias("same_sha"), "response_id", "n"))
    same = materialize(same, "warc-payloads")
    # frequent payloads, at most MAX_HOT of them, are told to every task; their rows are spread over the join
    limit = max(HOT_ROWS, -(-pages.count() // MAX_HOT))
    hot = same.where(F.col("n") > limit).select(F.col("same_sha").alias("hot_sha"), F.col("response_id").alias("hot_id"))
    src = src.join(F.broadcast(hot), F.col("sha") == F.col("hot_sha"), "left")
    src = src.withColumn("key", F.when(F.col("hot_sha").isNull(), F.col("sha"))
                         .otherwise(F.floor(F.rand(11) * (1 << 20)).cast("string")))
    rare = same.where(F.col("n") <= limit).drop("n")
    rows = (src.join(rare, F.col("key") == F.col("same_sha"), "left")
            .select("page_id", "url", "html", F.coalesce("hot_id", "response_id").alias("response_id")))
    schema = _INDEX.format(id=pages.schema["page_id"].dataType.simpleString())
    return materialize(rows.mapInArrow(_write(folder), schema), "warc-index"), folder


def parse(data: bytes) -> dict:
    """Headers and block of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a {VERSION} record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields["http"] = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    fields["payload"] = payload
    return fields


def _page_id(record_id: str) -> str | None:
    return unquote(record_id[len("<urn:page:"):-1]) if record_id != "<urn:page>" else None


def _ids(texts, id_type: pa.DataType) -> pa.Array:
    return pa.array(texts, pa.string()).cast(id_type)


def _url(fields: dict) -> str | None:
    url = fields.get("WARC-Target-URI")
    return unquote(url) if ESCAPED in fields else url


def _runs(rows: list[tuple]):
    """Index rows of one file, by offset, in runs that one read fetches."""
    run: list[tuple] = []
    for row in rows:
        if run and (row[0] != run[-1][0] or row[1] - (run[-1][1] + run[-1][2]) > GAP_BYTES
                    or row[1] + row[2] - run[0][1] > READ_BYTES):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def _read(folder: str, with_payload: bool, id_type: pa.DataType):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    types = [id_type, pa.string(), pa.int64(), pa.string(), pa.string(), id_type] + [pa.binary()] * with_payload

    def run(batches):
        fs, root = _file_system(folder)
        name, source = None, None
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            for group in _runs(rows):
                if group[0][0] != name:
                    if source is not None:
                        source.close()
                    name = group[0][0]
                    source = fs.open_input_file(f"{root}/{name}")
                base = group[0][1]
                data = source.read_at(group[-1][1] + group[-1][2] - base, base)
                found = []
                for _, offset, length in group:
                    r = parse(zlib.decompress(data[offset - base:offset - base + length], 31))
                    revisit = r["WARC-Type"] == "revisit"
                    digest = r["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode() != digest:
                        raise ValueError(f"{name} at {offset}: payload does not match its digest")
                    found.append((_page_id(r["WARC-Record-ID"]), _url(r),
                                  int(r["http"]["Content-Length"]), digest, r["WARC-Type"],
                                  _page_id(r["WARC-Refers-To"]) if revisit else None,
                                  *((None if revisit else r["payload"],) if with_payload else ())))
                yield pa.RecordBatch.from_arrays([_ids(c, t) if n in ("page_id", "refers_to") else pa.array(c, t)
                                                  for n, c, t in zip(names, zip(*found), types)], names=names)
        if source is not None:
            source.close()
    return run


def read_records(index: DataFrame, folder: str, *, with_payload: bool = True) -> DataFrame:
    """The records of the given index rows: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to and, if asked for, the payload (null for revisits).

    ``payload_bytes`` and ``payload_digest`` are those of the full payload for
    revisits too. The payload of a response must match its digest.
    """
    id_field = index.schema["page_id"].dataType
    id_type = id_field.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    # index rows are narrow, so the number of readers follows from the bytes they stand for
    size = index.agg(F.sum("length")).first()[0] or 0
    rows = (index.select("file", "offset", "length").repartitionByRange(max(1, -(-size // TASK_BYTES)), "file", "offset")
            .sortWithinPartitions("file", "offset"))
    schema = (f"page_id {id_type}, url string, payload_bytes bigint, payload_digest string, record_type string, "
              f"refers_to {id_type}" + ", payload binary" * with_payload)
    return rows.mapInArrow(_read(folder, with_payload, to_arrow_type(id_field)), schema)
