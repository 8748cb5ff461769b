"""WARC archives of pages: a sharded writer whose records, headers and order depend on the pages alone.

Pages are range-sorted by address and id, each record is a gzip member of its own, and a file rolls once its
compressed size reaches the limit. Of equal payloads, the page with the least id is a response and the others are
revisits that refer to it. Files are written under temporary names, and those of the tasks that succeeded get their
numbers with the manifest, so a task that is lost or runs twice leaves nothing that is read.

The full payloads move once. Which pages are revisits is found on ids and digests; those few columns are sorted in
with the pages and reach the writer just before the page they are about.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.store import Tidy, arrow_schema, committed, folder, one_per_task, open_store, record, saved, short_batches

ROLL_BYTES = 256 << 20
#: Payloads of fewer bytes are always responses.
LEAST_BYTES = 0
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
#: Stands for a null id, so that a page with an id is the one to refer to.
LAST_ID = (1 << 63) - 1
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(data: bytes) -> str:
    """Upper-case base32 of SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page: int, url: str, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {payload_digest} {url}')}>"


def _plain(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def build(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode("utf-8") + block + b"\r\n\r\n"


def page_record(page: int, url: str, payload: bytes, first: tuple[int, str] | None) -> bytes:
    """A response, or a revisit of `first` (page, url)."""
    own = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Record-ID", record_id(page, url, own)), ("WARC-Date", DATE), ("WARC-Target-URI", _plain(url)), ("WARC-Payload-Digest", f"sha1:{own}"),
        ("Content-Type", "application/http; msgtype=response"), ("X-Page-ID", "" if page == LAST_ID else str(page)), ("X-Payload-Length", str(len(payload))),
    ]
    if first is None:
        return build("response", headers, http + payload)
    headers += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", record_id(*first, own)), ("WARC-Refers-To-Target-URI", _plain(first[1])), ("X-Refers-To-Page-ID", str(first[0]))]
    return build("revisit", headers, http)


WRITTEN = "temporary string, first_url string, first_id long, records long, bytes long, sha256 string"


class _File:
    def __init__(self, uri: str, first: tuple[str, int]) -> None:
        store, path = open_store(uri)
        self.first, self.temporary = first, f"_temporary-{uuid.uuid4().hex}"
        self.out = store.open_output_stream(f"{path}/{self.temporary}", compression=None)
        self.records = self.size = 0
        self.sha = hashlib.sha256()
        info = b"software: page archive writer\r\nformat: WARC File Format 1.1\r\n"
        self.add(build("warcinfo", [("WARC-Record-ID", record_id(first[1], first[0], digest(info))), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], info))

    def add(self, data: bytes) -> None:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        data = packer.compress(data) + packer.flush()
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)
        self.records += 1

    def close(self, schema) -> pa.RecordBatch:
        self.out.close()
        row = {"temporary": self.temporary, "first_url": self.first[0], "first_id": self.first[1], "records": self.records - 1, "bytes": self.size, "sha256": self.sha.hexdigest()}
        return record({k: [v] for k, v in row.items()}, schema)


def _write(schema, uri, roll, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    file, mark = None, (None, None)
    for batch in batches:
        columns = [batch.column(c) for c in ("url", "id", "same", "refers", "refers_url", "payload")]
        for row in zip(*columns, strict=True):  # a payload is copied when its turn comes
            url, page, same, refers, refers_url, payload = (x.as_py() for x in row)
            if refers is not None:
                mark = (url, page, same), (refers, refers_url)
                continue
            if file and file.size >= roll:
                yield file.close(schema)
                file = None
            file = file or _File(uri, (url, page))
            file.add(page_record(page, url, payload, mark[1] if mark[0] == (url, page, same) else None))
    if file:
        yield file.close(schema)


def write_warc(pages: DataFrame, uri: str, roll: int = ROLL_BYTES, least: int = LEAST_BYTES) -> DataFrame:
    """Write `pages` (page_id, url, html) as .warc.gz files below `uri`; returns the manifest, a row per file.

    Null html is an empty payload, null url an empty address. Every row is a record, repeated rows too; of rows with
    the least id and one payload all are responses. A null id is last: it refers to a page with an id if there is one.
    Of no rows, no files.
    """
    store, path = open_store(uri)
    store.create_dir(path, recursive=True)
    rows = pages.select(
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("page_id").cast("long"), F.lit(LAST_ID)).alias("id"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("same", F.sha2("payload", 256))
    keys = saved(rows.where(F.octet_length("payload") >= least).select("url", "id", "same"), "keys")
    first = keys.groupBy("same").agg(F.min(F.struct("id", "url")).alias("first"), F.max("id").alias("last")).where("first.id < last").select("same", F.col("first.id").alias("refers"), F.col("first.url").alias("refers_url"))
    marks = saved(keys.join(first, "same").where("id > refers").select("url", "id", "same", "refers", "refers_url"), "marks")
    marks = marks.withColumn("payload", F.lit(None).cast("binary"))
    both = rows.withColumns({"refers": F.lit(None).cast("long"), "refers_url": F.lit(None).cast("string")}).unionByName(marks)
    # a mark sorts right before the pages it is about
    lined = both.repartitionByRange("url", "id").sortWithinPartitions("url", "id", "same", F.col("refers").asc_nulls_last())
    return committed(lined.mapInArrow(Tidy(partial(_write, arrow_schema(WRITTEN), uri, roll)), WRITTEN), uri, ["first_url", "first_id"], "pages-%06d.warc.gz")


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record of an open .warc.gz stream."""
    lines = gzip.GzipFile(fileobj=stream, mode="rb")
    while first := lines.readline():
        if not first.strip():
            continue
        if not first.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = {}
        while line := lines.readline().rstrip(b"\r\n"):
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.lower()] = value.strip()
        block = lines.read(int(headers["content-length"]))
        if f"sha1:{digest(block)}" != headers["warc-block-digest"]:
            raise ValueError("damaged record")
        yield headers, block


READ = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string"


def _read(schema, uri, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    store, path = open_store(uri)
    number = lambda v: int(v) if v else None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return record(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema)

    for batch in batches:
        for name in batch.column("name").to_pylist():
            rows, size = [], 0
            with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                for h, block in read_records(stream):
                    if h["warc-type"] == "warcinfo":
                        continue
                    payload = block[block.index(b"\r\n\r\n") + 4 :] if h["warc-type"] == "response" else None
                    own = h["warc-payload-digest"].removeprefix("sha1:")
                    if payload is not None and (digest(payload) != own or len(payload) != int(h["x-payload-length"])):
                        raise ValueError("payload differs from its header")
                    rows.append((number(h["x-page-id"]), h["warc-target-uri"], payload, int(h["x-payload-length"]), own, h["warc-type"], number(h.get("x-refers-to-page-id")), h["warc-record-id"]))
                    size += len(block)
                    if size > 4 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
            if rows:
                yield batch_of(rows)


def read_warc(manifest: DataFrame, uri: str) -> DataFrame:
    """The records of the manifest's files; `payload` is null for revisits, digest and length are the full payload's."""
    return one_per_task(manifest.select("name")).mapInArrow(Tidy(partial(_read, arrow_schema(READ), uri)), READ)


def warc_report(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each page, from archives read back."""
    short_batches(pages.sparkSession)
    uri = folder(pages.sparkSession, "warc")
    return read_warc(write_warc(pages, uri), uri).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
