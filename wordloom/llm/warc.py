"""WARC archives, written and read index first (operator 7).

Every task writes its pages to an archive of its own, one gzip member per
record, and emits an index row per record: place, length, URL, digest. Readers
select index rows, sort them by place and fetch neighbouring records with one
ranged read; no archive is ever scanned.

Of records with equal payloads of at least MIN_REVISIT_BYTES, the one with the
largest id holds the payload and the others are revisit records that refer to
it. Smaller payloads are always written out.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import (
    input_file,
    output_stream,
    shuffle_partitions,
    stored,
    work_folder,
)

MIN_REVISIT_BYTES = 1000
MAX_GAP_BYTES = 64 << 10
MAX_READ_BYTES = 8 << 20
LEVEL = 6

# Names and values of the format. Fixed values.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"
DATE = "1970-01-01T00:00:00Z"  # when no crawl date is known

INDEX = (
    "page_id bigint, file string, offset bigint, length bigint, url string, "
    "payload_digest string, record_type string, refers_to bigint"
)
RECORDS = (
    "page_id bigint, url string, record_type string, refers_to bigint, "
    "header_digest string, payload binary"
)
_URI_SAFE = "!#$%&'()*+,/:;=?@[]~-._"


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _sha1_label(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """One record, uncompressed. A revisit has the HTTP header only.

    White space and control characters of the URL are percent-encoded, so no
    URL can break the header.
    """
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", quote(url, safe=_URI_SAFE))] if url else []),
        ("WARC-Payload-Digest", _sha1_label(digest)),
        *([("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to)),
           ("Refers-To-Page", str(refers_to))] if revisit else []),
        *([("Page-ID", str(page_id))] if page_id is not None else []),
        ("Content-Type", HTTP_TYPE),
        ("Content-Length", str(len(block))),
    ]
    header = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return header.encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not re.fullmatch(r"WARC/\d+\.\d+", version):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    length = int(fields["content-length"])
    block, end = rest[:length], rest[length:]
    if len(block) < length or end != b"\r\n\r\n":
        raise ValueError("a WARC record does not end where its header says")
    return fields, block.partition(b"\r\n\r\n")[2]


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def with_revisits(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, payload, digest) and ``refers_to``.

    Payloads themselves are not shuffled by digest: a digest may belong to a
    third of all pages. Digests and ids alone find the largest id of each
    repeated payload, summed up before the shuffle; the few columns of the
    result meet the pages by page id.
    """
    large = pages.where(F.octet_length("payload") >= MIN_REVISIT_BYTES)
    digests = large.select("digest", "page_id")
    repeated = (
        digests.groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("smallest"))
        .where("smallest < refers_to").drop("smallest")
    )
    revisits = (
        digests.join(repeated, "digest").where("page_id < refers_to").distinct()
        .withColumnRenamed("page_id", "revisit_id").withColumnRenamed("digest", "revisit_digest")
    )
    same = (pages["page_id"] == revisits["revisit_id"]) & (
        pages["digest"] == revisits["revisit_digest"]
    )
    return pages.join(revisits, same, "left").select(
        "page_id", "url", "payload", "digest", "refers_to"
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
) -> DataFrame:
    """Write a record for every row; the stored index has a row per record, INDEX.

    A null payload is empty; a null URL leaves out the target; rows with a null
    id are never revisits nor referred to; repeated rows give repeated records
    (rows of one id and payload are alike: all hold it, or all refer). Every
    attempt of a task writes an archive of its own and the index names those
    that count. An empty table gives no archive and an empty index.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        file, stream = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.warc.gz", None
        types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                 pa.string(), pa.int64())
        names = [field.split()[0] for field in INDEX.split(", ")]
        for batch in batches:
            rows = []
            for page_id, url, payload, digest, refers_to in zip(
                *(batch.column(c).to_pylist()
                  for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True
            ):
                stream = stream or output_stream(file)
                member, offset = _gzip(record(page_id, url, payload, digest, refers_to)), stream.tell()
                stream.write(member)
                kind = "response" if refers_to is None else "revisit"
                rows.append((page_id, file, offset, len(member), url, digest, kind, refers_to))
            if rows:
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    names=names,
                )
        if stream:
            stream.close()

    payload = F.encode(F.coalesce(pages[payload_column].cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        pages[id_column].cast("bigint").alias("page_id"),
        pages[url_column].cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
    )
    return stored(with_revisits(rows).mapInArrow(write, INDEX), "warc-index")


def _runs(rows: list[tuple[int, int]]) -> Iterator[list[int]]:
    """Positions of (offset, length) rows, sorted by offset, that one read fetches."""
    run: list[int] = []
    for k, (offset, length) in enumerate(rows):
        if run:
            begin, end = rows[run[0]][0], sum(rows[run[-1]])
            if offset - end > MAX_GAP_BYTES or offset + length - begin > MAX_READ_BYTES:
                yield run
                run = []
        run.append(k)
    if run:
        yield run


def read_records(index: DataFrame) -> DataFrame:
    """RECORDS of the index rows given, any selection of them.

    Rows are sorted by place; neighbours at most MAX_GAP_BYTES apart come with
    one read of up to MAX_READ_BYTES. All values are from the archives;
    ``payload`` is null for revisits.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
        names = [field.split()[0] for field in RECORDS.split(", ")]
        path, file = None, None
        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist()
                                for c in ("file", "offset", "length")), strict=True))
            for name in dict.fromkeys(p[0] for p in places):
                inside = [(o, n) for f, o, n in places if f == name]
                if name != path:
                    path, file = name, input_file(name)
                for run in _runs(inside):
                    begin = inside[run[0]][0]
                    blob = file.read_at(sum(inside[run[-1]]) - begin, begin)
                    rows = []
                    for k in run:
                        offset, length = inside[k]
                        member = blob[offset - begin : offset - begin + length]
                        fields, body = parse(zlib.decompress(member, 31))
                        rows.append(_row(fields, body))
                    yield pa.record_batch(
                        [pa.array(c, t)
                         for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                        names=names,
                    )

    order = ["file", "offset"]
    placed = index.select("file", "offset", "length").repartitionByRange(
        shuffle_partitions(index.sparkSession), *order
    )
    return placed.sortWithinPartitions(*order).mapInArrow(read, RECORDS)


def _row(fields: dict[str, str], body: bytes) -> tuple:
    kind = fields["warc-type"]
    page, refers = fields.get("page-id"), fields.get("refers-to-page")
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    payload = body if kind == "response" else None
    if payload is not None and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of page {page} does not have the digest of its header")
    return (page and int(page), fields.get("warc-target-uri"), kind, refers and int(refers),
            digest, payload)


def page_report(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of read records.

    A revisit's payload is that of the record it refers to: size and digest come
    from there, met by page id and digest.
    """
    measured = records.select(
        "page_id", "record_type", "refers_to", "header_digest",
        F.octet_length("payload").cast("bigint").alias("own_bytes"),
        F.sha1("payload").alias("own_digest"),
    )
    measured = stored(measured, "warc-read")
    revisits = measured.where("record_type = 'revisit'")
    targets = (
        measured.where("record_type = 'response'")
        .join(revisits.select(F.col("refers_to").alias("page_id")).distinct(), "page_id", "left_semi")
        .select(F.col("page_id").alias("refers_to"), F.col("own_digest").alias("header_digest"),
                F.col("own_bytes").alias("full_bytes"), F.col("own_digest").alias("full_digest"))
        .distinct()
    )
    columns = lambda size, digest: [
        F.col("page_id"), _as(size, "payload_bytes"), _as(digest, "payload_digest"),
        F.col("record_type"), F.col("refers_to"),
    ]
    followed = revisits.join(targets, ["refers_to", "header_digest"], "left")
    responses = measured.where("record_type = 'response'")
    return responses.select(*columns("own_bytes", "own_digest")).unionByName(
        followed.select(*columns("full_bytes", "full_digest"))
    )


def _as(name: str, alias: str) -> Column:
    return F.col(name).alias(alias)


def archived_and_read_back(pages: DataFrame) -> DataFrame:
    """Write all pages to new archives in the shared folder, and read every record."""
    index = write_archives(pages, work_folder(pages.sparkSession, "warc"))
    return page_report(read_records(index))
