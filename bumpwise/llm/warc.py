"""WARC archives: writing pages as records, and reading them back by reassembling segments.

Writing. A page is a `response` record: an HTTP answer whose body is the payload in chunked transfer
framing. Where a payload occurs more than once, the row with the largest id is the response and the
others are `revisit` records that refer to it. A block longer than `segment_bytes` is cut: its
first segment is the record itself, the others are `continuation` records that carry the identifier
of that origin and their number, the last one also the total length. Records are packed into rows of
about `pack_bytes`, so no file is larger than a few packs and writing needs no shuffle.

Reading. Files are parsed by the lengths that their records state. Whole records are decoded where
they are read. Segments are grouped by their origin and ordered by number in a sorted shuffle, which
a task reads as a stream: only one record is held at a time. Its numbers must be gapless, its length
must be the stated total, and its chunks must add up. `resolve_revisits` then gives each revisit the
size and the id of its response.

Nulls: a null payload is empty; a null id is a page like any other, never a response while its group
has an id; a null address leaves its field out. Repeated rows (id and payload) are records of their
own with one identifier; read back, such a record comes out as often as its first segment is there.
Ties of the largest id are such repeated rows, and all of them are responses. An empty table gives
an empty archive and result. Other columns of `pages` are not read, so names cannot clash. A damaged
record is a row with `error` and without a payload; reading goes on at the next record of the file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bumpwise.llm.common import stored, table
from bumpwise.operators.keyed import attach_by_key
from bumpwise.session import work_path

SEGMENT_BYTES = 8 << 10
PACK_BYTES = 8 << 20
PACKS_PER_FILE = 4
CHUNK_BYTES = 4 << 10

# fixed values: the marks of the formats
_LINE, _GAP = b"\r\n", b"\r\n\r\n"
_VERSION = b"WARC/1.1"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEADERS = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

READ = (
    "record_id string, page_id long, uri string, record_type string, refers string, "
    "stated_digest string, payload_digest string, payload_bytes long, payload binary, error string"
)
_SEGMENT = "origin string, number long, total long, head string, block binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts += [b"%x\r\n" % len(piece), piece, _LINE]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped, a bad frame is an error."""
    parts, at = [], 0
    while True:
        end = body.find(_LINE, at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            raise ValueError("a chunk without a size")
        length, at = int(size, 16), end + 2
        if not length:
            return b"".join(parts)
        if body[at + length : at + length + 2] != _LINE:
            raise ValueError("a chunk of another length than stated")
        parts.append(body[at : at + length])
        at += length + 2


def body_of(block: bytes) -> bytes:
    """The decoded body of an HTTP answer."""
    head, gap, body = block.partition(_GAP)
    if not gap:
        raise ValueError("an answer without the end of its headers")
    fields = _fields(head.split(_LINE)[1:])
    is_chunked = fields.get("transfer-encoding", "").lower().split(",")[-1].strip() == "chunked"
    return unchunked(body) if is_chunked else body


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [_VERSION, *(f"{k}: {v}".encode() for k, v in fields if v is not None)]
    return b"".join([_LINE.join(lines), b"\r\nContent-Length: %d" % len(block), _GAP, block])


def _page_records(row: dict, date: str, segment_bytes: int) -> Iterator[bytes]:
    """The records of one page, without the gaps between them."""
    own = f"<urn:uuid:{row['record_id']}>"
    uri = None if row["uri"] is None else quote(row["uri"], safe="!#$%&'()*+,/:;=?@[]~")
    head = [("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{row['digest']}")]
    if row["page_id"] is not None:
        head.append(("WARC-Page-ID", str(row["page_id"])))
    kind = ("Content-Type", "application/http; msgtype=response")
    if row["refers"] is not None:
        refers = [("WARC-Profile", _REVISIT), ("WARC-Refers-To", f"<urn:uuid:{row['refers']}>")]
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *head, *refers, kind], _HEADERS)
        return
    block = _HEADERS + chunked(row["payload"])
    first = [("WARC-Type", "response"), ("WARC-Record-ID", own), *head, kind]
    if len(block) <= segment_bytes:
        yield _record(first, block)
        return
    count = -(-len(block) // segment_bytes)
    yield _record([*first, ("WARC-Segment-Number", "1")], block[:segment_bytes])
    for nth in range(2, count + 1):
        fields = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.UUID(row['record_id']), str(nth))}>"),
            ("WARC-Segment-Origin-ID", own),
            ("WARC-Segment-Number", str(nth)),
            ("WARC-Segment-Total-Length", str(len(block)) if nth == count else None),
            *head[:2],
        ]
        yield _record(fields, block[(nth - 1) * segment_bytes : nth * segment_bytes])


def _packs(date: str, segment_bytes: int, pack_bytes: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, held = [], 0
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                row["digest"] = base32_sha1(row["payload"])
                for record in _page_records(row, date, segment_bytes):
                    pack.append(record)
                    held += len(record)
                    if held >= pack_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array([_GAP.join(pack)], pa.binary())], ["pack"])
                        pack, held = [], 0
        if pack:
            yield pa.RecordBatch.from_arrays([pa.array([_GAP.join(pack)], pa.binary())], ["pack"])

    return work


def _record_id(page_id: Column, content: Column) -> Column:
    """An identifier in the form of a uuid that id and payload decide."""
    digits = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("null")), content).cast("binary"))
    return F.concat_ws("-", *[F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def write_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    payload: str = "html",
    uri: str | None = "url",
    least_revisit_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
    pack_bytes: int = PACK_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Writes a record per row of `pages` to archive files in the folder `path`.

    Payloads shorter than `least_revisit_bytes` are always responses. The groups of equal payloads
    are found by digests alone; a payload meets them in a join that spreads the rows of large groups.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        (F.col(uri).cast("string") if uri else F.lit(None).cast("string")).alias("uri"),
        body.alias("payload"),
        F.sha2(body, 256).alias("content"),
    )
    long_enough = F.octet_length("payload") >= least_revisit_bytes
    groups = rows.where(long_enough).groupBy("content").agg(F.max("page_id").alias("leader"), F.count(F.lit(1)).alias("n"))
    groups = stored(groups.where("n > 1 AND leader IS NOT NULL"), "warc-groups")
    known = attach_by_key(rows, groups, ["content"], "n", spread_by=["page_id", "uri"])
    revisits = F.col("leader").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("leader"))
    # a revisit's payload goes as far as the task that writes it, which takes its digest
    records = known.select(
        "page_id",
        "uri",
        "payload",
        _record_id(F.col("page_id"), F.col("content")).alias("record_id"),
        F.when(revisits, _record_id(F.col("leader"), F.col("content"))).alias("refers"),
    )
    packs = records.mapInArrow(_packs(date, segment_bytes, pack_bytes), "pack binary")
    writer = packs.select(F.col("pack").cast("string").alias("value")).write
    writer.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", PACKS_PER_FILE).text(path)


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(fields, block) of each record of a file; a damaged record has no block."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at, size = 0, len(content)
    while at < size:
        if content.startswith(_LINE, at):
            at += 2
            continue
        end = content.find(_GAP, at)
        fields = _fields(content[at : max(end, at)].split(_LINE)[1:])
        length = fields.get("content-length", "")
        good = end >= 0 and content.startswith(b"WARC/", at) and length.isascii() and length.isdigit()
        start = end + 4
        stop = start + int(length) if good else at
        if good and (stop == size or content.startswith(_LINE, stop)):
            yield fields, content[start:stop]
            at = stop
        else:
            yield fields, None
            found = content.find(b"\r\n\r\nWARC/", at + 1)
            at = found + 4 if found >= 0 else size


def _bare(identifier: str | None) -> str | None:
    return identifier and identifier.strip("<>").removeprefix("urn:uuid:")


def _decoded(fields: dict[str, str], block: bytes | None, error: str | None, payloads: bool) -> tuple:
    """A row of READ."""
    kind, page = fields.get("warc-type"), fields.get("warc-page-id", "")
    payload = None
    if error is None and kind == "response":
        try:
            payload = body_of(block)
        except ValueError as fault:
            error = str(fault)
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    own = None if payload is None else base32_sha1(payload)
    if own and stated and own != stated:
        error = "a payload of another digest than stated"
    return (
        _bare(fields.get("warc-record-id")),
        int(page) if re.fullmatch(r"-?[0-9]+", page) else None,
        fields.get("warc-target-uri"),
        kind,
        _bare(fields.get("warc-refers-to")),
        stated,
        None if error else own,
        None if error or payload is None else len(payload),
        payload if payloads and not error else None,
        error,
    )


_ARROW = pa.schema(
    [
        ("record_id", pa.string()),
        ("page_id", pa.int64()),
        ("uri", pa.string()),
        ("record_type", pa.string()),
        ("refers", pa.string()),
        ("stated_digest", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
        ("error", pa.string()),
    ]
)
_ARROW_SEGMENT = pa.schema(
    [("origin", pa.string()), ("number", pa.int64()), ("total", pa.int64()), ("head", pa.string()), ("block", pa.binary())]
)


def _batched(rows: Iterator[tuple], schema: pa.Schema, sized: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded bytes; `sized` is the place of the large column."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 200 + len(row[sized] or b"")
        if weight >= 4 << 20:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, str], bytes | None]]:
    for batch in batches:
        for content in batch.column(0):
            yield from parse_records(content.as_py())


def _is_segment(fields: dict[str, str], block: bytes | None) -> bool:
    return block is not None and ("warc-segment-number" in fields or fields.get("warc-type") == "continuation")


def _whole(payloads: bool) -> Callable:
    def rows(batches):
        for fields, block in _files(batches):
            if not _is_segment(fields, block) and fields.get("warc-type") != "warcinfo":
                yield _decoded(fields, block, None if block is not None else "a damaged record", payloads)

    return lambda batches: _batched(rows(batches), _ARROW, 8)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def number(fields, name):
        text = fields.get(name, "")
        return int(text) if text.isascii() and text.isdigit() else None

    def rows():
        for fields, block in _files(batches):
            if _is_segment(fields, block):
                nth = number(fields, "warc-segment-number")
                origin = fields.get("warc-segment-origin-id") or fields.get("warc-record-id")
                # the fields of the first segment stand for the record
                head = "\n".join(f"{k}: {v}" for k, v in fields.items()) if nth == 1 else None
                yield _bare(origin), nth, number(fields, "warc-segment-total-length"), head, block

    return _batched(rows(), _ARROW_SEGMENT, 4)


def _joined(payloads: bool) -> Callable:
    """Segments in the order of origin and number -> records, one held at a time."""

    def finished(origin, heads, blocks, numbers, totals):
        fields = _fields(heads[0].encode().split(b"\n")) if heads else {"warc-record-id": origin or "", "warc-type": None}
        block, error = b"".join(blocks), None
        if numbers != list(range(1, len(numbers) + 1)):
            error = "a segment is missing"
        elif not totals or any(total != len(block) for total in totals):
            error = "a record of another length than stated"
        for _ in range(max(len(heads), 1)):
            yield _decoded(fields, block, error, payloads)

    def rows(batches):
        open_, heads, blocks, numbers, totals = None, [], [], [], []
        for batch in batches:
            for at in range(batch.num_rows):
                origin, nth, total, head, block = (batch.column(i)[at].as_py() for i in range(5))
                if (origin,) != open_:
                    if open_:
                        yield from finished(open_[0], heads, blocks, numbers, totals)
                    open_, heads, blocks, numbers, totals = (origin,), [], [], [], []
                if head is not None:
                    heads.append(head)
                if total is not None:
                    totals.append(total)
                if not numbers or numbers[-1] != nth:  # copies of a segment are read once
                    numbers.append(nth)
                    blocks.append(block)
        if open_:
            yield from finished(open_[0], heads, blocks, numbers, totals)

    return lambda batches: _batched(rows(batches), _ARROW, 8)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archive files under `path`, as READ; plain or gzip-compressed files.

    A file is one value of a task, so files must be well below 2 GB. `payloads=False` leaves the
    payload column null.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    whole = files.mapInArrow(_whole(payloads), READ)
    segments = files.mapInArrow(_segments, _SEGMENT)
    ordered = segments.repartition("origin").sortWithinPartitions("origin", "number")
    return whole.unionByName(ordered.mapInArrow(_joined(payloads), READ))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """`records` with `refers_to`, and with size and digest of their response for revisits.

    A revisit whose response is not there keeps its stated digest and has no size. Responses that
    are referred to meet their revisits in a join that spreads those of a frequent one.
    """
    revisits = records.where("record_type = 'revisit'")
    wanted = revisits.where("refers IS NOT NULL").groupBy("refers").agg(F.count(F.lit(1)).alias("n"))
    there = records.where("record_type = 'response' AND error IS NULL").groupBy(F.col("record_id").alias("refers"))
    there = there.agg(
        F.max("page_id").alias("refers_to"),
        F.max("payload_bytes").alias("_bytes"),
        F.max("payload_digest").alias("_digest"),
    )
    found = stored(wanted.join(there, "refers"), "warc-referred")
    joined = attach_by_key(revisits, found, ["refers"], "n", spread_by=["record_id", "page_id"])
    joined = joined.withColumn("payload_bytes", F.col("_bytes")).withColumn(
        "payload_digest", F.coalesce("_digest", "stated_digest")
    )
    others = records.where("record_type IS NULL OR record_type <> 'revisit'")
    others = others.withColumn("refers_to", F.lit(None).cast("long"))
    return others.unionByName(joined.select(*others.columns))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    records = stored(read_archives(spark, path, payloads=False), "warc-records")
    return resolve_revisits(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error"
    )


_DIGITS = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({five} >> {shift}) & 31) + 1, 1)"
_BASE32 = " || ".join(
    _DIGITS.format(five=f"('0x' || substr(sha1(body), {at}, 5))::INTEGER", shift=shift)
    for at in range(1, 41, 5)
    for shift in (15, 10, 5, 0)
)
OP11_SQL = f"""
WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
led AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS leader FROM bodies)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN leader IS NULL OR page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN leader IS NULL OR page_id = leader THEN NULL ELSE leader END AS refers_to,
       NULL::VARCHAR AS error
FROM led
"""
