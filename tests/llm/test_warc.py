"""Archives: round trips, revisits, segments in any order and damaged files."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re
from collections import defaultdict
from pathlib import Path

import pytest

from bumpwise.llm.warc import (
    body_of,
    chunked,
    parse_records,
    read_archives,
    resolve_revisits,
    unchunked,
    write_archives,
)

SHAPE = "page_id long, url string, html string"


def sha1(text: str | None) -> str:
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def wanted(rows):
    """(page_id, bytes, digest, type, refers_to) of each row, by brute force."""
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[html or ""].append(page)
    out = []
    for page, _, html in rows:
        known = [p for p in groups[html or ""] if p is not None]
        leader = max(known) if known and len(groups[html or ""]) > 1 else None
        revisit = leader is not None and page != leader
        out.append((page, len((html or "").encode()), sha1(html), "revisit" if revisit else "response", leader if revisit else None))
    return sorted(out, key=repr)


def written(spark, path_for, rows, extra=False, **options):
    pages, path = spark.createDataFrame(rows, SHAPE), path_for("warc")
    if extra:
        pages = pages.selectExpr("*", "'x' AS payload", "'y' AS record_id", "'z' AS leader", "1 AS n", "2 AS content")
    write_archives(pages.repartition(3), path, **options)
    return path


def read(spark, path):
    found = resolve_revisits(read_archives(spark, path))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert found.where("error IS NOT NULL").count() == 0
    return sorted(map(tuple, found.select(*names).collect()), key=repr), found


AWKWARD = [
    (1, "http://a.example/é b\r\nx", "<p>one</p>"),
    (2, None, None),
    (3, "u", ""),
    (4, "u", "<p>one</p>"),
    (4, "v", "<p>one</p>"),
    (None, "w", "<p>one</p>"),
    (None, "w", "nobody else has this"),
    (-7, "w", "é漢🙂" * 40_000),
    (8, "w", "é漢🙂" * 40_000),
    (8, "w", "é漢🙂" * 40_000),
    (9, "w", "0\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 900),
    (10, "w", "x" * (1 << 20)),
]


def test_round_trip_of_awkward_pages(spark, path_for):
    path = written(spark, path_for, AWKWARD, extra=True, segment_bytes=700, pack_bytes=5000)
    got, found = read(spark, path)
    assert got == wanted(AWKWARD)
    texts = {row.page_id: bytes(row.payload).decode() for row in found.where("record_type = 'response'").collect()}
    assert texts.pop(None) == "nobody else has this"
    assert all(texts[page] == (html or "") for page, _, html in AWKWARD if page in texts)


def test_files_stay_small_and_are_valid_archives(spark, path_for):
    path = written(spark, path_for, AWKWARD, segment_bytes=700, pack_bytes=5000)
    files = list(Path(path).glob("part-*"))
    assert len(files) > 20
    assert all(f.stat().st_size <= 4 * (5000 + 2000) for f in files)
    for file in files:
        assert all(block is not None for _, block in parse_records(file.read_bytes()))


def test_a_payload_that_most_pages_share(spark, path_for, shuffled_joins):
    chosen = random.Random(5)
    rows = [(page, "u", "common" if chosen.random() < 0.6 else f"own {page % 50}") for page in range(600)]
    assert read(spark, written(spark, path_for, rows))[0] == wanted(rows)


def test_short_payloads_are_responses_below_the_limit(spark, path_for):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    got, _ = read(spark, written(spark, path_for, rows, least_revisit_bytes=3))
    assert [row[3] for row in got] == ["response", "response", "revisit", "response"]


def test_empty_table(spark, path_for):
    path = written(spark, path_for, [])
    assert resolve_revisits(read_archives(spark, path)).count() == 0


def rewritten(path, change) -> None:
    """One file of all records of `path`, given to `change` and written in its order."""
    files, records = sorted(Path(path).glob("part-*")), []
    for file in files:
        for fields, block in parse_records(file.read_bytes()):
            lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items())]
            records.append((fields, "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"))
        file.unlink()
        Path(f"{file.parent}/.{file.name}.crc").unlink(missing_ok=True)
    (Path(path) / "part-all.warc").write_bytes(change(records))


LONG = [(1, "u", "abc " * 2000), (2, "u", "def " * 2000)]


@pytest.mark.parametrize("packed", [False, True])
def test_segments_in_any_order(spark, path_for, packed):
    path = written(spark, path_for, LONG, segment_bytes=500)

    def mixed(records):
        random.Random(2).shuffle(records)
        members = [record for _, record in records]
        return b"".join(map(gzip.compress, members) if packed else members)

    rewritten(path, mixed)
    assert read(spark, path)[0] == wanted(LONG)


def errors(spark, path):
    rows = resolve_revisits(read_archives(spark, path)).select("page_id", "payload_bytes", "error").collect()
    return sorted((tuple(row) for row in rows), key=repr)


def test_a_missing_segment_is_an_error_of_its_record_alone(spark, path_for):
    path = written(spark, path_for, LONG, segment_bytes=500)
    lost = lambda fields: fields.get("warc-segment-number") == "3" and "/" not in fields["warc-record-id"]

    def without(records):
        first = next(i for i, (fields, _) in enumerate(records) if lost(fields))
        return b"".join(record for i, (_, record) in enumerate(records) if i != first)

    rewritten(path, without)
    found = errors(spark, path)
    assert sorted(error or "" for *_, error in found) == ["", "a segment is missing"]
    assert sorted(size or 0 for _, size, _ in found) == [0, 8000]


def test_a_wrong_total_is_an_error(spark, path_for):
    path = written(spark, path_for, LONG[:1], segment_bytes=500)
    rewritten(path, lambda records: re.sub(rb"(total-length: )\d+", rb"\g<1>99", b"".join(r for _, r in records)))
    assert errors(spark, path) == [(1, None, "a record of another length than stated")]


def test_a_damaged_record_does_not_hide_the_next(spark, path_for):
    path = written(spark, path_for, [(1, "u", "one"), (2, "u", "two"), (3, "u", "three")])
    rewritten(
        path,
        lambda records: b"".join(
            record.replace(b"content-length: ", b"content-length: x") if f["warc-page-id"] == "2" else record
            for f, record in records
        ),
    )
    assert errors(spark, path) == [(1, 3, None), (2, None, "a damaged record"), (3, 5, None)]


def test_another_digest_than_stated_is_an_error(spark, path_for):
    path = written(spark, path_for, [(1, "u", "one")])
    rewritten(path, lambda records: records[0][1].replace(b"one", b"eno"))
    assert errors(spark, path) == [(1, None, "a payload of another digest than stated")]


def test_a_revisit_without_its_response(spark, path_for):
    path = written(spark, path_for, [(1, "u", "one"), (2, "u", "one")])
    rewritten(path, lambda records: b"".join(r for f, r in records if f["warc-type"] == "revisit"))
    row = resolve_revisits(read_archives(spark, path)).first()
    assert (row.page_id, row.payload_bytes, row.refers_to, row.payload_digest) == (1, None, None, sha1("one"))


def test_chunked_framing():
    data = bytes(range(256)) * 50
    assert unchunked(chunked(data, 7)) == data
    assert unchunked(b"3;name=value\r\nabc\r\nA\r\n0123456789\r\n0\r\nTrailer: x\r\n\r\n") == b"abc0123456789"
    assert body_of(b"HTTP/1.1 200 OK\r\nContent-Type: a\r\n\r\nplain") == b"plain"
    for broken in (b"", b"3\r\nabcd\r\n0\r\n\r\n", b"zz\r\n", b"5\r\nabc", b"-3\r\nabc\r\n"):
        with pytest.raises(ValueError):
            unchunked(broken)
