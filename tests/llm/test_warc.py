import gzip
import hashlib
from collections import Counter

import pytest

from wordloom.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    big = "é" * 700 + "<p>text</p>"
    rows = [
        (1, "http://a/ü x\r\nEvil: 1", big), (2, None, big), (9, "http://b", big), (9, "http://b", big),
        (3, "http://c", "tiny"), (4, "http://c", "tiny"), (5, "", None), (6, "u", ""),
        (7, "http://d", "x\r\n\r\ny" * 300), (8, None, "WARC/1.1\r\n\r\n" * 200),
        (None, None, big), (10, "http://e", "z" * 3_000_000), (11, "f", "q" * 999), (12, "f", "q" * 999),
        (13, "g", "q" * 1000), (14, "g", "q" * 1000),
    ]
    rows = [(*r, "response", "file", 7) for r in rows] + [(None,) * 6]
    return spark.createDataFrame(
        rows, "page_id long, url string, html string, record_type string, file string, offset long")


def expected(pages):
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    top = {}
    for i, p in rows:
        if len(p) >= 1000 and i is not None:
            top[p] = max(i, top.get(p, i))
    out = []
    for i, p in rows:
        refers = top.get(p) if i is not None and i < top.get(p, i) else None
        out.append((i, len(p), hashlib.sha1(p).hexdigest(),
                    "response" if refers is None else "revisit", refers))
    return Counter(out)


def test_report(pages):
    found = warc.archived_and_read_back(pages)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(tuple(r) for r in found.collect()) == expected(pages)


def test_archives_are_valid_and_index_points_into_them(pages, tmp_path):
    index = warc.write_archives(pages, str(tmp_path)).collect()
    assert len(index) == pages.count()
    for file in {r.file for r in index}:
        data, ends = open(file, "rb").read(), 0
        for r in sorted((r for r in index if r.file == file), key=lambda r: r.offset):
            assert r.offset == ends
            ends += r.length
            whole = gzip.decompress(data[r.offset : ends])
            fields, body = warc.parse(whole)
            assert fields.get("page-id") == (None if r.page_id is None else str(r.page_id))
            assert "evil" not in fields
            assert (fields["warc-type"], body == b"") == (r.record_type, not body)
        assert ends == len(data)
        gzip.decompress(data)


@pytest.mark.parametrize("gap", [0, 1 << 30])
def test_selected_records_only(pages, tmp_path, monkeypatch, gap):
    monkeypatch.setattr(warc, "MAX_GAP_BYTES", gap)
    index = warc.write_archives(pages, str(tmp_path))
    some = warc.read_records(index.where("page_id in (3, 7, 8, 10)")).collect()
    texts = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    assert {r.page_id: bytes(r.payload) for r in some} == {i: texts[i] for i in (3, 7, 8, 10)}


def test_runs():
    rows = [(0, 10), (10, 10), (100_000, 5), (100_005, 9 << 20), (10 << 20, 1)]
    assert list(warc._runs(rows)) == [[0, 1], [2], [3], [4]]


def test_no_pages(pages, tmp_path):
    index = warc.write_archives(pages.limit(0), str(tmp_path))
    assert warc.page_report(warc.read_records(index)).count() == 0
