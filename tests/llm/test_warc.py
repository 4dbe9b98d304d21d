import gzip
import hashlib
import random

import pytest

from saleslane.llm import warc
from saleslane.llm.shared import fresh_path

PAGES = "page_id long, url string, html string"


def expected(pages):
    out = []
    for page_id, _, html in pages:
        body = (html or "").encode()
        equal = [p for p, _, h in pages if p is not None and (h or "") == (html or "")]
        other = len(body) >= 1000 and page_id is not None and max(equal) != page_id
        kind = ("revisit", max(equal)) if other else ("response", None)
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), *kind))
    return sorted(out, key=str)


def result(spark, rows, schema=PAGES):
    made = warc.round_trip(spark.createDataFrame(rows, schema), fresh_path(spark, "warc"))
    return sorted(map(tuple, made.collect()), key=str)


def test_cases(spark):
    long, other = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 90, "0\r\n\r\n" * 40_000
    pages = [(1, "http://a/", long), (5, "http://a/x\r\nX-Page-ID: 9", long), (3, None, long)]
    pages += [(2, "u", None), (4, "u", ""), (6, "u", "x" * 999), (7, "u", "x" * 999)]
    pages += [(8, "u", "x" * 1000), (9, "u", "x" * 1000), (10, "u", other), (11, "v", other)]
    pages += [(None, "n", long), (None, None, "short"), (12, "漢", "é" * 100_000)]
    assert result(spark, pages) == expected(pages)
    wide = [(*page, "x", "y") for page in pages]
    assert result(spark, wide, PAGES + ", payload string, digest string") == expected(pages)


def test_repeated_pages_and_empty_table(spark):
    body = "z" * 2000
    rows = result(spark, [(1, "u", body), (2, "u", body), (2, "u", body)])
    digest = hashlib.sha1(body.encode()).hexdigest()
    assert rows == [(1, 2000, digest, "revisit", 2), (2, 2000, digest, "response", None)] + [
        (2, 2000, digest, "response", None)
    ]
    assert result(spark, []) == []


@pytest.mark.parametrize("size", [900, 2000, 40_000])
def test_every_repeated_row_comes_back(spark, size):
    one, other = "z" * size, "y" * (size + 1)
    pages = [(1, "u", one), (2, "u", one), (2, "u", one), (2, None, one), (2, "v", one), (2, "u", other)]
    pages += [(3, "u", other), (0, "u", other), (0, "u", other)] + [(None, "n", one)] * 3
    pages += [(None, None, one)] * 2 + [(None, None, None)] * 2 + [(5, "u", "x" * size)] * 2
    assert result(spark, pages) == expected(pages)


def test_record_ids_are_unique(spark, tmp_path):
    body = "z" * 2000
    pages = [(1, "u", body), (2, "u", body), (2, "u", body), (2, "v", body)] + [(None, "n", body)] * 3
    rows = spark.createDataFrame(pages, PAGES).repartition(3)
    warc.write_archives(warc.with_record_types(rows), str(tmp_path / "w"))
    records = warc.read_archives(spark, str(tmp_path / "w")).collect()
    by_id = {r["record_id"]: r for r in records}
    assert len(by_id) == len(records) == len(pages)
    assert [by_id[r["refers_to_id"]]["page_id"] for r in records if r["refers_to_id"]] == [2]


def test_archives_follow_the_format(spark, tmp_path):
    body = "y" * 40_000
    rows = spark.createDataFrame([(1, "http://a/", body), (2, "http://b/", "b")], PAGES)
    warc.write_archives(warc.with_record_types(rows), str(tmp_path / "w"))
    records = [
        record
        for file in (tmp_path / "w").glob("*.gz")
        for record in warc.parse_archive(gzip.decompress(file.read_bytes()))
    ]
    segments = sorted((r for r in records if r["number"]), key=lambda r: r["number"])
    assert [r["record_type"] for r in segments] == ["response", "continuation", "continuation"]
    assert len({r["origin_id"] for r in segments}) == 1
    block = b"".join(r["block"] for r in segments)
    assert len(block) == segments[-1]["total_length"]
    assert warc.http_payload(block) == body.encode()


def test_chunked_framing():
    for body in (b"", b"a", b"\r\n0\r\n\r\n" * 3000):
        assert warc.dechunked(warc.chunked(body)) == body
    assert warc.dechunked(b"3;name=x\r\nabc\r\n0\r\nTrailer: y\r\n\r\n") == b"abc"
    for broken in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"x\r\nabc\r\n", b"3\r\nabc\r\n", b"-1\r\n"):
        with pytest.raises(warc.CorruptRecord):
            warc.dechunked(broken)


def segment(number, block, total=None, origin="o"):
    head = {"record_id": "o", "record_type": "response", "page_id": 1} if number == 1 else {}
    values = {"origin_id": origin, "number": number, "total_length": total, "block": block, **head}
    names = [pair.split()[0] for pair in warc.PARSED.split(", ")]
    return tuple(values.get(name) for name in names)


def test_segments_from_anywhere_in_any_order(spark):
    parts = [segment(3, b"c", 3), segment(1, b"a"), segment(2, b"b"), segment(2, b"b")]
    rows = warc.reassembled(spark.createDataFrame(parts, warc.PARSED)).collect()
    assert [(r["record_id"], bytes(r["block"])) for r in rows] == [("o", b"abc")]


@pytest.mark.parametrize(
    "parts",
    [
        [segment(1, b"a"), segment(3, b"c", 2)],
        [segment(1, b"a"), segment(2, b"b")],
        [segment(1, b"a"), segment(2, b"b", 3)],
        [segment(2, b"b", 1)],
    ],
)
def test_broken_segments_stop_the_job(spark, parts):
    with pytest.raises(Exception, match="not whole"):
        warc.reassembled(spark.createDataFrame(parts, warc.PARSED)).collect()


def test_a_long_record_is_joined_in_one_go(spark):
    """Thousands of segments in any order, and one of them twice."""
    body = bytes(range(256)) * 400
    block = warc.HTTP_HEAD + warc.chunked(body)
    pieces = [block[at : at + 20] for at in range(0, len(block), 20)]
    parts = []
    for number, piece in enumerate(pieces, 1):
        last = len(block) if number == len(pieces) else None
        parts.append(("r" if number == 1 else f"r{number}", "r", number, last, "response" if number == 1 else "continuation",
                      7 if number == 1 else None, None, None, "d", piece))
    random.Random(4).shuffle(parts)
    rows = warc.reassembled(spark.createDataFrame([*parts, parts[9]], warc.PARSED)).collect()
    assert [(r["page_id"], warc.http_payload(r["block"])) for r in rows] == [(7, body)] and len(parts) > 5000


def test_many_copies_of_one_row_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "COPIES_IN_TASK", 7)
    page = (1, "http://a/", "x" * 1200)
    rows = spark.createDataFrame([page] * 100 + [(2, "http://b/", "short")] * 3 + [(None, None, None)] * 20, PAGES)
    path = str(tmp_path / "w")
    warc.write_archives(warc.with_record_types(rows), path)
    holding = [f for f in (tmp_path / "w").glob("*.gz") if b"http://a/" in gzip.decompress(f.read_bytes())]
    assert len(holding) > 1
    found = warc.payloads_of(
        warc.read_archives(spark, path).selectExpr(
            "record_id", "refers_to_id", "page_id", "record_type",
            "cast(octet_length(payload) as long) payload_bytes", "sha1(payload) payload_digest",
        )
    ).collect()
    assert len(found) == 123 and len({r["payload_bytes"] for r in found if r["page_id"] == 1}) == 1
