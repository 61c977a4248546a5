import gzip
import hashlib
import io

import pytest

from millrace.llm import warc

PAGES = "page_id long, url string, html string, date string"


def want(rows):
    found = []
    first = {}
    for page, _, html, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        body = (html or "").encode()
        first.setdefault(body, page)
    seen = set()
    for page, _, html, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        body = (html or "").encode()
        again = len(body) >= 100 and body in seen
        seen.add(body)
        found.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[body] if again else None))
    return sorted(found, key=repr)


def test_pages(spark):
    long, wide = "x" * 100, "é\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(5, "http://a/b c?d#e", long), (3, "http://a/\r\nEvil: 1", long), (9, None, long), (4, "", None), (8, "u", ""), (1, "http://ü/ß", wide), (2, "x", wide), (2, "x", wide), (None, "n", wide), (6, "y", "short"), (7, "y", "short"), (10, "z", "big " * 200_000)]
    pages = spark.createDataFrame([(*r, "2001") for r in rows], PAGES)
    got = [tuple(r) for r in warc.digest(pages).collect()]
    assert sorted(got, key=repr) == want(rows)


def test_no_pages(spark):
    assert warc.digest(spark.createDataFrame([], PAGES)).count() == 0


def record(kind, name, concurrent=(), block=b"HTTP/1.1 200 OK\r\n\r\nbody"):
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", *[f"WARC-Concurrent-To: <{c}>" for c in concurrent], f"Content-Length: {len(block)}"]
    return ("WARC/1.0\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_records_join_in_either_direction(spark, tmp_path):
    archive = b"".join(
        [
            record("warcinfo", "i", block=b"software: x\r\n"),
            record("response", "a"), record("request", "ra", ["a"], b"GET / HTTP/1.1\r\n\r\n"), record("metadata", "ma", ["ra"], b"k: v\r\n"),
            record("response", "b", ["rb"]), record("request", "rb", [], b"GET /b HTTP/1.1\r\n\r\n"), record("metadata", "mb", ["b"], b"k: w\r\n"),
            record("request", "lone", ["gone"], b"GET /c HTTP/1.1\r\n\r\n"),
        ]
    )
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(archive))
    found = {r.capture: r for r in warc.assemble(warc.read_archives(spark, str(tmp_path), ["one.warc.gz"])).collect()}
    assert [r.record_id for r in found["<a>"].requests] == ["<ra>"] and [r.record_id for r in found["<a>"].metadata] == ["<ma>"]
    assert [r.record_id for r in found["<b>"].requests] == ["<rb>"] and [r.record_id for r in found["<b>"].metadata] == ["<mb>"]
    assert found["<b>"].answer.payload_digest == hashlib.sha256(b"body").hexdigest()
    assert found["<gone>"].answer is None and [r.record_id for r in found["<gone>"].requests] == ["<lone>"]


def test_a_cut_archive_is_an_error():
    with pytest.raises(ValueError):
        list(warc.parse_archive(io.BytesIO(record("response", "a")[:-8])))
    with pytest.raises(ValueError):
        list(warc.parse_archive(io.BytesIO(b"HTTP/1.1 200\r\n")))


def test_columns_named_like_inner_ones(spark):
    rows = [(1, "u", "y" * 120), (2, "u", "y" * 120), (3, None, None)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], PAGES).selectExpr("*", "7 AS digest", "8 AS row", "9 AS capture", "'a' AS named", "'b' AS refers_to")
    assert sorted((tuple(r) for r in warc.digest(pages).collect()), key=repr) == want([(*r, "x") for r in rows])
