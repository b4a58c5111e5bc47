import gzip
import hashlib
from pathlib import Path

import pytest

from rallyframe.llm import warc_revisit as W
from rallyframe.workspace import new_path

ROWS = "page_id long, url string, html string, digest string, bytes long, id string"


def page(i, html, url="http://a/b"):
    return (i, url, html, "own", -1, "own")


def plain(rows):
    out, last = [], {}
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        if i is not None:
            last[body] = max(i, last.get(body, i))
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        many = sum((h or "").encode() == body for _, _, h, *_ in rows) > 1
        revisit = len(body) >= 1000 and many and last.get(body) is not None and i != last[body]
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", last[body] if revisit else None))
    return sorted(out, key=str)


BIG = "<p>é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 40
PAGES = [page(1, BIG), page(2, BIG), page(9, BIG), page(3, BIG + "x"), page(4, "short"), page(5, "short"), page(6, ""), page(7, None), page(8, "\r\n\r\n\r\n", None),
         page(10, "x" * 300_000, "http://a\r\nWARC-Type: revisit"), page(11, "a" * 999), page(12, "a" * 999), page(13, "b" * 1000), page(14, "b" * 1000), page(-1, "\n" + "c" * 1000)]


def round_trip(spark, rows):
    path = new_path(spark, "warc-test")
    archive = W.write_archive(spark.createDataFrame(rows, ROWS), path, "page_id", "url", "html")
    return path, W.read_archive(spark, path, archive)


def test_round_trip(spark):
    path, records = round_trip(spark, PAGES)
    facts = W.resolved(records).select("id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, facts), key=str) == plain(PAGES)
    bodies = {r.id: (r.record_type, r.payload, r.uri) for r in records.collect()}
    for i, url, html, *_ in PAGES:
        kind, payload, uri = bodies[i]
        assert payload == ("" if kind == "revisit" else html or "")
        assert uri == (url.replace("\r\n", "") if url else None)


def test_archive_is_valid_by_its_lengths(spark):
    """A plain reader that trusts Content-Length alone finds the same records."""
    path, records = round_trip(spark, PAGES)
    found = {}
    for file in Path(path.removeprefix("file:")).glob("part-*.gz"):
        data = gzip.decompress(file.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            size = int(fields[b"Content-Length"])
            assert rest[size:size + 4] == b"\r\n\r\n"
            found[fields[b"WARC-Record-ID"]] = (fields[b"WARC-Type"].decode(), rest[:size].decode())
            data = rest[size + 4:]
    assert found == {f"<urn:record:{r.id}>".encode(): (r.record_type, r.payload) for r in records.collect()}


def test_odd_pages(spark):
    assert round_trip(spark, [])[1].count() == 0
    rows = [page(None, BIG), page(1, BIG), page(None, None, None)]
    facts = W.resolved(round_trip(spark, rows)[1]).select("id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, facts), key=str) == plain(rows)
    same = [page(4, BIG), page(4, BIG), page(2, BIG)]
    kinds = sorted((r.id, r.record_type, r.refers_to) for r in W.resolved(round_trip(spark, same)[1]).collect())
    assert kinds[0] == (2, "revisit", 4) and len(kinds) == 3


def test_a_wrong_length_is_told(spark):
    path, records = round_trip(spark, [page(1, "abc")])
    frame = records.sparkSession.read.option("compression", "gzip").text(path)
    assert frame.count() > 0
    archive = "0" * 8
    bad = new_path(spark, "warc-bad")
    spark.createDataFrame([(W.opening(archive) + "WARC-Type: response\r\nWARC-Record-ID: <urn:record:1>\r\nContent-Length: 9\r\n\r\nabc\r\n",)], "value string").write.option("lineSep", "\r\n").text(bad)
    with pytest.raises(Exception, match="wrong length"):
        W.read_archive(spark, bad, archive).collect()
