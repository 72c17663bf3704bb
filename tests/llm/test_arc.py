"""Archives: round trips, foreign files, revisits."""

import base64
import gzip
import hashlib

import pyarrow as pa
import pytest

from ratemill.llm import arc

PAGES = [
    (3, "http://a/x", "<p>same</p>"), (1, "http://a/y z", "<p>same</p>"), (2, None, None), (5, "http://b/", ""), (4, "http://c/\n", "WARC/1.1\r\n\r\nnot a record\r\n\r\n"),
    (6, "http://d", "ü" * 5000), (None, "http://e", "<p>same</p>"), (7, "http://f", "only here"), (7, "http://f", "only here"), (None, "http://g", "no id"),
]


def sha1(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.mark.parametrize("version", [1, 2, None])
@pytest.mark.parametrize("min_bytes", [0, 5])
def test_pages(spark, tmp_path, version, min_bytes):
    table = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, payload string").repartition(3)
    old, new = str(tmp_path / "arc"), str(tmp_path / "warc")
    arc.write_arc(table, "page_id", "url", "html", old, version=version)
    arc.convert(spark, old, new, min_bytes)
    got = [tuple(r) for r in arc.read_warc(spark, new).collect()]
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        first = min((j for j, _, h in PAGES if (h or "") == (html or "") and j is not None), default=None)
        revisit = len(data) >= min_bytes and first is not None and i != first
        want.append((i, len(data), sha1(data), "revisit" if revisit else "response", first if revisit else None))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_no_pages(spark, tmp_path):
    table = spark.createDataFrame([], "page_id long, url string, html string")
    arc.write_arc(table, "page_id", "url", "html", str(tmp_path / "arc"))
    (tmp_path / "arc" / "part-extra.arc").write_bytes(b"")
    arc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))


V1 = b"filedesc://x.arc 0.0.0.0 19960101000000 text/plain 77\n1 0 Origin\nURL IP-address Archive-date Content-type Archive-length\n" + b"\n" * 8
RECORD = b"http://a/with a blank 1.2.3.4 19970203040506 text/html 38\nHTTP/1.0 200 OK\r\nA: b\r\n\r\n<p>\nx 1 2\n</p>\n"


def arc_file(version, fields, values):
    about = f"{version} 0 Origin\n{fields}\n".encode()
    body = b"HTTP/1.0 200 OK\r\n\r\n<p>\nhttp://b/ 1.2.3.4 1 text/html 5\n</p>"
    head = {1: "filedesc://x 0.0.0.0 19960101000000 text/plain ", 2: "filedesc://x 0.0.0.0 19960101000000 text/plain 200 - - 0 x "}[version]
    return head.encode() + str(len(about)).encode() + b"\n" + about + b"\n" + values.encode() + str(len(body)).encode() + b"\n" + body + b"\n", body


CASES = {
    1: ("URL IP-address Archive-date Content-type Archive-length", "http://a/with a blank 1.2.3.4 19970203040506 text/html "),
    2: ("URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length", "http://a/with a blank 1.2.3.4 19970203040506 text/html 200 sum - 9 x "),
}


@pytest.mark.parametrize("version", CASES)
def test_header_lines_and_declared_lengths(spark, tmp_path, version):
    # The version block is read by the fields of version 1 where it has them; a real file of
    # version 2 has all ten there.
    raw, body = arc_file(version, *CASES[version])
    found = list(arc.parse_arc(pa.py_buffer(raw)))
    assert [(f["URL"], f["Archive-date"], c) for f, c in found] == [("http://a/with a blank", "19970203040506", body)]
    two = gzip.compress(raw) if version == 1 else raw
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.arc.gz").write_bytes(two)
    row = arc.read_arc(spark, str(tmp_path / "in")).first()
    assert (row.url, row.date, row.payload, row.payload_digest) == ("http://a/with a blank", "1997-02-03T04:05:06Z", body.partition(b"\r\n\r\n")[2], sha1(body.partition(b"\r\n\r\n")[2]))
    arc.convert(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    files = list((tmp_path / "out").glob("part-*"))
    heads = [h for f in files for h, _ in arc.parse_warc(pa.py_buffer(f.read_bytes()))]
    assert len(heads) == 1 and b"WARC-Date: 1997-02-03T04:05:06Z" in heads[0] and b"WARC-Record-ID: <urn:uuid:" in heads[0]


def test_members_of_gzip():
    raw, body = arc_file(1, *CASES[1])
    cut = raw.index(b"http://a/with")
    assert [c for _, c in arc.parse_arc(pa.py_buffer(gzip.compress(raw[:cut]) + gzip.compress(raw[cut:])))] == [body]


@pytest.mark.parametrize("raw", [b"nonsense\n", arc_file(1, *CASES[1])[0][:-20], b"filedesc://x 0.0.0.0 1 text/plain 4\n9 0\n\n"])
def test_broken_archives_are_errors(raw):
    with pytest.raises(ValueError):
        list(arc.parse_arc(pa.py_buffer(raw)))
