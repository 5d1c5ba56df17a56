import base64
import gzip
import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marlspike.llm import warc
from tests.llm.support import write

ROWS = [
    (1, "http://a b\r\n/x", "<p>one</p>\n\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"), (2, None, "<p>two</p>"),
    (3, "u", "<p>two</p>"), (9, "u", "<p>two</p>"), (4, "u", None), (5, "u", ""), (6, "u", "é梦🙂" * 700),
    (7, "u", "no end of line " * 3000), (8, "u", "\r\n"), (10, "u", "\n" * 50), (11, "u", "x\x00\x01y"),
    (12, "u", "rep"), (12, "u", "rep"), (13, "u", "one id"), (13, "u", "other"), (None, "u", "alone"), (None, "u", "rep"),
]
SCHEMA = "page_id long, url string, html string"


def brute(rows, least=0):
    groups = defaultdict(list)
    for key, _, html in rows:
        groups[html or ""].append(key)
    out = []
    for html, keys in groups.items():
        raw = html.encode()
        first = max((k for k in keys if k is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        for key in keys:
            again = len(raw) >= least and key != first
            out.append((key, len(raw), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query(spark, tmp_path):
    table = spark.createDataFrame(ROWS, SCHEMA).withColumns({"id": F.lit("x"), "sha": F.lit(1), "block": F.lit(2)})
    folder = write(table, tmp_path, "pages")
    assert got(warc.op6_warc(spark, folder)) == brute(ROWS)


def test_no_rows(spark, tmp_path):
    folder = write(spark.createDataFrame([], SCHEMA), tmp_path, "pages")
    assert got(warc.op6_warc(spark, folder)) == []


@pytest.mark.parametrize("chunk, piece", [(1 << 20, 1 << 16), (100, 64), (7, 5)])
def test_payloads_come_back_in_pieces(spark, tmp_path, chunk, piece):
    rows = [r for r in ROWS if r[0] not in (12, 13, None)]
    path = f"{tmp_path}/archives"
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), path, chunk=chunk, least=5)
    table = warc.chunk_table(spark, path, piece).collect()
    whole, running = defaultdict(bytes), defaultdict(hashlib.sha1)
    for row in sorted(table, key=lambda r: (r.record, r.chunk)):
        assert row.size == len(row.data) <= piece
        whole[row.id] += row.data
        running[row.id].update(row.data)
        if row.kind == "response":
            assert row.digest == base64.b32encode(running[row.id].digest()).decode()
    last = sorted(((r.id, r.payload_bytes, r.digest, r.kind, r.refers) for r in table if r.last), key=str)
    assert last == brute(rows, least=5)
    kinds = {r.id: r.kind for r in table}
    for key, _, html in rows:
        assert whole[key].decode() == ((html or "") if kinds[key] == "response" else "")


def test_archives_are_valid_records(spark, tmp_path):
    path = tmp_path / "archives"
    warc.write_archives(spark.createDataFrame(ROWS[:6], SCHEMA), str(path), chunk=20)
    count = 0
    for part in path.glob("part-*.gz"):
        data = gzip.decompress(part.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            assert head.startswith(b"WARC/1.1\r\n") and " " not in fields.get("WARC-Target-URI", "")
            size = int(fields["Content-Length"])
            assert rest[size : size + 4] == b"\r\n\r\n"
            data, count = rest[size + 4 :], count + 1
    assert count >= 6


def test_a_wrong_payload_is_an_error():
    parser = warc.Parser()
    lines = [
        b"WARC/1.1\r", b"WARC-Type: response\r", b"WARC-Record-ID: <urn:page:1:a>\r", b"WARC-Payload-Digest: sha1:X\r",
        b"Payload-Length: 1\r", b"Content-Length: 3\r", b"\r",
    ]
    assert [row for x in lines for row in parser.line(x)] == []
    assert list(parser.line(b"\r")) == []
    with pytest.raises(ValueError, match="declared"):
        list(parser.line(b"x"))


@pytest.mark.parametrize("text", ["", "a", "é梦🙂" * 5, "abc"])
@pytest.mark.parametrize("chunk", [1, 2, 4, 7])
def test_parts_end_where_characters_end(text, chunk):
    parts = [bytes(p) for p in warc.pieces(memoryview(text.encode()), chunk)]
    assert "".join(p.decode() for p in parts) == text and len(parts) >= 1
    assert all(len(p) <= chunk + 3 for p in parts)


def test_chunk_rows_carry_running_digests(spark):
    rows = spark.createDataFrame([(1, "u", "é" * 500), (2, "u", "é" * 500), (3, "u", None)], SCHEMA)
    found = warc.cut(rows, "page_id", "html", "url", 64).orderBy("id", "chunk").collect()
    for key, body in ((1, "é" * 500), (2, "é" * 500), (3, "")):
        own = [r for r in found if r.id == key]
        running, size = hashlib.sha1(), 0
        for number, row in enumerate(own):
            running.update(row.data)
            size += len(row.data)
            assert (row.chunk, row.size, row.digest) == (number, size, base64.b32encode(running.digest()).decode())
            assert row.last == (size == len(body.encode())) and (row.sha is not None) == row.last
        assert b"".join(r.data for r in own).decode() == body
    assert len({r.row for r in found}) == 3
